"""Entity-date analytics on Spark DataFrames.

Spells -> prediction-date spine -> features keyed by (entity, prediction date)
-> forward labels -> temporal back-tests -> curves, fairness, what-ifs.
Every public function takes and returns DataFrames (or Columns).
"""
