from pyspark.sql import functions as F

from cohortlens.plans import modelling


def test_back_tests_write_no_projection(spark, monkeypatch):
    """128 projected numbers of every row were written before."""
    hashed = lambda seed: F.pmod(F.xxhash64("ent", "pred_dt", F.lit(seed)), F.lit(101)).cast("int")
    days = F.explode(F.sequence(F.lit("1997-01-01").cast("date"), F.lit("2000-07-01").cast("date"), F.expr("interval 6 months")))
    rows = spark.range(120).select(F.col("id").alias("ent"), days.alias("pred_dt"))
    rows = rows.withColumns({c: hashed(i) / (50.0 if c.startswith("days") else 101.0) for i, c in enumerate(modelling.COVARIATES)})
    rows = rows.withColumns({"label": (hashed(0) > 60).cast("int"), "key": F.concat_ws("/", "ent", "pred_dt")})
    written, whole = [], modelling.materialise
    monkeypatch.setattr(modelling, "_pu_rows", lambda spark, sf: rows)
    monkeypatch.setattr(modelling, "materialise", lambda df, name: written.append(df) or whole(df, name))
    board = {str(r.test_dt): r.auroc for r in modelling.pu_backtest(spark, "").collect()}
    assert len(board) == 6 and board["2000-07-01"] > 0.8
    assert all(f.dataType.typeName() not in ("array", "vectorudt") for df in written for f in df.schema)
