import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from cohortlens.causal import mechanisms


def bent(spark, n, values):
    """Two parents with few values, a mean that no line follows, and a flag."""
    hashed = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10_007)) / 10_007
    df = spark.range(n).select("id", (F.floor(hashed(1) * values) / 4.0).alias("a"), (F.floor(hashed(2) * 5) * 3.0).alias("b"), hashed(3).alias("e"))
    return df.withColumns(
        {"y": (F.col("a") - 3) * (F.col("a") - 3) + F.col("b") * F.col("a") + F.col("e"), "flag": (F.col("e") + F.sin("a") > 0.8).cast("int")}
    )


def test_boosted_fits_see_cells_not_rows(spark, monkeypatch):
    """Every pass of every tree went over all rows before."""
    given = []
    for kind in (GBTRegressor, GBTClassifier):
        whole = kind._fit
        monkeypatch.setattr(kind, "_fit", lambda self, df, whole=whole: given.append(df.count()) or whole(self, df))
    mechanisms.fit_mechanisms(bent(spark, 4000, 1000), [("a", "y"), ("a", "flag")], ["id"])
    assert given and max(given) <= 2 * 2 * mechanisms.BINS


@pytest.mark.parametrize("node", ["y", "flag"])
def test_boosted_means_are_those_of_spark_on_all_rows(spark, node):
    df, above = bent(spark, 3000, 12), ["a", "b"]
    rows = df.select(F.lit(False).alias("_held"), *[F.col(c).cast("double").alias(c) for c in (*above, node)])
    cuts = mechanisms._cuts(rows, above)
    assert [len(cuts[c]) for c in above] == [11, 4]
    cells, between = mechanisms._cells(rows, above, node, node == "flag", cuts)
    assert between[1] == [1.5, 4.5, 7.5, 10.5]
    got = mechanisms._fit_boosted(cells, between, node == "flag", 7)(rows, above, "got")
    columns = {"featuresCol": "_v", "labelCol": node, "seed": 7}
    plain = (GBTClassifier if node == "flag" else GBTRegressor)(**columns)
    vectors = VectorAssembler(inputCols=above, outputCol="_v").transform(got)
    both = plain.fit(vectors).transform(vectors)
    want = F.get(vector_to_array("probability"), F.lit(1)) if node == "flag" else F.col("prediction")
    worst = both.agg(F.max(F.abs(want - F.col("got"))).alias("w"), F.stddev("got").alias("s")).first()
    assert worst["w"] < 1e-6 and worst["s"] > 0.05


def test_cuts_of_many_few_and_no_values(spark):
    rows = spark.range(3200).select((F.col("id") / 7.0).alias("many"), (F.col("id") == 5).cast("double").alias("rare"), F.lit(2.0).alias("one"))
    cuts = mechanisms._cuts(rows, ["many", "rare", "one"])
    assert len(cuts["many"]) == mechanisms.BINS - 1 and cuts["rare"] == [0.0] and cuts["one"] == []
    sizes = rows.groupBy(mechanisms._bin(F.col("many"), cuts["many"])).count().agg(F.min("count"), F.max("count")).first()
    assert sizes[0] >= 95 and sizes[1] <= 105
