"""Node and edge tables of a directed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.evaluation.running import running_totals
from cohortlens.functions.recode import relabel

EDGE = "Edge Coef."  # fixed value: type of the rows that are edges


def dag_nodes(edges: DataFrame, old: str | None = None, new: str | None = None) -> DataFrame:
    """Distinct labels of both ends with an id in label order, numbered by ranges."""
    labels = edges.select(F.explode(F.array("from", "to")).alias("label"))
    if old:
        labels = labels.withColumn("label", relabel("label", old, new))
    counted = labels.filter("label is not null").distinct().withColumns({"_all": F.lit(0), "_one": F.lit(1)})
    numbered = running_totals(counted, ["_all"], "label", ["_one"], descending=False)
    return numbered.select("label", F.col("cum__one").cast("bigint").alias("id"))


def dag_edges(edges: DataFrame, nodes: DataFrame, old: str | None = None, new: str | None = None,
              edge_type: str = EDGE) -> DataFrame:
    """Edges with the node ids of both ends."""
    rows = edges.filter(F.col("type") == edge_type).select(
        F.col("from").alias("from_nm"), F.col("to").alias("to_nm")
    )
    if old:
        rows = rows.withColumns({c: relabel(c, old, new) for c in ("from_nm", "to_nm")})
    source = nodes.select(F.col("label").alias("from_nm"), F.col("id").alias("from"))
    target = nodes.select(F.col("label").alias("to_nm"), F.col("id").alias("to"))
    return (
        rows.join(source, "from_nm", "left").join(target, "to_nm", "left").select("from_nm", "to_nm", "from", "to")
    )


def neighbours(edges: DataFrame, label: str) -> DataFrame:
    """Parents and children of one node."""
    parents = edges.filter(F.col("to_nm") == label).select(
        F.col("from_nm").alias("label"), F.lit("parent").alias("role")
    )
    children = edges.filter(F.col("from_nm") == label).select(
        F.col("to_nm").alias("label"), F.lit("child").alias("role")
    )
    return parents.unionByName(children)
