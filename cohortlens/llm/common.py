"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.evaluation.running import running_totals

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: str = "doc_id", modulus: int = 4) -> F.Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def arrow_fields(ddl: str) -> tuple[T.StructType, pa.Schema]:
    schema = T.StructType.fromDDL(ddl)
    return schema, pa.schema([(f.name, ARROW[f.dataType.simpleString()]) for f in schema])


def columns_of(rows: Sequence[tuple], schema: pa.Schema) -> list[pa.Array]:
    """One array per field from row tuples."""
    if not rows:
        return [pa.array([], f.type) for f in schema]
    return [pa.array(values, f.type) for values, f in zip(zip(*rows, strict=True), schema, strict=True)]


def per_text(
    df: DataFrame, keep: Sequence[str], text: str, make: Callable[[], Callable[[str | None], tuple]], ddl: str
) -> DataFrame:
    """One row out for each row in: the columns ``keep`` untouched, then the fields of ``ddl``.

    ``make`` is called once per task and returns the function of one whole text
    that gives the fields. No row meets another, so there is no shuffle, and a
    lost task is simply run again.
    """
    given = list(keep)
    fields, arrow = arrow_fields(ddl)
    inner = df.select(*given)
    if text in given and isinstance(df.schema[text].dataType, T.StringType):
        at = given.index(text)  # one copy of the text is enough
    else:
        at = len(given)
        inner = df.select(*given, F.col(text).cast("string").alias(fresh(inner, "text_in")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            rows = [one(value.as_py()) for value in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(given))] + columns_of(rows, arrow), given + arrow.names
            )
            del batch, rows
        pa.default_memory_pool().release_unused()  # the worker lives on and shares the executor's memory

    return inner.mapInArrow(run, T.StructType([*inner.select(*given).schema.fields, *fields.fields]))


def ranked(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``i``, the rank within the keys, and ``n``, their number of rows. Equal rows are dealt to several tasks too."""
    spread = rows.withColumn("order", F.struct(*order, F.monotonically_increasing_id())).withColumn("one", F.lit(1).cast("long"))
    kept = [c for c in rows.columns if c not in keys]
    counted = running_totals(spread, keys, "order", ["one"], descending=False, keep=kept)
    return counted.select(*rows.columns, (F.col("cum_one") - 1).alias("i"), F.col("all_one").alias("n"))
