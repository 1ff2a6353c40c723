"""Sources and sinks with fixed schemas."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Raw files. Dates arrive as text and are parsed by ``functions.dates``.
# Column names and types of the input files.
SCHEMAS = {
    "enrollment": "student_id long, person_id long, school_id string, start_date string, end_date string, "
    "birth_date string, race_ethnicity_fed int, home_primary_language int",
    "attendance": "student_id long, date string, year string, period_name string, status string, "
    "excuse string, excuse_code string, excuse_description string",
    "behavior": "student_id long, person_id long, incident_date string, resolution_name string",
    "conditions": "student_id long, person_id long, health_condition string, condition_start_date string, "
    "condition_end_date string, condition_status string, treatment string",
    "condition_class": "health_condition string, depressive_disorder int, "
    "psychiatric_disorder_non_depressive int, stress_or_depression_related int, "
    "general_inflammatory_disease int, autoimmune_disease int, substance_related int, self_harm int",
    "demographics": "student_id long, gender string, language string, race_ethnicity_code string",
    "free_reduced": "student_id long, eligibility string, year string, end_year int",
    "homeless": "`Student Number` long, `Person ID` long, year string, Homeless string",
    "household": "student_studentNumber long, personID long, Relationship string, ContactID string, year string",
    "grades": "student_id long, year string, course_name string, term_name string, rask string, score string, "
    "`grading.scoreListItemName` string",
    "term_key": "name string, startDate string, endDate string",
    "predictions": "predict int, p1 double, student_id long, pred_dt date, label int",
    "dag_edges": "`from` string, `to` string, type string",
}


def _headers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """(columns, files) for each header that occurs, from the first line of each file."""
    firsts = (
        spark.read.text(list(paths), wholetext=False)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
        .withColumn("row", F.monotonically_increasing_id())
        .filter("at = 0")
        .groupBy("file")
        .agg(F.min_by("value", "row").alias("header"))
        .groupBy("header")
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
        .orderBy("header")
        .collect()  # a row for each distinct header
    )
    return [(spark.read.csv(r["files"][:1], header=True, inferSchema=False).columns, r["files"]) for r in firsts]


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: str, mixed: bool = False, rejects: bool = False
) -> DataFrame:
    """CSV with a header, columns taken by name into a fixed schema; no inference pass.

    ``schema`` is a name in ``SCHEMAS`` or a DDL string. Columns a file has beyond
    the schema are not read; ones it lacks are null, and so are values of another
    type; with ``rejects`` the column ``n_rejected`` counts those in each row. All
    files must have the header of the first, which is checked as they are read;
    with ``mixed`` they may differ, and a pass over the lines finds who has which.
    """
    ddl = SCHEMAS.get(schema, schema)
    paths = [path] if isinstance(path, str) else list(path)
    wanted = spark.createDataFrame([], ddl).schema
    if mixed:
        groups = _headers(spark, paths)
    else:
        groups = [(spark.read.csv(paths, header=True, inferSchema=False).columns, paths)]
    parts = []
    for found, files in groups:
        read = ", ".join(f"`{c}` string" for c in found)
        raw = spark.read.csv(files, header=True, schema=read, enforceSchema=False)
        columns, failed = [], F.lit(0)
        for f in wanted.fields:
            if f.name not in found:
                columns.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            text = F.col(f"`{f.name}`")
            columns.append(text.try_cast(f.dataType).alias(f.name))
            failed = failed + (text.isNotNull() & text.try_cast(f.dataType).isNull()).cast("int")
        parts.append(raw.select(*columns, *([failed.alias("n_rejected")] if rejects else [])))
    return reduce(DataFrame.unionByName, parts)


@dataclass
class Loaded:
    """A loaded table, its rejected lines, and how many lines were read, rejected, and rejected for each column."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def load_csv(
    spark: SparkSession, path: str | Sequence[str], schema: str, out: str, columns_needed: Sequence[str] = ()
) -> Loaded:
    """Write CSV files to the parquet folder ``out``, with bad lines apart, in one pass over the text.

    A line is bad if a value isn't of its column's type, if a column of ``columns_needed`` is empty, or if it hasn't as
    many fields as the header; it goes whole to ``rejects`` (``file``, ``line``, ``bad_columns``; no bad column: number of
    fields). All other lines are in ``rows``. ``counts`` has ``n_rows``, ``n_rejected``, ``n_malformed`` and the lines
    rejected for each column by its name. It is read from the flags of the written table, so a task that ran twice counts
    once; an observation of the write would also keep the session's ML models from being sent to tasks.
    """
    wanted = spark.createDataFrame([], SCHEMAS.get(schema, schema)).schema
    paths = [path] if isinstance(path, str) else list(path)
    found = spark.read.csv(paths, header=True, inferSchema=False).columns
    absent = [f.name for f in wanted.fields if f.name not in found]
    if absent:
        raise ValueError(f"no column {', '.join(absent)}")
    read = ", ".join(f"`{c}` string" for c in found)
    raw = spark.read.csv(
        paths, header=True, schema=f"{read}, _line string", enforceSchema=False, mode="PERMISSIVE",
        columnNameOfCorruptRecord="_line",
    )
    bad, values = [], []
    for f in wanted.fields:
        text = F.col(f"`{f.name}`")
        wrong = text.isNotNull() & text.try_cast(f.dataType).isNull()
        if f.name in columns_needed:
            wrong = wrong | text.isNull()
        bad.append(F.when(wrong, F.lit(f.name)))
        values.append(text.try_cast(f.dataType).alias(f.name))
    malformed = F.col("_line").isNotNull()
    judged = raw.select(
        *values,
        F.when(malformed, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*bad))).alias("_bad"),
        malformed.alias("_malformed"),
        F.coalesce("_line", F.to_csv(F.struct(*[F.col(f"`{c}`") for c in found]))).alias("_text"),
        F.col("_metadata.file_path").alias("_file"),
    )
    rejected = F.col("_malformed") | (F.size("_bad") > 0)
    # what only rejected lines need is empty for the others
    kept = {c: F.when(F.col("_rejected"), F.col(c)) for c in ("_bad", "_text", "_file")}
    tested = judged.withColumn("_rejected", rejected).withColumns(kept)
    tested.write.partitionBy("_rejected").mode("error").parquet(out)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields])
    back = spark.read.schema(f"{fields}, _bad array<string>, _malformed boolean, _text string, _file string, _rejected boolean").parquet(out)
    seen = back.agg(
        F.count("*").alias("n_rows"),
        F.count_if("_rejected").alias("n_rejected"),
        F.count_if("_malformed").alias("n_malformed"),
        *[F.count_if(F.array_contains("_bad", f.name)).alias(f"bad {f.name}") for f in wanted.fields],
    ).first()
    counts = {k.removeprefix("bad "): v for k, v in seen.asDict().items()}
    return Loaded(
        back.filter(~F.col("_rejected")).select(*[f"`{f.name}`" for f in wanted.fields]),
        back.filter("_rejected").select(F.col("_file").alias("file"), F.col("_text").alias("line"), F.col("_bad").alias("bad_columns")),
        counts,
    )


def snake(name: str) -> str:
    """``"How confident?  (Values)"`` -> ``how_confident_values``."""
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case headers; a repeated name gets a number."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        n = snake(c)
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*names)


def suffix_clashes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Columns both sides have besides the keys get ``_x`` / ``_y``."""
    both = (set(left.columns) & set(right.columns)) - set(keys)
    return (
        left.withColumnsRenamed({c: f"{c}_x" for c in both}),
        right.withColumnsRenamed({c: f"{c}_y" for c in both}),
    )


def as_tables(frames: Mapping[str, DataFrame]) -> None:
    """Frames as SQL tables by name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    """Parquet or CSV folder, one file set per task; partition the main table by ``pred_yr``.

    Rows are first brought together by the partition columns plus a spread key,
    so a partition is not one file per task and a big one not one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def catalogue(df: DataFrame) -> DataFrame:
    """Column names of a table as a table."""
    return df.sparkSession.createDataFrame([(c,) for c in df.columns], "feature string")
