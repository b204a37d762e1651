"""Table scans: files, catalog tables, inline rows, provenance and counts."""

from __future__ import annotations

import json
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.columns import blank_to_null, coerce_columns, coerced


def read_csv(spark: SparkSession, path: str, types: dict[str, str], **options) -> DataFrame:
    """CSV with a header, typed by column name.

    Nothing is inferred: the file is read once, as text, and columns are cast in
    the same projection; a value that does not parse becomes NULL. Set
    ``multiLine=True`` when quoted values hold line breaks (such a file is read
    by one task, so prefer many files).
    """
    raw = spark.read.options(**{"header": True, "escape": '"', **options}).csv(path)
    return coerce_columns(raw, types)


BROKEN = "_broken_line"


def read_csv_with_rejects(
    spark: SparkSession, path: str, types: dict[str, str], required: tuple[str, ...] = (), columns: list[str] | None = None, **options,
) -> tuple[DataFrame, DataFrame]:
    """Like :func:`read_csv`, and the rows that are at fault, with all their reasons:
    ``_source_file``, ``reason``, ``record`` (the line as it stands where it has too few
    or too many fields, else its fields joined by commas).

    Reasons are a malformed line, a value that does not parse as its type, and a missing
    value in a ``required`` column. Rows at fault are left out of the first frame; with
    ``read_csv`` they would stay, with NULLs. Every row is in one of the two frames. Files
    without a header need ``columns``. Both frames scan the files when they are used.
    """
    given = {"escape": '"', "header": columns is None, **options}
    names = columns or spark.read.options(**given).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in (*names, BROKEN)])
    # the number of fields is only checked where lines are parsed as a whole
    raw = spark.read.options(**{**given, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, "columnPruning": False}).schema(schema).csv(path)

    def fault(c: str) -> list[Column]:
        found, text = [], F.col(f"`{c}`")
        if types.get(c, "string") != "string":
            found.append(F.when(blank_to_null(text).isNotNull() & coerced(text, types[c]).isNull(), F.lit(f"{c}: not a {types[c]}")))
        if c in required:
            found.append(F.when(blank_to_null(text).isNull(), F.lit(f"{c}: missing")))
        return found

    whole = F.col(BROKEN).isNull()
    reasons = F.when(whole, F.array_compact(F.array(F.lit(None).cast("string"), *[r for c in names for r in fault(c)]))).otherwise(F.array(F.lit("malformed line")))
    judged = raw.withColumn("_reasons", reasons)
    good = coerce_columns(judged.filter(F.size("_reasons") == 0).select(*names), types)
    line = F.coalesce(F.col(BROKEN), F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names]))
    rejects = judged.filter(F.size("_reasons") > 0).select(
        F.col("_metadata.file_name").alias("_source_file"), F.concat_ws("; ", "_reasons").alias("reason"), line.alias("record"))
    return good, rejects


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few control rows with an explicit schema, as literals of the plan: one
    partition and no Python worker. Times go through text, so that they do not
    pick up the zone of the driver's machine."""
    fields = StructType.fromDDL(schema).fields
    if not rows:
        return spark.createDataFrame([], schema)

    def literal(value, kind):
        return F.lit(value.isoformat(sep=" ") if isinstance(value, datetime) else value).cast(kind)

    entries = [F.struct(*[literal(v, f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def listed_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """The same for hundreds of rows and more: one literal holds them all as text, where
    :func:`inline_rows` has several calls for every value. Their values are cast from text."""
    fields = StructType.fromDDL(schema).fields
    text = json.dumps([
        {f.name: None if v is None else v.isoformat(sep=" ") if isinstance(v, datetime) else str(v) for v, f in zip(row, fields, strict=True)} for row in rows])
    parsed = F.from_json(F.lit(text), ArrayType(StructType([StructField(f.name, StringType()) for f in fields])), {"mode": "FAILFAST"})
    return spark.range(0, 1, 1, 1).select(F.inline(parsed)).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


def with_provenance(df: DataFrame, source: str | Column, run_ts: datetime | None = None) -> DataFrame:
    """Add ``_ingested_at`` and ``_source_file``. ``source`` is a name, or
    ``F.col('_metadata.file_name')`` for a real file scan. Give ``run_ts`` for a
    repeatable load."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    name = F.lit(source) if isinstance(source, str) else source
    return df.select("*", stamp.alias("_ingested_at"), name.alias("_source_file"))


def count_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """Rows per table and for a missing table 0, as one job."""
    def one(name: str) -> DataFrame:
        rows = spark.table(name) if spark.catalog.tableExists(name) else spark.range(0)
        return rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    return reduce(DataFrame.unionByName, [one(n) for n in names])


def total_rows(spark: SparkSession, names: list[str]) -> int:
    return count_tables(spark, names).agg(F.sum("row_count")).first()[0] or 0
