"""CSV folders as streams: schema handling and lineage columns."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.schemas import INGESTED, SOURCE_FILE, UNPARSED

RESCUED = "_rescued"


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer_types: bool = False,
    schema_path: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of CSV files with headers as a stream; the checkpoint of the query
    that reads it makes each file count once.

    The schema is the given one, else the one pinned under ``schema_path``, else
    taken from the headers: all text, or typed with ``infer_types`` (which reads
    the files present once). A taken schema is pinned for later runs. A file whose
    header does not match fails the stream instead of loading shifted columns.
    """
    reader = (
        spark.readStream.schema(resolve_schema(spark, path, schema, infer_types, schema_path))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", UNPARSED)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def resolve_schema(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer_types: bool = False,
    schema_path: str | None = None,
) -> StructType:
    if schema is not None:
        return schema
    if schema_path:
        pinned = _pinned(spark, schema_path)
        if pinned is not None:
            return pinned
    taken = spark.read.option("header", True).option("inferSchema", infer_types).csv(path).schema
    if schema_path:
        spark.createDataFrame([(taken.json(),)], "value string").coalesce(1).write.text(schema_path)
    return taken


def _pinned(spark: SparkSession, schema_path: str) -> StructType | None:
    try:
        stored = spark.read.option("wholetext", True).text(schema_path).first()
    except AnalysisException:
        return None
    return StructType.fromJson(json.loads(stored.value)) if stored else None


def with_lineage(df: DataFrame, ts_column: str = INGESTED) -> DataFrame:
    """Add the ingest time (one value per micro-batch) and the source file."""
    return df.withColumns(
        {ts_column: F.current_timestamp(), SOURCE_FILE: F.col("_metadata.file_path")}
    )


def rows_by_header(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a batch whose files each have a header of their own, as text columns.

    ``lines`` is the text source's output with the file path and block start as ``_file``
    and ``_start``. Each file's first line is its header; an equal line further down is data.
    Columns are matched by name: what ``columns`` lacks in a file is NULL, what a file has
    besides is in the map ``_rescued``, and a row with more or fewer fields than its header
    is kept whole in ``_corrupt_record`` too. Empty lines are left out.

    All layouts are parsed in one pass: lines by the number of columns of their header, names
    by position. Only the distinct numbers of columns come to the driver.
    """
    numbered = lines.withColumn("_line", F.monotonically_increasing_id())
    first = numbered.where("_start = 0").groupBy("_file").agg(F.min(F.struct("_line", "value")).alias("_top"))
    headers = first.select("_file", F.col("_top._line").alias("_line_of_header"), F.col("_top.value").alias("_header"))
    # no name can hold more commas than the header, so this many columns are enough to split it
    size = F.size(F.split("_header", ","))
    sizes = [r[0] for r in headers.select(size).distinct().collect()]
    names = _parsed("_header", size, sizes)["fields"]
    named = headers.select("_file", "_line_of_header", _named(names).alias("_names"))
    widths = [r[0] for r in named.select(F.size("_names")).distinct().collect()]
    rows = numbered.join(named, "_file").where((F.col("_line") != F.col("_line_of_header")) & (F.length("value") > 0))
    rows = rows.withColumn("_row", _parsed("value", F.size("_names"), widths))
    rows = rows.withColumn("_fields", F.map_from_arrays("_names", "_row.fields"))
    surplus = F.map_filter("_fields", lambda name, value: ~name.isin(*columns) & value.isNotNull())
    return rows.select(
        *[F.col("_fields").getItem(c).alias(c) for c in columns],
        F.when(F.size(surplus) > 0, surplus).alias(RESCUED),
        F.col(f"_row.{UNPARSED}").alias(UNPARSED),
        F.col("_file").alias(SOURCE_FILE),
    )


def _parsed(line: str, width: Column, widths: Iterable[int]) -> Column:
    """Struct of the line's ``fields``, as many as ``width`` says, and the line itself if it has another number."""
    found = F.lit(None)
    for n in sorted(widths):
        schema = ", ".join(f"c{i} STRING" for i in range(n)) + f", {UNPARSED} STRING"
        row = F.from_csv(line, schema, {"columnNameOfCorruptRecord": UNPARSED})
        fields = F.array(*[row[f"c{i}"] for i in range(n)])
        found = F.when(width == n, F.struct(fields.alias("fields"), row[UNPARSED].alias(UNPARSED))).otherwise(found)
    return found


def _named(fields: Column) -> Column:
    """Names as given, trimmed; those that end a header that was split too finely go, and an
    empty or repeated name gets its place."""
    trimmed = F.transform(fields, lambda f: F.trim(F.regexp_replace(f, "^\ufeff", "")))
    # a quoted comma made fewer fields than were split off: the rest is NULL
    last = F.array_max(F.transform(trimmed, lambda f, i: F.when(f.isNotNull() & (f != ""), i + 1).otherwise(0)))
    used = F.slice(trimmed, 1, F.greatest(last, F.lit(1)))
    blank = F.transform(used, lambda f, i: F.when(f.isNull() | (f == ""), F.concat(F.lit("_c"), i.cast("string"))).otherwise(f))
    return F.transform(
        blank, lambda f, i: F.when(F.array_position(blank, f) == i + 1, f).otherwise(F.concat(f, F.lit("#"), (i + 1).cast("string")))
    )
