"""Bounded reads: object extracts, reports, JSON lines, training examples."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordflow.config import parse_instant, parse_span
from recordflow.functions.columns import name
from recordflow.functions.variants import is_object
from recordflow.schemas import EXAMPLE, REPORT

MODIFIED = "LastModifiedDate"
#: Rows that a task should get of a table whose rows are parsed, checked or hashed one by one.
TASK_ROWS = 100_000


def read_objects(
    spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | None = None
) -> DataFrame:
    """Records of one object type from landed extracts.

    JSON extracts without a schema come as one ``payload`` VARIANT column, and text that is not
    JSON fails the job. Columnar extracts keep their columns, so filters and column selection
    reach the files.
    """
    if fmt == "json" and schema is None:
        return spark.read.text(path).select(F.parse_json("value").alias("payload"))
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def spread(df: DataFrame, least: int = 0) -> DataFrame:
    """Deal the rows of a scan out anew where its splits hold them unevenly or by the million.

    A row group is read by one task, however many splits its file has and however much work follows, so the
    rows of the splits are counted, without reading a column. A split with no more than twice its share, with
    shares of TASK_ROWS at most, leaves the scan as it is, and so do splits of up to ``least`` rows.
    """
    counts = df.select(F.spark_partition_id().alias("split")).groupBy("split").count()
    total, most = counts.agg(F.sum("count"), F.max("count")).first()
    if not total or most <= least:
        return df
    pieces = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_ROWS))
    return df.repartition(pieces) if most * pieces > 2 * total else df


def as_payload(df: DataFrame) -> DataFrame:
    """Typed rows as one schemaless ``payload`` column; NULL members count as absent."""
    if df.columns == ["payload"]:
        return df
    return df.select(F.to_variant_object(F.struct(*[name(c) for c in df.columns])).alias("payload"))


def range_bounds(
    *,
    after: str | datetime | None = None,
    before: str | datetime | None = None,
    duration: str | None = None,
    offset: str | None = None,
    run_at: datetime | None = None,
) -> tuple[datetime | None, datetime | None]:
    """The half-open range ``[start, end)`` that the options select; None means unbounded.

    A duration is a window of that length that ends ``offset`` before the run start.
    """
    start = parse_instant(after) if isinstance(after, str) else after
    end = parse_instant(before) if isinstance(before, str) else before
    if duration or offset:
        window_end = run_at or datetime.now(timezone.utc)
        if offset:
            window_end -= parse_span(offset)
        end = window_end if end is None else min(end, window_end)
        if duration:
            window_start = window_end - parse_span(duration)
            start = window_start if start is None else max(start, window_start)
    return start, end


def in_range(
    df: DataFrame, bounds: tuple[datetime | None, datetime | None], column: str = MODIFIED
) -> DataFrame:
    """Rows whose ``column`` lies in the range.

    In JSON and CSV extracts a record without a readable time fails the job; a typed column that is
    NULL is outside of every range.
    """
    if bounds == (None, None):
        return df
    is_payload = column not in df.columns
    kind = "timestamp" if is_payload else dict(df.dtypes)[column]
    ts = F.try_variant_get("payload", f"$.{column}", "timestamp") if is_payload else name(column)
    if is_payload or kind == "string":
        # A time that cannot be read is not outside of the range: it fails the job.
        kind, read = "timestamp", ts if is_payload else F.try_to_timestamp(ts)
        ts = F.coalesce(read, F.raise_error(F.lit(f"{column} is missing or not a time")).cast("timestamp"))

    def bound(moment: datetime):
        if kind == "timestamp_ntz":
            return F.lit(moment.astimezone(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
        return F.lit(moment)

    start, end = bounds
    if start is not None:
        df = df.filter(ts >= bound(start))
    if end is not None:
        df = df.filter(ts < bound(end))
    return df


def as_columns(df: DataFrame) -> DataFrame:
    """The fields of a ``payload`` column as columns, typed by one pass over all records.

    A field that is an object in some records and not in others stays a VARIANT; one that is null
    everywhere is text.
    """
    if df.columns != ["payload"]:
        return df
    found = df.agg(F.schema_of_variant_agg("payload")).first()[0] or "OBJECT<>"
    if not found.startswith("OBJECT<"):
        raise ValueError("records of an object have to be JSON objects")
    # Names are quoted in the text wherever they need it.
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"\bVOID\b", "STRING", found))
    return df.select(F.try_variant_get("payload", "$", ddl).alias("record")).select("record.*")


def query_objects(df: DataFrame, object_name: str, query: str) -> DataFrame:
    """The user's SQL over the object, which is visible under its own name, in this query only."""
    quoted = object_name.replace("`", "``")
    text = query.strip().rstrip(";").replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(
        f"WITH `{quoted}` AS (SELECT * FROM {{_object}}) SELECT * FROM ({text})", _object=as_columns(df)
    )


def read_report(spark: SparkSession, path: str, schema: T.StructType = REPORT) -> DataFrame:
    """Report CSV with a header and declared types."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_json_lines(spark: SparkSession, prefix: str) -> DataFrame:
    """Lines of all files that start with ``prefix``; numbers missing in the series do no harm."""
    return spark.read.text(prefix + "*").select(
        "value", F.col("_metadata.file_path").alias("source_file")
    )


def numbered(path: Column, prefix: str, suffix: str) -> Column:
    """The number of a file ``<prefix><number><suffix>``, or of a folder of that name that holds it; else null."""
    name = rf"\Q{prefix.rstrip('/').rsplit('/', 1)[-1]}\E(\d{{1,18}})\Q{suffix}\E"
    found = F.regexp_extract(path, rf"/{name}(?:/[^/]+)?$", 1)
    return F.when(found != "", found.cast("bigint"))


def file_numbers(spark: SparkSession, prefix: str, suffix: str) -> list[int]:
    """The numbers of the files, empty ones as well, and folders that are there, by their names."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(prefix + "*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    name = re.escape(prefix.rstrip("/").rsplit("/", 1)[-1])
    names = [re.fullmatch(rf"{name}(\d{{1,18}}){re.escape(suffix)}", f.getPath().getName()) for f in found]
    return [int(m[1]) for m in names if m]


def read_numbered(
    spark: SparkSession, prefix: str, *, suffix: str = ".json", first: int = 1, last: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Records of the JSON-lines files ``<prefix><number><suffix>`` and a manifest of them.

    Records: (``number``, ``value``, ``payload`` or ``error_message``), every line once; one that is no JSON
    object, such as a cut one, has the error. Manifest: one row per number from ``first`` to ``last``, or to the highest that
    is there: (``number``, ``status``, ``records``, ``corrupt_records``); the status is ``read``, ``corrupt`` when some of
    its records are, or ``missing``. Other files that begin like the prefix, such as backups, are not read.
    """
    there = sorted({n for n in file_numbers(spark, prefix, suffix) if n >= first})
    lines = spark.read.option("recursiveFileLookup", True).text(prefix + "*").select(
        numbered(F.col("_metadata.file_path"), prefix, suffix).alias("number"), "value"
    )
    parsed = lines.filter("number is not null").select("*", F.try_parse_json("value").alias("_doc"))
    fits = F.coalesce(is_object(F.col("_doc")), F.lit(False))
    records = parsed.select(
        "number",
        "value",
        F.when(fits, F.col("_doc")).alias("payload"),
        F.when(~fits, F.concat(F.lit("not a JSON object: "), F.col("value"))).alias("error_message"),
    )
    met = records.groupBy("number").agg(
        F.count(F.lit(1)).alias("records"), F.count("error_message").alias("corrupt_records")
    )
    top = last if last is not None else max(there, default=first - 1)
    expected = spark.range(first, top + 1).withColumnRenamed("id", "number")
    found = spark.createDataFrame([(n, True) for n in there], "number long, there boolean")
    manifest = expected.join(found, "number", "left").join(met, "number", "left").select(
        "number",
        F.when(F.col("there").isNull(), "missing").when(F.col("corrupt_records") > 0, "corrupt").otherwise("read").alias("status"),
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("corrupt_records", F.lit(0)).alias("corrupt_records"),
    )
    return records, manifest


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXAMPLE).parquet(path)


def head_sample(df: DataFrame, order_by: list[str], n: int = 2) -> DataFrame:
    """The first rows in a stated order, for a trial run."""
    return df.orderBy(*[name(c) for c in order_by]).limit(n)
