"""Feature building shared by training and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.columns import compute_once, name
from recordflow.functions.dates import created_at, days_between, short_date
from recordflow.functions.hashing import N_BUCKETS, bucket_counts, buckets, value_text
from recordflow.operators.shaping import compact_names, drop_columns, strip_text, with_row_id

# Mean and standard deviation of the published scoring model.
PUBLISHED_AMOUNT_MEAN = 1137889.913561848
PUBLISHED_AMOUNT_STD = 1197302.0975264315

# Report columns that take no part in the features.
ANOMALY_DROPS = [
    "Billing State/Province", "Created Date", "Close Date", "Account Name", "Product Name",
    "Opportunity Name", "Opportunity Owner", "Account Owner", "#",
]
REGRESSION_DROPS = [
    "Billing State/Province", "Account Name", "Product Name", "Opportunity Name",
    "Opportunity Owner", "Account Owner", "#",
]


def hash_features(
    df: DataFrame, columns: list[str], n: int = N_BUCKETS, out: str = "x"
) -> DataFrame:
    """Add the hashed features of ``columns``; the order of the columns does not matter."""
    types = {f.name: f.dataType for f in df.schema.fields}
    hashed = buckets([value_text(name(c), types[c]) for c in columns], n)
    counted = compute_once(
        compute_once(df, _buckets=hashed), **{out: bucket_counts(F.col("_buckets"), n, len(columns))}
    )
    return counted.drop("_buckets")


def zscore(value: Column, mean: float | Column, std: float | Column) -> Column:
    as_col = [v if isinstance(v, Column) else F.lit(v) for v in (mean, std)]
    return (value.cast("double") - as_col[0]) / F.nullif(as_col[1], F.lit(0.0))


def scale_params(df: DataFrame, column: str = "Amount") -> DataFrame:
    """Mean and sample standard deviation, one row."""
    return df.agg(F.avg(name(column)).alias("mean"), F.stddev_samp(name(column)).alias("std"))


def hashed_fields(df: DataFrame, skip: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c not in skip]


def anomaly_features(
    records: DataFrame, mean: float | Column, std: float | Column, id_name: str = "Id"
) -> DataFrame:
    """(id, hashed categories ``x``, scaled amount ``amount_z``): for training and for scoring."""
    fields = hashed_fields(records, (id_name, "Amount"))
    return hash_features(records, fields).select(
        name(id_name), F.col("x"), zscore(F.col("Amount"), mean, std).alias("amount_z")
    )


def clean_report(report: DataFrame, drops: list[str], *, strip: bool, id_name: str = "Id") -> DataFrame:
    """Report rows with short names and an id; a business key named ``id_name`` is kept."""
    shaped = drop_columns(report, drops)
    if strip:
        shaped = strip_text(shaped, skip=(id_name,))
    shaped = compact_names(shaped)
    return shaped if id_name in shaped.columns else with_row_id(shaped, id_name)


def anomaly_report_features(
    report: DataFrame, mean: float | Column, std: float | Column, id_name: str = "Id"
) -> DataFrame:
    """Anomaly features straight from the report."""
    return anomaly_features(clean_report(report, ANOMALY_DROPS, strip=True, id_name=id_name), mean, std, id_name)


def days_to_close(records: DataFrame, out: str = "y") -> DataFrame:
    """Add the number of days from creation to closing."""
    return records.withColumn(
        out, days_between(short_date(F.col("CloseDate")), created_at(F.col("CreatedDate")))
    )


def regression_features(report: DataFrame, id_name: str = "Id") -> DataFrame:
    """(id, ``x``, ``y``): hashed fields, amount included as text, and days to close."""
    records = clean_report(report, REGRESSION_DROPS, strip=False, id_name=id_name)
    fields = hashed_fields(records, (id_name, "CreatedDate", "CloseDate"))
    return days_to_close(hash_features(records, fields)).select(name(id_name), "x", "y")


def examples(features: DataFrame, label: str | None = "y", keep: list[str] | None = None) -> DataFrame:
    """Training examples: ``x`` alone, or ``x`` and ``y``, next to the columns to keep."""
    columns = [F.col("x").cast("array<float>").alias("x")]
    if label:
        columns.append(F.col(label).cast("float").alias("y"))
    return features.select(*columns, *(keep or []))


def with_split(df: DataFrame, key: str = "Id", train_percent: int = 90, out: str = "split") -> DataFrame:
    """Mark rows ``train`` or ``test`` by a hash of the key, the same on every run."""
    share = F.conv(F.right(F.md5(name(key).cast("string")), F.lit(6)), 16, 10).cast("int") % 100
    return df.withColumn(out, F.when(share < train_percent, F.lit("train")).otherwise(F.lit("test")))
