"""Record shaping: typed opportunity rows, drops, renames, text cleaning, row ids."""

from __future__ import annotations

from itertools import accumulate
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.functions.columns import compute_once, name
from recordflow.functions.variants import absent, is_number, is_object, kind, number_to_long
from recordflow.schemas import SCORING_RECORD
from recordflow.session import cut_lineage

UNSET = "no"

# Scoring field, event field, JSON type. The order matters, because a field is
# only valid when all fields before it are.
EVENT_FIELDS = [
    ("Id", "Id", "string"),
    ("OpportunityType", "Type", "string"),
    ("Stage", "StageName", "string"),
    ("ForecastCategory", "ForecastCategory", "string"),
    ("Amount", "Amount", "number"),
    ("IsWon", "IsWon", "boolean"),
    ("IsClosed", "IsClosed", "boolean"),
]

# Fields that a write back to the record system does not accept.
READ_ONLY_FIELDS = [
    "LastModifiedDate", "HasOpportunityLineItem", "FiscalYear", "ForecastCategory", "IsClosed",
    "HasOpenActivity", "ExpectedRevenue", "IsWon", "PushCount", "IsDeleted", "FiscalQuarter",
    "Fiscal", "SystemModstamp", "CreatedDate", "LastActivityDate", "HasOverdueTask",
    "LastStageChangeDate", "LastReferencedDate", "LastViewedDate",
]
ID_MARK = "Id"
CUSTOM_MARK = "__c"


def _fits(raw: Column, json_type: str) -> Column:
    test = is_number(raw) if json_type == "number" else kind(raw) == json_type.upper()
    return absent(raw) | F.coalesce(test, F.lit(False))


def _typed(raw: Column, json_type: str) -> tuple[Column, Column]:
    """(value with its default for an absent field, value of an invalid field)."""
    if json_type == "number":
        return F.when(absent(raw), F.lit(0)).otherwise(number_to_long(raw)), F.lit(0)
    if json_type == "boolean":
        return F.coalesce(F.try_variant_get(raw, "$", "boolean"), F.lit(False)), F.lit(False)
    return F.coalesce(F.try_variant_get(raw, "$", "string"), F.lit("")), F.lit(UNSET)


def opportunity_rows(
    df: DataFrame, *, mode: Literal["strict", "lenient"] = "strict", value: str = "value"
) -> DataFrame:
    """Typed 14-field scoring rows from raw change events.

    Adds ``record`` and ``error_message``. ``lenient`` gives every event a row: from the first
    field of a wrong type on, fields keep their unset values. ``strict`` sets
    ``error_message`` for such events instead.
    """
    base = df
    if "doc" not in df.columns:
        base = compute_once(df, doc=F.try_parse_json(F.col(value)))
    sobject = F.variant_get(F.col("doc"), "$.sobject", "variant")
    raws = {
        source: F.variant_get(F.col("doc"), f"$.sobject['{source}']", "variant")
        for _, source, _ in EVENT_FIELDS
    }
    base = compute_once(
        base,
        _object=is_object(sobject),
        _raw=F.struct(*[raw.alias(source) for source, raw in raws.items()]),
        _fits=F.struct(*[_fits(raws[s], t).alias(s) for _, s, t in EVENT_FIELDS]),
    )
    valid = F.col("_object")
    values, bad = {}, F.when(~F.col("_object"), F.lit("sobject: not an object"))
    for target, source, json_type in EVENT_FIELDS:
        valid = valid & F.col(f"_fits.{source}")
        typed, unset = _typed(F.col(f"_raw.{source}"), json_type)
        values[target] = F.when(valid, typed).otherwise(unset)
        bad = bad.when(~F.col(f"_fits.{source}"), F.lit(f"{source}: not {json_type}"))
    record = F.struct(
        *[
            values.get(f.name, F.lit(UNSET)).cast(f.dataType).alias(f.name)
            for f in SCORING_RECORD.fields
        ]
    )
    error = bad if mode == "strict" else F.lit(None).cast("string")
    return compute_once(base, record=record, error_message=error).drop("_object", "_raw", "_fits")


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def strip_text(
    df: DataFrame, pattern: str = "[-/ ]", skip: tuple[str, ...] = ()
) -> DataFrame:
    """Delete every match of ``pattern`` in all text columns but those to skip."""
    return df.select(
        *[
            F.regexp_replace(name(f.name), pattern, "").alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in skip
            else name(f.name)
            for f in df.schema.fields
        ]
    )


def compact_names(df: DataFrame) -> DataFrame:
    """Remove spaces from column names."""
    return df.toDF(*[c.replace(" ", "") for c in df.columns])


def with_row_id(df: DataFrame, id_name: str = "Id", order_by: list[str] | None = None) -> DataFrame:
    """Dense row number from 0: the number of rows in earlier partitions plus the position.

    The rows are checkpointed first, so that counting and numbering see the same partitions.
    Prefer a business key where one exists. ``order_by`` should be unique: equal keys stay in
    one partition.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    row = F.monotonically_increasing_id()
    tagged = cut_lineage(
        df.select("*", F.shiftright(row, 33).alias("_part"), row.bitwiseAND((1 << 33) - 1).alias("_pos"))
    )
    # One number per partition comes to the driver.
    counts = sorted(tagged.groupBy("_part").count().collect())
    starts = [0, *accumulate(n for _, n in counts)]
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(counts, starts)], "_part bigint, _start bigint"
    )
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(id_name, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )


def writable(field: str) -> bool:
    return not (ID_MARK in field or CUSTOM_MARK in field or field in READ_ONLY_FIELDS)


def writable_columns(df: DataFrame) -> DataFrame:
    """Keep the columns that may be written back to the record system."""
    return df.select(*[name(c) for c in df.columns if writable(c)])


def writable_json(doc: Column) -> Column:
    """The members of a JSON object that may be written back, as JSON text.

    Scalars are sent as text, and nulls are left out.
    """
    kept = F.map_filter(
        F.try_variant_get(doc, "$", "map<string,string>"),
        lambda key, member: ~(
            key.contains(ID_MARK) | key.contains(CUSTOM_MARK) | key.isin(READ_ONLY_FIELDS)
        )
        & member.isNotNull(),
    )
    return F.to_json(kept)


def record_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The row as JSON text; NULL members are left out."""
    return F.to_json(F.struct(*[name(c) for c in (columns or df.columns)]))


def anomaly_rows(scored: DataFrame, id_name: str = "Id", label: str = "cluster") -> DataFrame:
    """Rows of the anomaly table; a row without a label is not an anomaly result."""
    return scored.filter(F.col(label).isNotNull()).select(
        F.col(id_name).cast("string").alias("opportunityId"),
        F.col(label).cast("bigint").alias("anomalyCluster"),
    )


def prediction_text(features: Column, prediction: Column) -> Column:
    """Readable result line."""
    return F.format_string("example is %s prediction is %s", features.cast("string"), prediction.cast("string"))
