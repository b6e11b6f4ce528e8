"""Record-shaped views over the star-schema tables, used by the registered queries and tests.

Text is built from integers and text only, so that any SQL engine builds the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordflow.sources.batch import spread

# One change event per row of ``events``, with faults planted by the event id.
MESSAGES = """
SELECT
  event_id, ts,
  concat(
    CASE
      WHEN event_id % 17 = 1 THEN concat('{', body, '}')
      WHEN event_id % 23 = 4 THEN concat('{', body, ',', header, '}')
      WHEN event_id % 37 = 5 THEN concat('[', event_id, ']')
      WHEN event_id % 10 = 3 THEN concat('{', header, ',', body)
      ELSE concat('{', header, ',', body, '}')
    END
  ) AS value
FROM (
  SELECT
    event_id, ts,
    concat(
      '"event":{"createdDate":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
      '","replayId":',
      CASE WHEN event_id % 13 = 5 THEN concat('"', event_id, '"') ELSE concat(event_id, '') END,
      ',"type":"',
      CASE WHEN event_id % 31 = 7 THEN 'undeleted'
           WHEN event_id % 3 = 0 THEN 'created'
           WHEN event_id % 3 = 1 THEN 'updated' ELSE 'deleted' END,
      '"}') AS header,
    concat(
      '"sobject":{"Id":"', event_id, '","OwnerId":"', user_id,
      '","Type":', CASE WHEN event_id % 41 = 6 THEN '5' ELSE concat('"', event_type, '"') END,
      ',"StageName":',
      CASE WHEN event_id % 7 = 2 THEN 'null' ELSE concat('"stage ', user_id % 9, '"') END,
      ',"ForecastCategory":"', CASE WHEN event_id % 5 = 0 THEN 'Closed' ELSE 'Pipeline' END,
      '","Amount":',
      CASE WHEN event_id % 19 = 2 THEN '"n/a"'
           WHEN event_id % 11 = 3 THEN concat(user_id, '.5')
           ELSE concat(user_id * 1000 + event_id % 1000, '') END,
      ',"IsWon":', CASE WHEN event_id % 4 = 0 THEN 'true' ELSE 'false' END,
      ',"IsClosed":', CASE WHEN event_id % 43 = 8 THEN '"yes"'
                           WHEN event_id % 4 < 2 THEN 'true' ELSE 'false' END,
      ',"Fiscal":{"Quarter":"', event_id % 4 + 1, '","Year":"2024"}',
      CASE WHEN event_id % 29 = 6 THEN ',"Zeta__x":1' ELSE '' END,
      '}') AS body
  FROM {events}
)
"""

# The opportunity object: one row per order.
OPPORTUNITY = """
SELECT
  concat(o_orderkey, '') AS Id,
  CASE WHEN o_custkey % 2 = 0 THEN 'Customer' ELSE 'Partner' END AS AccountType,
  CAST(floor(o_totalprice) AS BIGINT) AS Amount,
  n_name AS BillingCountry,
  o_orderstatus <> 'O' AS IsClosed,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Best Case' ELSE 'Pipeline' END
    AS ForecastCategory,
  concat('Industry ', o_custkey % 20) AS Industry,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Web' WHEN o_orderkey % 4 = 1 THEN 'Phone / Mail'
       ELSE 'Partner Referral' END AS OpportunitySource,
  CASE WHEN o_orderkey % 3 = 0 THEN 'New / Logo' ELSE 'Existing - Upgrade' END
    AS OpportunityType,
  concat('Role ', o_custkey % 3) AS OwnerRole,
  CASE WHEN o_orderkey % 13 <> 0 THEN concat('Family ', o_orderkey % 5) END AS ProductFamily,
  c_mktsegment AS Segment,
  o_orderpriority AS Stage,
  o_orderstatus = 'F' AS IsWon,
  o_orderdate AS CreatedDate,
  o_orderkey, o_custkey, c_name
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

# The same rows in the shape of the exported report, with the business key as ``Id``.
REPORT = """
SELECT
  concat('Deal ', o_orderkey) AS `Opportunity Name`,
  CASE WHEN o_custkey % 3 = 0 THEN concat('State ', o_custkey % 20) END
    AS `Billing State/Province`,
  AccountType AS `Account Type`,
  concat('Owner ', o_custkey % 16) AS `Account Owner`,
  concat('Product ', o_orderkey % 15) AS `Product Name`,
  Amount,
  CAST(o_orderkey % 1000000 AS INT) AS `#`,
  c_name AS `Account Name`,
  BillingCountry AS `Billing Country`,
  CASE WHEN o_orderkey % 97 = 0 THEN 'open'
       ELSE concat(month(closed), '/', day(closed), '/', right(concat(year(closed), ''), 2)) END
    AS `Close Date`,
  IsClosed AS `Closed`,
  date_format(created, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") AS `Created Date`,
  ForecastCategory AS `Forecast Category`,
  Industry,
  concat('Owner ', o_orderkey % 17) AS `Opportunity Owner`,
  OpportunitySource AS `Opportunity Source`,
  OpportunityType AS `Opportunity Type`,
  OwnerRole AS `Owner Role`,
  ProductFamily AS `Product Family`,
  Segment, Stage,
  IsWon AS `Won`,
  o_orderkey AS Id
FROM (
  SELECT *,
    CreatedDate + make_dt_interval(0, 0, 0, o_orderkey % 86400) AS created,
    CreatedDate + make_dt_interval(CAST(o_orderkey % 200 - 20 AS INT)) AS closed
  FROM {opportunity}
)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(_braces(MESSAGES, "events"), events=events)


def opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {t: table(spark, sf_dir, t) for t in ("orders", "customer", "nation")}
    frames["orders"] = spread(frames["orders"])
    return spark.sql(OPPORTUNITY, **frames)


def scoring_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14 fields of the scoring record."""
    return opportunity(spark, sf_dir).drop("CreatedDate", "o_orderkey", "o_custkey", "c_name")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REPORT, opportunity=opportunity(spark, sf_dir))


def _braces(text: str, *frames: str) -> str:
    """Escape literal braces for the formatter of ``spark.sql``."""
    escaped = text.replace("{", "{{").replace("}", "}}")
    for frame in frames:
        escaped = escaped.replace("{{" + frame + "}}", "{" + frame + "}")
    return escaped
