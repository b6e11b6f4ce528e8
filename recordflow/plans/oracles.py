"""The registered queries in plain SQL, for comparison on another engine."""

from __future__ import annotations

from pyspark.sql import types as T

from recordflow.operators.features import PUBLISHED_AMOUNT_MEAN, PUBLISHED_AMOUNT_STD
from recordflow.plans import hierarchy_sql
from recordflow.schemas import BATCH_TARGET, STREAM_TARGET

MESSAGES = """
parts AS (
  SELECT event_id, ts,
    concat(
      '"event":{"createdDate":"', strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '","replayId":',
      CASE WHEN event_id % 13 = 5 THEN concat('"', event_id, '"') ELSE concat(event_id, '') END,
      ',"type":"',
      CASE WHEN event_id % 31 = 7 THEN 'undeleted' WHEN event_id % 3 = 0 THEN 'created'
           WHEN event_id % 3 = 1 THEN 'updated' ELSE 'deleted' END, '"}') AS header,
    concat(
      '"sobject":{"Id":"', event_id, '","OwnerId":"', user_id,
      '","Type":', CASE WHEN event_id % 41 = 6 THEN '5' ELSE concat('"', event_type, '"') END,
      ',"StageName":',
      CASE WHEN event_id % 7 = 2 THEN 'null' ELSE concat('"stage ', user_id % 9, '"') END,
      ',"ForecastCategory":"', CASE WHEN event_id % 5 = 0 THEN 'Closed' ELSE 'Pipeline' END,
      '","Amount":',
      CASE WHEN event_id % 19 = 2 THEN '"n/a"' WHEN event_id % 11 = 3 THEN concat(user_id, '.5')
           ELSE concat(user_id * 1000 + event_id % 1000, '') END,
      ',"IsWon":', CASE WHEN event_id % 4 = 0 THEN 'true' ELSE 'false' END,
      ',"IsClosed":', CASE WHEN event_id % 43 = 8 THEN '"yes"'
                           WHEN event_id % 4 < 2 THEN 'true' ELSE 'false' END,
      ',"Fiscal":{"Quarter":"', event_id % 4 + 1, '","Year":"2024"}',
      CASE WHEN event_id % 29 = 6 THEN ',"Zeta__x":1' ELSE '' END, '}') AS body
  FROM events
),
messages AS (
  SELECT event_id, ts,
    CASE
      WHEN event_id % 17 = 1 THEN concat('{', body, '}')
      WHEN event_id % 23 = 4 THEN concat('{', body, ',', header, '}')
      WHEN event_id % 37 = 5 THEN concat('[', event_id, ']')
      WHEN event_id % 10 = 3 THEN concat('{', header, ',', body)
      ELSE concat('{', header, ',', body, '}')
    END AS value
  FROM parts
),
docs AS (
  SELECT event_id, ts, value, CASE WHEN json_valid(value) THEN value::JSON END AS doc FROM messages
),
routed AS (
  SELECT *,
    coalesce(doc->'$.sobject', doc) AS payload,
    CASE WHEN doc IS NULL THEN 'invalid JSON: ' || value
         WHEN json_type(coalesce(doc->'$.sobject', doc)) <> 'OBJECT' THEN 'not an object'
    END AS error_message
  FROM docs
),
offsets AS (
  SELECT event_id,
    CASE WHEN json_type(doc, '$.event.replayId') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
         THEN trunc((doc->>'$.event.replayId')::DOUBLE)::BIGINT ELSE 0 END AS replay_id
  FROM docs
),
checked AS (
  SELECT event_id, payload,
    CASE WHEN (payload->>'$.IsClosed') NOT IN ('true', 'false') THEN 'IsClosed: not BOOLEAN' END AS c1,
    CASE WHEN NOT regexp_full_match((payload->>'$.Amount'), '[+-]?[0-9]+') THEN 'Amount: not INTEGER' END
      AS c2,
    CASE WHEN (payload->'$.Zeta__x') IS NOT NULL THEN 'Zeta__x: unknown field' END AS c3
  FROM routed WHERE error_message IS NULL
)
"""

OPPORTUNITY = """
opportunity AS (
  SELECT o_orderkey::VARCHAR AS Id,
    CASE WHEN o_custkey % 2 = 0 THEN 'Customer' ELSE 'Partner' END AS AccountType,
    floor(o_totalprice)::BIGINT AS Amount, n_name AS BillingCountry,
    o_orderstatus <> 'O' AS IsClosed,
    CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Best Case' ELSE 'Pipeline' END
      AS ForecastCategory,
    'Industry ' || (o_custkey % 20) AS Industry,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Web' WHEN o_orderkey % 4 = 1 THEN 'Phone / Mail'
         ELSE 'Partner Referral' END AS OpportunitySource,
    CASE WHEN o_orderkey % 3 = 0 THEN 'New / Logo' ELSE 'Existing - Upgrade' END AS OpportunityType,
    'Role ' || (o_custkey % 3) AS OwnerRole,
    CASE WHEN o_orderkey % 13 <> 0 THEN 'Family ' || (o_orderkey % 5) END AS ProductFamily,
    c_mktsegment AS Segment, o_orderpriority AS Stage, o_orderstatus = 'F' AS IsWon,
    o_orderdate AS CreatedDate, o_orderkey, o_custkey, c_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
report AS (
  SELECT *,
    CreatedDate + to_seconds((o_orderkey % 86400)::DOUBLE) AS created,
    CreatedDate + to_days((o_orderkey % 200 - 20)::INT) AS closed
  FROM opportunity
),
dated AS (
  SELECT *, CASE WHEN o_orderkey % 97 <> 0 THEN closed::DATE END AS close_date,
    CASE WHEN o_orderkey % 97 = 0 THEN 'open'
         ELSE concat(month(closed), '/', day(closed), '/', right(year(closed)::VARCHAR, 2)) END
      AS close_text,
    CASE WHEN o_orderkey % 97 <> 0
         THEN floor((epoch_us(date_trunc('day', closed)) - epoch_us(created)) / 86400000000.0)::BIGINT END
      AS days
  FROM report
)
"""


def _bucket(text: str, n: int = 64) -> str:
    return f"(('0x' || right(md5({text}), 2))::INT & {n - 1})"


def _flag(column: str) -> str:
    return f"CASE WHEN {column} THEN 'True' ELSE 'False' END"


def _buckets(texts: list[str], n: int = 64) -> str:
    values = ", ".join(f"coalesce({t}, 'nan')" for t in texts)
    return f"list_transform([{values}], lambda t: {_bucket('t', n)})"


def _counts(n: int = 64) -> str:
    """Counts per bucket of the list column ``b``."""
    return f"list_transform(range({n}), lambda i: len(list_filter(b, lambda v: v = i)))"


def _hashed(source: str, texts: list[str], n: int = 64) -> str:
    """CTE ``hashed``: the rows of ``source`` with their buckets as ``b``."""
    return f"hashed AS (SELECT *, {_buckets(texts, n)} AS b FROM {source})"


def _clean(text: str) -> str:
    return f"regexp_replace({text}, '[-/ ]', '', 'g')"


_TEXTS = [
    "AccountType", "BillingCountry", "ForecastCategory", "Industry", "OpportunitySource",
    "OpportunityType", "OwnerRole", "ProductFamily", "Segment", "Stage",
]
_FLAGS = [_flag("IsClosed"), _flag("IsWon")]
_Z = f"round((Amount::DOUBLE - {PUBLISHED_AMOUNT_MEAN!r}) / {PUBLISHED_AMOUNT_STD!r}, 9)"
_HASHED = _hashed("opportunity", _TEXTS + _FLAGS)
_REGRESSION = _hashed("dated", _TEXTS + _FLAGS + ["Amount::VARCHAR"])
_SPLIT = "CASE WHEN ('0x' || right(md5({}), 6))::INT % 100 < 90 THEN 'train' ELSE 'test' END"

# (event field, scoring field, accepted JSON types)
_NUMBER = "('BIGINT', 'UBIGINT', 'DOUBLE')"
_FITS = [
    ("Id", "('VARCHAR')", "string"),
    ("Type", "('VARCHAR')", "string"),
    ("StageName", "('VARCHAR')", "string"),
    ("ForecastCategory", "('VARCHAR')", "string"),
    ("Amount", _NUMBER, "number"),
    ("IsWon", "('BOOLEAN')", "boolean"),
    ("IsClosed", "('BOOLEAN')", "boolean"),
]


def _typed() -> str:
    fits = ", ".join(
        f"coalesce(json_type(doc, '$.sobject.{f}') IN {t} OR json_type(doc, '$.sobject.{f}') = 'NULL', true)"
        f" AS fit_{f}"
        for f, t, _ in _FITS
    )
    valid, steps = "is_object", []
    for f, _, _ in _FITS:
        valid += f" AND fit_{f}"
        steps.append(f"({valid}) AS ok_{f}")
    error = "CASE WHEN NOT is_object THEN 'sobject: not an object' " + " ".join(
        f"WHEN NOT fit_{f} THEN '{f}: not {kind}'" for f, _, kind in _FITS
    )
    return f"""
fits AS (
  SELECT event_id, doc, coalesce(json_type(doc, '$.sobject') = 'OBJECT', false) AS is_object, {fits} FROM docs
),
valid AS (SELECT *, {", ".join(steps)}, {error} END AS error_message FROM fits),
typed AS (
  SELECT event_id, error_message,
    CASE WHEN ok_Id THEN coalesce(doc->>'$.sobject.Id', '') ELSE 'no' END AS "Id",
    CASE WHEN ok_Amount THEN coalesce(trunc((doc->>'$.sobject.Amount')::DOUBLE)::BIGINT, 0) ELSE 0 END
      AS "Amount",
    CASE WHEN ok_IsClosed THEN coalesce((doc->>'$.sobject.IsClosed')::BOOLEAN, false) ELSE false END
      AS "IsClosed",
    CASE WHEN ok_ForecastCategory THEN coalesce(doc->>'$.sobject.ForecastCategory', '') ELSE 'no' END
      AS "ForecastCategory",
    CASE WHEN ok_Type THEN coalesce(doc->>'$.sobject.Type', '') ELSE 'no' END AS "OpportunityType",
    CASE WHEN ok_StageName THEN coalesce(doc->>'$.sobject.StageName', '') ELSE 'no' END AS "Stage",
    CASE WHEN ok_IsWon THEN coalesce((doc->>'$.sobject.IsWon')::BOOLEAN, false) ELSE false END AS "IsWon"
  FROM valid
)"""


_CHECK = "concat_ws('; ', c2, c1)"
_GOOD_ROWS = "FROM checked WHERE c1 IS NULL AND c2 IS NULL"
_KEPT = """list_filter(json_keys(payload), lambda k: NOT (contains(k, 'Id') OR contains(k, '__c')
  OR k IN ('ForecastCategory', 'IsClosed', 'IsWon', 'Fiscal'))
  AND json_extract_string(payload, '$.' || k) IS NOT NULL)"""

# A rejected record as JSON text: its members in the order of their names.
_MEMBERS = "Amount Fiscal ForecastCategory Id IsClosed IsWon OwnerId StageName Type Zeta__x".split()
_PAYLOAD_TEXT = "'{' || concat_ws(',', " + ", ".join(
    f"'\"{m}\":' || (checked.payload->'$.{m}')::VARCHAR" for m in _MEMBERS
) + ") || '}'"


def _event_columns() -> str:
    """Every column of the stream target, read from ``payload``."""
    def column(f: T.StructField) -> str:
        path = f"checked.payload->>'$.{f.name}'"
        if isinstance(f.dataType, T.StructType):
            return f"(checked.payload->'$.{f.name}')::VARCHAR AS \"{f.name}\""
        kind = {"bigint": "BIGINT", "boolean": "BOOLEAN"}.get(f.dataType.simpleString(), "VARCHAR")
        return f"({path})::{kind} AS \"{f.name}\""

    return ", ".join(map(column, STREAM_TARGET.fields))


def _batch_columns() -> str:
    """Every column of the batch target; the extract has a few of them."""
    known = {
        "Id": "Id", "Amount": "Amount::VARCHAR", "StageName": "Stage", "IsWon": "IsWon::VARCHAR",
        "IsClosed": "IsClosed::VARCHAR", "Name": "ProductFamily", "CreatedDate": "strftime(CreatedDate, '%Y-%m-%d %H:%M:%S')",
    }
    return ", ".join(f"{known.get(f.name, 'NULL::VARCHAR')} AS \"{f.name}\"" for f in BATCH_TARGET.fields)


ORACLES = {
    "route_messages": f"""WITH {MESSAGES} SELECT event_id,
        CASE WHEN error_message IS NULL THEN 'good' ELSE 'failed' END AS route, error_message,
        CASE WHEN error_message IS NULL THEN payload->>'$.Id' END AS id FROM routed""",
    "replay_offset": f"WITH {MESSAGES} SELECT event_id, replay_id FROM offsets",
    "start_offset": f"""WITH {MESSAGES} SELECT event_id, replay_id FROM offsets
        WHERE replay_id >= 100 OR replay_id = 0""",
    "change_kind": f"""WITH {MESSAGES} SELECT event_id FROM docs
        WHERE coalesce(doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted')""",
    "extract_payload": f"""WITH {MESSAGES} SELECT event_id, payload->>'$.Id' AS id,
        payload->>'$.OwnerId' AS owner, payload->>'$.Type' AS type, payload->>'$.StageName' AS stage,
        payload->>'$.Amount' AS amount, payload->>'$.Fiscal.Quarter' AS quarter,
        coalesce(json_type(payload, '$.event') = 'OBJECT', false) AS has_event FROM routed""",
    "dead_letter_rows": f"""WITH {MESSAGES} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS stamp,
        value AS payload_string, hex(encode(value)) AS payload_hex, 0 AS n_attributes, error_message,
        NULL::VARCHAR AS stacktrace FROM routed WHERE error_message IS NOT NULL""",
    "conform_ignore": f"""WITH {MESSAGES} SELECT {_event_columns()} {_GOOD_ROWS}""",
    "conform_reject": f"""WITH {MESSAGES} SELECT event_id, concat_ws('; ', c2, c1, c3) AS error_message
        FROM checked WHERE c1 IS NOT NULL OR c2 IS NOT NULL OR c3 IS NOT NULL""",
    "union_errors": f"""WITH {MESSAGES} SELECT event_id, error_message FROM routed
        WHERE error_message IS NOT NULL UNION ALL
        SELECT event_id, {_CHECK} FROM checked WHERE c1 IS NOT NULL OR c2 IS NOT NULL""",
    "batch_append": f"""WITH {OPPORTUNITY} SELECT {_batch_columns()} FROM opportunity""",
    "batch_job": f"""WITH {OPPORTUNITY} SELECT Id AS "Id", Stage AS "StageName", Amount::VARCHAR AS "Amount",
        IsWon::VARCHAR AS "IsClosed", NULL::VARCHAR AS "IsWon" FROM opportunity WHERE Amount > 50000
        AND CreatedDate >= TIMESTAMP '1994-01-01' AND CreatedDate < TIMESTAMP '1997-01-01'""",
    "json_lines_scan": """WITH lines AS (
          SELECT [1, 2, 4, 5, 6][c_custkey % 5 + 1] AS number, c_name,
            CASE WHEN c_custkey % 50 = 3 THEN 'not a JSON object: ' || left('{"Id":' || c_custkey || ',"Name":"' || c_name, 10)
            END AS error FROM customer)
        SELECT number, 'record' AS kind, CASE WHEN error IS NULL THEN c_name END AS name, error AS status, 1 AS records
        FROM lines
        UNION ALL SELECT number, 'file', NULL, CASE WHEN count(error) > 0 THEN 'corrupt' ELSE 'read' END,
          count(*) * 1000 + count(error) FROM lines GROUP BY number
        UNION ALL SELECT 3, 'file', NULL, 'missing', 0""",
    "stream_ingest": f"""WITH {MESSAGES} SELECT {_event_columns()}
        FROM checked JOIN docs USING (event_id) WHERE c1 IS NULL AND c2 IS NULL
        AND coalesce(doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted')""",
    "stream_two_feeds": f"""WITH {MESSAGES},
        kept AS (SELECT * FROM routed
          WHERE coalesce(doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted'))
        SELECT payload->>'$.Id' AS id, NULL::VARCHAR AS error_message FROM checked JOIN docs USING (event_id)
        WHERE c1 IS NULL AND c2 IS NULL
        AND coalesce(doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted')
        UNION ALL SELECT NULL, error_message FROM kept WHERE error_message IS NOT NULL
        UNION ALL SELECT NULL, {_CHECK} FROM checked JOIN kept USING (event_id)
        WHERE c1 IS NOT NULL OR c2 IS NOT NULL""",
    "stream_replay": f"""WITH {MESSAGES},
        kept AS (SELECT * FROM routed
          WHERE coalesce(doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted'))
        SELECT payload->>'$.Id' AS id, NULL::VARCHAR AS error_message FROM checked JOIN docs USING (event_id)
        WHERE c1 IS NULL AND c2 IS NULL
        AND coalesce(doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted')
        UNION ALL SELECT NULL, error_message FROM kept WHERE error_message IS NOT NULL
        UNION ALL SELECT NULL, {_CHECK} FROM checked JOIN kept USING (event_id)
        WHERE c1 IS NOT NULL OR c2 IS NOT NULL""",
    "stream_labels": f"""WITH {MESSAGES}, {_typed()},
        kept AS (SELECT typed.* FROM typed JOIN docs USING (event_id)
          WHERE coalesce(docs.doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted'))
        SELECT CASE WHEN error_message IS NULL THEN "Id" END AS id, error_message,
          CASE WHEN error_message IS NULL THEN true END AS as_batch FROM kept""",
    "write_back": """SELECT '{"Name":"' || c_name || '","Segment":"' || c_mktsegment || '"}' AS value,
        CASE WHEN c_name LIKE '%7' THEN 0 ELSE 1 END AS times,
        CASE WHEN c_name LIKE '%7' THEN 'ValueError: refused' END AS error_message FROM customer""",
    "conform_types": """WITH checked AS (
          SELECT *, concat_ws('; ',
            CASE WHEN o_orderkey % 7 = 0 THEN 'd: not DATE' END,
            CASE WHEN round(o_totalprice, 2) >= 100000 THEN 'e: not DECIMAL' END,
            CASE WHEN o_orderkey * 1000003 > 2147483647 THEN 'n: not INTEGER' END,
            CASE WHEN o_custkey * 10 > 32767 THEN 'tags[1]: not INTEGER' END) AS violations FROM orders)
        SELECT o_orderkey, violations,
          CASE WHEN violations = '' THEN (o_orderkey * 1000003)::INTEGER END AS n,
          CASE WHEN violations = '' THEN strftime(o_orderdate, '%Y-%m-%d') END AS d,
          CASE WHEN violations = '' THEN round(o_totalprice * 100)::BIGINT END AS cents,
          CASE WHEN violations = '' THEN (o_orderkey % 200) || ',' || (o_custkey * 10) END AS tags
        FROM checked""",
    "stream_dead_letters": f"""WITH {MESSAGES},
        kept AS (SELECT * FROM routed
          WHERE coalesce(doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted'))
        SELECT error_message, value AS payload, true AS same_bytes FROM kept WHERE error_message IS NOT NULL UNION ALL
        SELECT {_CHECK}, {_PAYLOAD_TEXT}, true FROM checked JOIN kept USING (event_id)
        WHERE c1 IS NOT NULL OR c2 IS NOT NULL""",
    "stream_text": f"""WITH {MESSAGES} SELECT value FROM docs
        WHERE coalesce(doc->>'$.event.type', 'created') IN ('created', 'updated', 'deleted')""",
    "typed_projection_lenient": f"""WITH {MESSAGES}, {_typed()}
        SELECT event_id, "Id", 'no' AS "AccountType", "Amount", 'no' AS "BillingCountry", "IsClosed",
        "ForecastCategory", 'no' AS "Industry", 'no' AS "OpportunitySource", "OpportunityType",
        'no' AS "OwnerRole", 'no' AS "ProductFamily", 'no' AS "Segment", "Stage", "IsWon" FROM typed""",
    "typed_projection_strict": f"""WITH {MESSAGES}, {_typed()}
        SELECT event_id, error_message, "Id", "Amount" FROM typed""",
    "scan_range": """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-07-01'""",
    "scan_window": """SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01' - INTERVAL 30 HOUR - INTERVAL 9612 HOUR
        AND o_orderdate < TIMESTAMP '1998-01-01' - INTERVAL 30 HOUR""",
    "sql_scan": f"""WITH {OPPORTUNITY} SELECT Id AS "Id", Amount AS "Amount", Stage AS "Stage"
        FROM opportunity WHERE IsWon AND Amount > 100000""",
    "drop_columns": f"""WITH {OPPORTUNITY} SELECT
        'Account Type|Amount|Billing Country|Closed|Forecast Category|Id|Industry|Opportunity Source|'
        || 'Opportunity Type|Owner Role|Product Family|Segment|Stage|Won' AS kept,
        o_orderkey AS id, AccountType AS account_type, Amount AS amount, Stage AS stage FROM dated""",
    "strip_text": f"""WITH {OPPORTUNITY} SELECT o_orderkey AS "Id",
        {_clean("OpportunityType")} AS opportunity_type,
        {_clean("OpportunitySource")} AS opportunity_source,
        {_clean("strftime(created, '%Y-%m-%dT%H:%M:%S.%gZ')")} AS created,
        {_clean("Stage")} AS stage, Amount AS amount FROM dated""",
    "rename_columns": f"""WITH {OPPORTUNITY} SELECT o_orderkey AS "Id",
        'Deal ' || o_orderkey AS "OpportunityName", AccountType AS "AccountType",
        close_text AS "CloseDate",
        CASE WHEN o_custkey % 3 = 0 THEN 'State ' || (o_custkey % 20) END AS "BillingState/Province"
        FROM dated""",
    "row_id": """SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id
        FROM orders""",
    "record_to_json": """SELECT o_orderkey, concat('{"o_orderkey":', o_orderkey, ',"o_custkey":', o_custkey,
        ',"o_orderstatus":"', o_orderstatus, '","o_orderpriority":"', o_orderpriority, '"}') AS record
        FROM orders""",
    "restricted_fields": f"""WITH {MESSAGES} SELECT event_id, '{{' || array_to_string(list_transform(
        list_sort({_KEPT}),
        lambda k: '"' || k || '":"' || json_extract_string(payload, '$.' || k) || '"'), ',') || '}}'
        AS record FROM routed WHERE error_message IS NULL""",
    "hash_features": f"""WITH {OPPORTUNITY}, {_HASHED} SELECT Id AS "Id", array_to_string({_counts()}, ',') AS x
        FROM hashed""",
    "zscore": f"""WITH {OPPORTUNITY} SELECT Id AS "Id", {_Z} AS amount_z FROM opportunity""",
    "scale_params": """SELECT round(avg(o_totalprice), 3) AS mean, round(stddev_samp(o_totalprice), 3) AS std
        FROM orders""",
    "parse_dates": f"""WITH {OPPORTUNITY} SELECT o_orderkey AS "Id",
        strftime(created, '%Y-%m-%d %H:%M:%S') AS created, close_date::VARCHAR AS closed FROM dated""",
    "days_to_close": f"""WITH {OPPORTUNITY} SELECT o_orderkey AS "Id", days FROM dated""",
    "regression_features": f"""WITH {OPPORTUNITY}, {_REGRESSION} SELECT o_orderkey AS "Id",
        array_to_string({_counts()}, ',') AS x, days AS y FROM hashed""",
    "anomaly_features": f"""WITH {OPPORTUNITY}, {
        _hashed("dated", [_clean(t) for t in _TEXTS] + _FLAGS)} SELECT o_orderkey AS "Id",
        array_to_string({_counts()}, ',') AS x, {_Z} AS amount_z FROM hashed""",
    "examples": f"""WITH {OPPORTUNITY}, {_REGRESSION} SELECT array_to_string({_counts()}, ',') AS x, days AS y,
        {_SPLIT.format("o_orderkey::VARCHAR")} AS split FROM hashed WHERE days IS NOT NULL""",
    "split": f"""WITH {OPPORTUNITY} SELECT Id AS "Id", {_SPLIT.format("Id")} AS split FROM opportunity""",
    "result_rows": """SELECT o_orderkey::VARCHAR AS "opportunityId", o_orderkey % 6 - 1 AS "anomalyCluster"
        FROM orders WHERE o_orderkey % 11 <> 0""",
    "prediction_text": f"""WITH {OPPORTUNITY}, {
        _hashed("dated", ["AccountType", "Stage", _flag("IsWon")], 8)} SELECT o_orderkey AS "Id",
        'example is ' || ({_counts(8)})::VARCHAR || ' prediction is ' || days AS line
        FROM hashed WHERE days IS NOT NULL""",
    "csv_report": f"""WITH {OPPORTUNITY} SELECT 'Deal ' || o_orderkey AS "OpportunityName",
        CASE WHEN o_custkey % 3 = 0 THEN 'State ' || (o_custkey % 20) END AS "BillingState/Province",
        AccountType AS "AccountType", 'Owner ' || (o_custkey % 16) AS "AccountOwner",
        'Product ' || (o_orderkey % 15) AS "ProductName", Amount AS "Amount", (o_orderkey % 1000000)::INT AS "Number",
        c_name AS "AccountName", BillingCountry AS "BillingCountry", close_text AS "CloseDate", IsClosed AS "Closed",
        strftime(created, '%Y-%m-%dT%H:%M:%S.%gZ') AS "CreatedDate", ForecastCategory AS "ForecastCategory",
        Industry AS "Industry", 'Owner ' || (o_orderkey % 17) AS "OpportunityOwner",
        OpportunitySource AS "OpportunitySource", OpportunityType AS "OpportunityType", OwnerRole AS "OwnerRole",
        ProductFamily AS "ProductFamily", Segment AS "Segment", Stage AS "Stage", IsWon AS "Won" FROM dated""",
    "head_sample": f"""WITH {OPPORTUNITY} SELECT o_orderkey AS "Id", 'Deal ' || o_orderkey AS opportunity_name,
        Amount AS "Amount" FROM dated ORDER BY Amount, o_orderkey LIMIT 2""",
    "batch_infer": f"""WITH {OPPORTUNITY}, {_HASHED} SELECT Id AS "Id",
        list_sum(list_transform({_counts()}, lambda c, i: c * ((i - 1) % 7 - 3)))::DOUBLE + 0.5 AS score
        FROM hashed""",
    "cluster_fit": """WITH RECURSIVE
        p AS (SELECT c_custkey AS id, c_acctbal / 100.0::DOUBLE AS x, c_nationkey::DOUBLE * 2 AS y FROM customer),
        near AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b
          ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 2.25::DOUBLE),
        core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 4),
        edges AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
        reach(id, seen) AS (SELECT id, id FROM core UNION
          SELECT e.b, r.seen FROM reach r JOIN edges e ON e.a = r.id)
        SELECT p.id, min(seen) AS cluster FROM p LEFT JOIN reach ON reach.id = p.id GROUP BY p.id""",
    "cluster_tree": hierarchy_sql.LABELS,
    "cluster_predict": hierarchy_sql.PREDICTED,
}
