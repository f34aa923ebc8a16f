"""The supplied tables, and flow-shaped views of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import to_ms
from tidemark.session import literal_table

DAY_MS = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` in epoch milliseconds."""
    return table(spark, sf_dir, "events").withColumn("ts", to_ms("ts"))


# Events as network flows: the event type decides the app, ``props`` the port.
FLOW_COLUMNS = {
    "timestamp": "cast(ts as timestamp)",
    "ipProto": "case when event_type = 'signup' then 17 else 6 end",
    "serverPort": "cast(case when k < 25 then 443 when k < 50 then 80 else 8000 + k end as bigint)",
    "appName": """case event_type when 'click' then 'http-click' when 'view' then 'cdn.example.com'
        when 'purchase' then 'purchase' when 'signup' then 'Unknown'
        else concat('host:', cast(k as string)) end""",
    "clientBytesSent": "cast(round(value * 100) as bigint)",
    "serverBytesSent": "cast(k * 10 as bigint)",
    "clientPacketsSent": "cast(k as bigint)",
    "serverPacketsSent": "cast(k + 1 as bigint)",
    "clientMac": "case when value >= 5 then concat('u', cast(user_id as string)) end",
    "serverMac": "case when k >= 10 then concat('s', cast(k as string)) end",
    "clientMacDCS": "concat('u', cast(user_id as string))",
    "serverMacDCS": "case when k < 5 then 's5' end",
}

FLOWS_SQL = """
flows AS (
  SELECT ts AS "timestamp",
    CASE WHEN event_type = 'signup' THEN 17 ELSE 6 END AS ipProto,
    CAST(CASE WHEN k < 25 THEN 443 WHEN k < 50 THEN 80 ELSE 8000 + k END AS BIGINT) AS serverPort,
    CASE event_type WHEN 'click' THEN 'http-click' WHEN 'view' THEN 'cdn.example.com'
      WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'Unknown' ELSE 'host:' || k END AS appName,
    CAST(round(value * 100) AS BIGINT) AS clientBytesSent,
    CAST(k * 10 AS BIGINT) AS serverBytesSent,
    CAST(k AS BIGINT) AS clientPacketsSent, CAST(k + 1 AS BIGINT) AS serverPacketsSent,
    CASE WHEN value >= 5 THEN 'u' || user_id END AS clientMac,
    CASE WHEN k >= 10 THEN 's' || k END AS serverMac,
    'u' || user_id AS clientMacDCS,
    CASE WHEN k < 5 THEN 's5' END AS serverMacDCS
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
),
endpoints AS (
  SELECT 'u' || c_custkey AS macAddress, c_mktsegment AS logicalClass, c_name AS uuid FROM customer
  UNION ALL
  SELECT 's' || s_suppkey, CASE WHEN s_acctbal > 2000 THEN 'SERVER' ELSE 'IDLE' END, s_name FROM supplier
),
taxonomy AS (
  SELECT * FROM (VALUES ('purchase', true), ('http-click', true), ('view', false)) t(appName, isInTaxonomy)
),
registry AS (
  SELECT CAST(6 + 11 * (n_regionkey % 2) AS INTEGER) AS ipProto,
    CAST(8050 + n_nationkey * 2 AS VARCHAR) AS port, 'svc-' || n_name AS appName FROM nation
  UNION ALL SELECT 17, '443', 'quic-' || r_name FROM region
  UNION ALL SELECT 6, '8000-8010', r_name FROM region
)"""

ACTIVE_CLASSES = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY", "SERVER")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").withColumn("k", k)
    return events.selectExpr(*[f"{expr} as {name}" for name, expr in FLOW_COLUMNS.items()])


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "concat('u', c_custkey) as macAddress", "c_mktsegment as logicalClass", "c_name as uuid"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "concat('s', s_suppkey) as macAddress",
        "case when s_acctbal > 2000 then 'SERVER' else 'IDLE' end as logicalClass",
        "s_name as uuid",
    )
    return customers.unionByName(suppliers)


def taxonomy(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark, [("purchase", True), ("http-click", True), ("view", False)],
        "appName string, isInTaxonomy boolean",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "nation")
        .selectExpr(
            "6 + 11 * (n_regionkey % 2) as ipProto",
            "cast(8050 + n_nationkey * 2 as string) as port",
            "concat('svc-', n_name) as appName",
        )
        .unionByName(regions.selectExpr("17 as ipProto", "'443' as port", "concat('quic-', r_name) as appName"))
        .unionByName(regions.selectExpr("6 as ipProto", "'8000-8010' as port", "r_name as appName"))
    )


# The app-name rules as SQL over (appName, ipProto, serverPort, known).
NAME_RULES_SQL = r"""
CASE WHEN (contains(appName, '.') OR regexp_matches(appName, '^.*:\d+(?:_(?:UDP|TCP))?$'))
       AND ipProto = 6 AND serverPort = 443 THEN 'https'
     WHEN (contains(appName, '.') OR regexp_matches(appName, '^.*:\d+(?:_(?:UDP|TCP))?$'))
       AND ipProto = 6 AND serverPort = 80 THEN 'http'
     WHEN contains(appName, 'over-http') AND ipProto <> 6 THEN 'unknown'
     WHEN contains(appName, 'over-http') THEN
       split_part(CASE WHEN starts_with(appName, 'ssl-') THEN 'ssl'
                       WHEN starts_with(appName, 'http-') THEN 'http' ELSE appName END, 'over-http', 1)
       || 'over-http'
     WHEN starts_with(appName, 'ssl-') AND ipProto = 6 THEN 'ssl'
     WHEN starts_with(appName, 'http-') AND ipProto = 6 THEN 'http'
     WHEN NOT known AND ipProto = 6 AND contains(appName, '.')
       AND NOT regexp_matches(appName, '^.*:\d+(?:_(?:UDP|TCP))?$') THEN 'ssl'
     WHEN NOT known THEN 'unknown'
     ELSE appName END"""

RESOLVED_SQL = FLOWS_SQL + f""",
exact AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY clientMac, serverMac, clientMacDCS, serverMacDCS, ipProto, serverPort, appName, clientBytesSent
      ORDER BY "timestamp", serverBytesSent, clientPacketsSent, serverPacketsSent) AS rn FROM flows) WHERE rn = 1
),
merged AS (
  SELECT clientMac, serverMac, ipProto, serverPort, appName, (epoch_us("timestamp") // 1000) // 60000 AS minute,
    max(clientBytesSent) AS clientBytesSent, max(serverBytesSent) AS serverBytesSent,
    max("timestamp") AS "timestamp",
    arg_min(clientMacDCS, {{'a': "timestamp", 'v': clientMacDCS}}) FILTER (WHERE clientMacDCS IS NOT NULL) AS clientMacDCS,
    arg_min(serverMacDCS, {{'a': "timestamp", 'v': serverMacDCS}}) FILTER (WHERE serverMacDCS IS NOT NULL) AS serverMacDCS
  FROM exact GROUP BY ALL
),
sides AS (
  SELECT "timestamp", ipProto, serverPort, appName, clientBytesSent, serverBytesSent,
    coalesce(serverMac, serverMacDCS) AS mac, 'server' AS side FROM merged
  UNION ALL
  SELECT "timestamp", ipProto, serverPort, appName, clientBytesSent, serverBytesSent,
    coalesce(clientMac, clientMacDCS), 'client' FROM merged
),
named AS (
  SELECT s.* EXCLUDE (appName), e.logicalClass, e.uuid, {NAME_RULES_SQL} AS appName
  FROM (SELECT sides.*, coalesce(t.isInTaxonomy, false) AS known
        FROM sides LEFT JOIN taxonomy t USING (appName) WHERE mac IS NOT NULL) s
  JOIN endpoints e ON s.mac = e.macAddress
  WHERE e.logicalClass IN {ACTIVE_CLASSES}
),
ports AS (
  SELECT ipProto, TRY_CAST(port AS BIGINT) AS serverPort, min(appName) AS portName
  FROM registry WHERE NOT contains(port, '-') GROUP BY ALL
),
resolved AS (
  SELECT * REPLACE (CASE WHEN appName IN ('unknown', 'Unknown') THEN portName ELSE appName END AS appName)
  FROM named LEFT JOIN ports USING (ipProto, serverPort)
  WHERE CASE WHEN appName IN ('unknown', 'Unknown') THEN portName ELSE appName END IS NOT NULL
)"""

BINS_SQL = """
bins AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, "timestamp") AS timeBin, mac, side || '-' || appName AS appName,
    side, uuid, logicalClass AS label,
    CAST(sum(clientBytesSent) AS BIGINT) AS clientBytes, CAST(sum(serverBytesSent) AS BIGINT) AS serverBytes,
    count(*) AS numFlows, max("timestamp") AS lastTimestamp
  FROM resolved GROUP BY ALL
)"""

WINDOW_SQL = """
done AS (
  SELECT * FROM bins
  WHERE timeBin + INTERVAL 15 MINUTE <= (SELECT max(lastTimestamp) FROM bins)
),
bounds AS (
  SELECT greatest(max(timeBin) + INTERVAL 15 MINUTE - INTERVAL 1 DAY, min(timeBin)) AS windowStart,
    max(timeBin) + INTERVAL 15 MINUTE AS windowEnd
  FROM done
),
windowed AS (
  SELECT mac, appName, side, label, uuid, windowStart, windowEnd,
    CAST(sum(clientBytes) AS BIGINT) AS clientBytes, CAST(sum(serverBytes) AS BIGINT) AS serverBytes,
    CAST(sum(numFlows) AS BIGINT) AS numFlows
  FROM done CROSS JOIN bounds WHERE timeBin >= windowStart GROUP BY ALL
)"""
