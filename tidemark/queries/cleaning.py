"""Deduplication, flattening, filters and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.names import resolved_app_name
from tidemark.functions.times import to_ms
from tidemark.operators.dedupe import collapse_quasi_duplicates, earliest_per_key, first_per_key
from tidemark.operators.enrich import (
    assign_class,
    attach_endpoints,
    byte_threshold_filter,
    fill_from,
    flatten_records,
    flatten_struct,
    lookup_flag,
    lookup_overwrite,
    port_based_apps,
    single_ports,
    unpivot_sides,
)
from tidemark.queries import inputs
from tidemark.queries.inputs import FLOWS_SQL, NAME_RULES_SQL, table
from tidemark.session import literal_table

_KEY = ["l_orderkey", "l_linenumber"]


def dedupe_exact(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    return first_per_key(items, items.columns, [])


def dedupe_earliest(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", to_ms("l_shipdate"))
    return earliest_per_key(items, _KEY, "l_shipdate", ["l_partkey", "l_suppkey", "l_extendedprice"])


def dedupe_max(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", to_ms("l_shipdate"))
    items = items.withColumn("flag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return collapse_quasi_duplicates(
        items, _KEY,
        max_cols=["l_quantity", "l_extendedprice", "l_shipdate"],
        first_cols=["flag", "l_partkey"], order_by="l_shipdate",
    )


def unpivot(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_returnflag") != "A", F.col("l_suppkey")).alias("supplier"),
        F.col("l_partkey").alias("part"),
    )
    return unpivot_sides(
        items, ["l_orderkey", "l_linenumber", "l_quantity"],
        {"supplier": "supplier", "part": "part"}, target="entity",
    )


def filled_identifiers(spark, sf_dir):
    return fill_from(
        inputs.flows(spark, sf_dir).select(
            F.unix_millis("timestamp").alias("ms"), "clientMac", "serverMac", "clientMacDCS", "serverMacDCS"
        ),
        {"clientMac": "clientMacDCS", "serverMac": "serverMacDCS"},
    )


def lookup_fill(spark, sf_dir):
    """Suppliers with a flag of the nations in the first two regions, false elsewhere."""
    nations = table(spark, sf_dir, "nation").where("n_regionkey < 2").select(
        F.col("n_nationkey").alias("s_nationkey"), F.lit(True).alias("near")
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return lookup_flag(suppliers, nations, "s_nationkey", "near")


def lookup_replace(spark, sf_dir):
    """Brands of PROMO and ECONOMY parts replaced by the least name of their size."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_brand")
    names = table(spark, sf_dir, "part").where("p_size <> 7").select(
        "p_type", "p_size", F.col("p_name").alias("name")
    )
    return lookup_overwrite(
        parts, names, ["p_type", "p_size"], "p_brand", "name", F.col("p_type").isin("PROMO", "ECONOMY")
    )


def endpoint_join(spark, sf_dir):
    """Customers joined to the orders of active segments."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("mac"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("macAddress"), F.col("c_mktsegment").alias("logicalClass"),
        F.col("c_name").alias("uuid"),
    )
    return attach_endpoints(orders, customers, ["BUILDING", "MACHINERY"])


def class_assignment(spark, sf_dir):
    rules = [
        ("rich", F.col("c_acctbal") > 8000),
        ("builder", F.col("c_mktsegment") == "BUILDING"),
        ("poor", F.col("c_acctbal") < 0),
    ]
    return assign_class(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), rules)


def threshold_filter(spark, sf_dir):
    limits = literal_table(
        spark, [("view", 3000, 200), ("unknown", 100, 400)],
        "app string, minFlowClientBytes long, minFlowServerBytes long",
    )
    flows = inputs.flows(spark, sf_dir).select(
        F.unix_millis("timestamp").alias("ms"), "appName", "clientBytesSent", "serverBytesSent"
    )
    flows = flows.withColumn("appName", F.when(F.col("appName") == "cdn.example.com", "view").otherwise(F.col("appName")))
    return byte_threshold_filter(flows, limits, 2500, 500)


def name_rules(spark, sf_dir):
    """Every page as a flow whose app name is a form of its host."""
    host = F.parse_url(F.col("url"), F.lit("HOST"))
    page = F.col("page_id")
    form = page % 7
    name = (
        F.when(form == 0, host)
        .when(form == 1, F.concat(host, F.lit(":8080")))
        .when(form == 2, F.concat(F.lit("http-"), F.substring_index(host, ".", 1), F.lit("-over-http")))
        .when(form == 3, F.concat(F.substring_index(host, ".", 1), F.lit("-over-http-x")))
        .when(form == 4, F.concat(F.lit("ssl-"), host))
        .when(form == 5, F.concat(F.substring_index(host, ".", 1), F.lit(":53_UDP")))
        .otherwise(F.substring_index(host, ".", 1))
    )
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        name.alias("appName"),
        F.when(page % 3 == 0, 17).otherwise(6).alias("ipProto"),
        F.when(page % 4 == 0, 443).when(page % 4 == 1, 80).otherwise(99).alias("serverPort"),
        (page % 5 == 0).alias("known"),
    )
    resolved = resolved_app_name(
        F.col("appName"), F.col("ipProto"), F.col("serverPort"), F.col("known")
    )
    return pages.select("page_id", "appName", resolved.alias("resolved"))


def port_names(spark, sf_dir):
    flows = inputs.flows(spark, sf_dir).select(
        F.unix_millis("timestamp").alias("ms"), "ipProto", "serverPort",
        F.when(F.col("appName").startswith("host:"), "unknown").otherwise(F.col("appName")).alias("appName"),
    )
    return port_based_apps(flows, inputs.registry(spark, sf_dir))


def registered_ports(spark, sf_dir):
    return single_ports(inputs.registry(spark, sf_dir))


def flatten_json(spark, sf_dir):
    """Event properties parsed into a struct and merged into the row."""
    parsed = F.from_json("props", "k int, tags array<string>")
    events = table(spark, sf_dir, "events").select("event_id", parsed.alias("classificationData"))
    return flatten_struct(events).select("event_id", "k", F.size("tags").alias("num_tags"))


def flatten_first_record(spark, sf_dir):
    """Events wrapped in a one-element list of records."""
    flows = inputs.flows(spark, sf_dir)
    inner = [c for c in flows.columns if c != "timestamp"]
    raw = flows.select(F.unix_millis("timestamp").alias("ms"), F.array(F.struct(*inner)).alias("records"))
    return flatten_records(raw).select("ms", "appName", "clientBytesSent", "serverPort", "clientMac")


QUERIES = {
    "dedupe_exact": dedupe_exact,
    "dedupe_earliest": dedupe_earliest,
    "dedupe_max": dedupe_max,
    "unpivot_sides": unpivot,
    "fill_identifiers": filled_identifiers,
    "lookup_fill": lookup_fill,
    "lookup_overwrite": lookup_replace,
    "endpoint_join": endpoint_join,
    "class_assignment": class_assignment,
    "threshold_filter": threshold_filter,
    "name_rules": name_rules,
    "port_names": port_names,
    "single_ports": registered_ports,
    "flatten_nested": flatten_json,
    "flatten_records": flatten_first_record,
}

SQL = {
    "dedupe_exact": "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem",
    "dedupe_earliest": """
SELECT * EXCLUDE (rn) REPLACE ((epoch_us(l_shipdate) // 1000) AS l_shipdate) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
      l_returnflag, l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1""",
    "dedupe_max": """
SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice,
  (epoch_us(max(l_shipdate)) // 1000) AS l_shipdate,
  min({'a': l_shipdate, 'v': l_returnflag}) FILTER (WHERE l_returnflag <> 'N').v AS flag,
  min({'a': l_shipdate, 'v': l_partkey}).v AS l_partkey
FROM lineitem GROUP BY ALL""",
    "unpivot_sides": """
SELECT l_orderkey, l_linenumber, l_quantity, l_suppkey AS entity, 'supplier' AS side FROM lineitem
WHERE l_returnflag <> 'A' AND l_suppkey IS NOT NULL
UNION ALL
SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, 'part' FROM lineitem WHERE l_partkey IS NOT NULL""",
    "fill_identifiers": f"""WITH {FLOWS_SQL}
SELECT (epoch_us("timestamp") // 1000) AS ms, coalesce(clientMac, clientMacDCS) AS clientMac,
  coalesce(serverMac, serverMacDCS) AS serverMac FROM flows""",
    "lookup_fill": """
SELECT s_suppkey, s_nationkey, coalesce(n_regionkey < 2, false) AS near
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "lookup_overwrite": """
WITH names AS (SELECT p_type, p_size, min(p_name) AS name FROM part WHERE p_size <> 7 GROUP BY ALL)
SELECT * FROM (
  SELECT p_partkey, p_type, p_size,
    CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN name ELSE p_brand END AS p_brand
  FROM part LEFT JOIN names USING (p_type, p_size)) WHERE p_brand IS NOT NULL""",
    "endpoint_join": """
SELECT o_custkey AS mac, o_orderkey, c_mktsegment AS logicalClass, c_name AS uuid
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "class_assignment": """
SELECT * FROM (
  SELECT c_custkey, c_mktsegment, c_acctbal, CASE WHEN c_acctbal > 8000 THEN 'rich'
    WHEN c_mktsegment = 'BUILDING' THEN 'builder' WHEN c_acctbal < 0 THEN 'poor' END AS logicalClass
  FROM customer) WHERE logicalClass IS NOT NULL""",
    "threshold_filter": f"""WITH {FLOWS_SQL},
f AS (
  SELECT (epoch_us("timestamp") // 1000) AS ms, CASE WHEN appName = 'cdn.example.com' THEN 'view' ELSE appName END AS appName,
    clientBytesSent, serverBytesSent FROM flows
)
SELECT * FROM f WHERE CASE appName
  WHEN 'view' THEN clientBytesSent >= 3000 AND serverBytesSent >= 200
  WHEN 'Unknown' THEN clientBytesSent >= 100 AND serverBytesSent >= 400
  ELSE (clientBytesSent >= 2500 AND serverBytesSent >= 500)
    OR (clientBytesSent >= 500 AND serverBytesSent >= 2500) END""",
    "name_rules": f"""
WITH hosts AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages),
named AS (
  SELECT page_id, CASE page_id % 7
      WHEN 0 THEN host WHEN 1 THEN host || ':8080'
      WHEN 2 THEN 'http-' || split_part(host, '.', 1) || '-over-http'
      WHEN 3 THEN split_part(host, '.', 1) || '-over-http-x'
      WHEN 4 THEN 'ssl-' || host WHEN 5 THEN split_part(host, '.', 1) || ':53_UDP'
      ELSE split_part(host, '.', 1) END AS appName,
    CASE WHEN page_id % 3 = 0 THEN 17 ELSE 6 END AS ipProto,
    CASE page_id % 4 WHEN 0 THEN 443 WHEN 1 THEN 80 ELSE 99 END AS serverPort,
    page_id % 5 = 0 AS known
  FROM hosts
)
SELECT page_id, appName, {NAME_RULES_SQL} AS resolved FROM named""",
    "port_names": f"""WITH {FLOWS_SQL},
f AS (
  SELECT (epoch_us("timestamp") // 1000) AS ms, ipProto, serverPort,
    CASE WHEN starts_with(appName, 'host:') THEN 'unknown' ELSE appName END AS appName FROM flows
),
ports AS (
  SELECT ipProto, TRY_CAST(port AS BIGINT) AS serverPort, min(appName) AS portName
  FROM registry WHERE NOT contains(port, '-') GROUP BY ALL
),
named AS (
  SELECT ms, ipProto, serverPort,
    CASE WHEN appName IN ('unknown', 'Unknown') THEN portName ELSE appName END AS appName
  FROM f LEFT JOIN ports USING (ipProto, serverPort)
)
SELECT * FROM named WHERE appName IS NOT NULL""",
    "single_ports": f"""WITH {FLOWS_SQL}
SELECT ipProto, TRY_CAST(port AS BIGINT) AS port, appName FROM registry WHERE NOT contains(port, '-')""",
    "flatten_nested": """
SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, 0 AS num_tags FROM events""",
    "flatten_records": f"""WITH {FLOWS_SQL}
SELECT (epoch_us("timestamp") // 1000) AS ms, appName, clientBytesSent, serverPort, clientMac FROM flows""",
}
