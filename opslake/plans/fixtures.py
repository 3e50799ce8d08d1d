"""The given tables seen as operations data. Each fixture is one SELECT that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opslake.plans.registry import table

AS_OF = "TIMESTAMP '2001-12-01 00:00:00'"

SQL = {
    "participants": """
        SELECT l_orderkey AS conversation_id, l_linenumber AS participant_id, CASE WHEN l_linenumber % 3 = 0 THEN 'customer' ELSE 'agent' END AS purpose,
               CASE WHEN l_linenumber % 3 <> 0 THEN l_suppkey END AS agent_id, l_returnflag AS division, CONCAT('Vendor', CAST(l_partkey % 7 AS VARCHAR(9))) AS vendor,
               CAST(l_suppkey % 27 AS INTEGER) AS location_key, CASE WHEN l_quantity < 5 THEN NULL ELSE CAST(l_quantity / 10.0 AS DOUBLE) END AS mos,
               CASE WHEN l_discount >= 0.095 THEN 'E1' END AS error_code, l_shipdate AS start_ts, l_shipdate + l_linenumber * INTERVAL '7' MINUTE AS end_ts,
               l_shipdate + CAST(l_partkey % 5 AS INTEGER) * INTERVAL '1' HOUR AS ingestion_ts
        FROM lineitem""",
    "incidents": """
        SELECT o_orderkey AS incident_number, SUBSTRING(o_orderpriority, 1, 1) AS priority_raw, CONCAT('P', SUBSTRING(o_orderpriority, 1, 1)) AS priority,
               CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'New' ELSE 'In Progress' END AS state,
               o_orderdate + CAST(o_orderkey % 1440 AS INTEGER) * INTERVAL '1' MINUTE AS opened_at,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + CAST(o_orderkey % 1440 + o_custkey % 300 AS INTEGER) * INTERVAL '1' MINUTE END AS responded_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + CAST(o_orderkey % 1440 + o_orderkey * 7 % 10000 AS INTEGER) * INTERVAL '1' MINUTE END AS resolved_at,
               CASE WHEN o_custkey % 11 <> 0 THEN CONCAT('VENDOR', CAST(o_custkey % 7 AS VARCHAR(9))) END AS vendor, CONCAT('svc', CAST(o_custkey % 20 AS VARCHAR(9))) AS service,
               o_orderdate + CAST(o_orderkey % 2880 AS INTEGER) * INTERVAL '1' MINUTE AS ingestion_ts
        FROM orders""",
    "targets": """
        SELECT CONCAT('P', CAST(r_regionkey + 1 AS VARCHAR(9))) AS priority, CAST(15 * (r_regionkey + 1) * (r_regionkey + 1) AS DOUBLE) AS response_target,
               CAST(240 * (r_regionkey + 1) * (r_regionkey + 1) AS DOUBLE) AS resolution_target
        FROM region WHERE r_regionkey < 4""",
    "services": """
        SELECT CONCAT('svc', CAST(n_nationkey AS VARCHAR(9))) AS service, CASE n_nationkey % 3 WHEN 0 THEN 'PLATFORM' WHEN 1 THEN 'VENDOR' ELSE 'APPLICATION' END AS service_type,
               n_nationkey % 2 = 0 AS is_agent_facing, CASE n_nationkey % 4 WHEN 0 THEN 'auth' WHEN 1 THEN 'network' WHEN 2 THEN 'storage' END AS platform_component FROM nation WHERE n_nationkey < 18""",
    "locations": """
        SELECT n_nationkey AS location_key, n_name AS country, r_name AS continent FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_events": """
        SELECT event_id, ts, user_id, event_type, value, CONCAT('idx', CAST(event_id % 4 AS VARCHAR(9))) AS idx,
               CONCAT('{"', CASE user_id % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'serviceName' WHEN 2 THEN 'process_name' ELSE 'k' END, '": "Pay', CAST(user_id % 20 AS VARCHAR(9)), CASE WHEN user_id % 2 = 0 THEN 'X-service' ELSE 'Core_v2' END, '"}') AS props,
               CASE user_id % 7 WHEN 0 THEN CONCAT('/var/log/billing', CAST(user_id % 9 AS VARCHAR(9)), 'x/service.log') WHEN 1 THEN CONCAT('/opt/checkout', CAST(user_id % 5 AS VARCHAR(9)), 'y/run') WHEN 2 THEN CONCAT('Program Files/OrderTool', CAST(user_id % 3 AS VARCHAR(9)), 'z/x')
                 WHEN 3 THEN CONCAT('gateway', CAST(user_id % 6 AS VARCHAR(9)), 'q-2.1') WHEN 4 THEN '/srv/mailer-api' WHEN 5 THEN CONCAT('/home/joe/ledger', CAST(user_id % 4 AS VARCHAR(9)), 'w/out') ELSE CONCAT('/data/logs/trace', CAST(user_id % 8 AS VARCHAR(9))) END AS source,
               CASE user_id % 5 WHEN 0 THEN CONCAT('prd-billing', CAST(user_id % 17 AS VARCHAR(9)), '.corp') WHEN 1 THEN CONCAT('web-', CAST(user_id % 17 AS VARCHAR(9)), '.example.com') WHEN 2 THEN CONCAT('pay-server', CAST(user_id % 17 AS VARCHAR(9)), '.internal') WHEN 3 THEN CONCAT('db', CAST(user_id % 17 AS VARCHAR(9)), 'ledgerx') ELSE CONCAT('10-mailer', CAST(user_id % 17 AS VARCHAR(9))) END AS host,
               CONCAT(event_type, CASE WHEN user_id % 3 = 0 THEN '_json' ELSE ':text' END) AS sourcetype,
               CASE user_id % 5 WHEN 0 THEN CONCAT('level=info application=orderDesk', CAST(user_id % 6 AS VARCHAR(9)), 'a ok') WHEN 1 THEN '[RefundService] done' WHEN 2 THEN CONCAT('com.acme.Billing', CASE WHEN user_id % 2 = 0 THEN 'Core' ELSE 'Desk' END, ' failed') WHEN 3 THEN 'service: cart [Basket] logger: mail.PaymentCore sent 12 items' ELSE CONCAT('took ', CAST(event_id % 1000 AS VARCHAR(9)), ' ms') END AS message
        FROM events""",
}
#: Incidents for the correlation: priorities from P0 on, and all but one in fifty end within two weeks.
SQL["outages"] = SQL["incidents"].replace("CONCAT('P', SUBSTRING(o_orderpriority, 1, 1))", "CONCAT('P', CAST(CAST(SUBSTRING(o_orderpriority, 1, 1) AS INTEGER) - 1 AS VARCHAR(9)))").replace(
    "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + CAST(o_orderkey % 1440 + o_orderkey * 7 % 10000 AS INTEGER)", "CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + CAST(o_orderkey % 1440 + o_orderkey * 7 % 20000 AS INTEGER)"
)
BASES = {"participants": ["lineitem"], "incidents": ["orders"], "outages": ["orders"], "targets": ["region"], "services": ["nation"], "locations": ["nation", "region"], "raw_events": ["events"]}


def spark_sql(name: str) -> str:
    """A fixture's SELECT in Spark's words: the type of strings has another name, and nulls are passed over by CONCAT_WS, not by CONCAT."""
    return SQL[name].replace("VARCHAR(9)", "STRING").replace("CONCAT(", "CONCAT_WS('', ")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture over the tables of a folder."""
    sql = spark_sql(name).replace("{", "{{").replace("}", "}}")
    for base in BASES[name]:
        sql = sql.replace(f"FROM {base}", f"FROM {{{base}}}").replace(f"JOIN {base}", f"JOIN {{{base}}}")
    return spark.sql(sql, **{b: table(spark, sf_dir, b) for b in BASES[name]})


def oracle(sql: str, *names: str) -> str:
    """SQL over fixtures, with their definitions in front."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + sql
