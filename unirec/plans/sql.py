"""Plain SQL of the derived source tables, shared by the check queries."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"


def customer_time(number: int) -> str:
    return (
        "TIMESTAMP '2024-01-01' + to_seconds(CAST((c_custkey * 7919 % 864000) * 3 "
        f"+ (c_custkey + {number}) % 3 AS BIGINT))"
    )


# Canonical rows of each customer source, typed; the JSON between them and Spark's rows is not repeated here.
CUSTOMER_ROWS = f"""
customer_rows AS (
  SELECT c_custkey AS customer_id, upper(c_name) AS name, CAST(c_nationkey AS BIGINT) AS nation_id,
         c_acctbal AS balance, upper(c_mktsegment) AS segment, {customer_time(0)} AS updated_at, 'postgres' AS _source
  FROM customer
  UNION ALL
  SELECT c_custkey, upper(c_name), c_nationkey, c_acctbal, upper(c_mktsegment), {customer_time(1)}, 'sqlserver'
  FROM customer
  UNION ALL
  SELECT c_custkey, upper(c_name), c_nationkey, CAST(NULL AS DOUBLE), upper(c_mktsegment), {customer_time(2)}, 'teradata'
  FROM customer
)"""

ORDER_ROWS = """
order_rows AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS total,
         lower(o_orderpriority) AS priority, CAST(o_orderdate AS TIMESTAMP) AS updated_at, 'postgres' AS _source
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, lower(o_orderpriority),
         CAST(o_orderdate AS TIMESTAMP)
           + to_hours(CASE WHEN o_orderstatus = 'F' THEN 12 ELSE -12 END), 'sqlserver'
  FROM orders
)"""


def canonical(rows: str, event_type: str = "'SNAPSHOT'") -> str:
    """Metadata columns around a set of canonical rows."""
    return f"""SELECT *, {event_type} AS _event_type, strftime(updated_at, {ISO}) AS _event_timestamp,
       DATE '2024-02-01' AS _ingest_date, TRUE AS _is_golden FROM {rows}"""


def latest(rows: str, keys: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {rows}) WHERE rn = 1"""
