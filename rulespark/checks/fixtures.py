"""Views with the shape of the rule tables, over whole driver tables.

The text is the same for Spark and DuckDB. Every row of a table is in its view; one
that shall not meet a rule of the catalog (so that there are rules without a mapping,
an approval or a ledger row) has the id of a rule outside it, with an ``x``.
"""

VIEWS = {
    "fx_rules": """
WITH base AS (
  SELECT p_partkey, CAST(p_partkey AS STRING) AS rule_id, p_name AS rule_name, p_type AS rule_type,
         CASE WHEN p_size % 5 = 0 THEN 'Inactive' WHEN p_size % 5 <= 2 THEN 'Passive' ELSE 'Active' END AS rule_status,
         CASE WHEN p_partkey % 2 = 0 THEN 'M1' ELSE 'M2' END AS module,
         CASE WHEN p_partkey % 3 = 0 THEN 'S1' ELSE 'S2' END AS stage,
         p_brand AS package,
         CONCAT('SLG', CAST(p_size AS STRING)) AS slg,
         CASE WHEN p_partkey % 11 = 0 THEN 'JAVA' WHEN p_partkey % 7 = 0 THEN 'Python' ELSE 'sql' END AS program_type,
         CONCAT('rules/', CAST(p_partkey AS STRING)) AS program_code,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE DATE '2024-01-31' END AS created_dt,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'loader' END AS created_by,
         CASE WHEN p_partkey % 4 = 0 THEN DATE '2024-02-29' ELSE NULL END AS modified_dt,
         CASE WHEN p_partkey % 4 = 0 THEN 'editor' ELSE NULL END AS modified_by
  FROM {part})
SELECT rule_id, rule_name, rule_type, rule_status, module, stage, package, slg, program_type, program_code,
       created_dt, created_by, modified_dt, modified_by FROM base
UNION ALL
SELECT rule_id, rule_name, rule_type, rule_status, module, stage, package, slg, program_type, program_code,
       created_dt, created_by, modified_dt, modified_by FROM base WHERE p_partkey % 10 = 0""",
    "fx_feed_map": """
SELECT CONCAT(CASE WHEN l_quantity >= 48 AND l_partkey % 4 <> 0 THEN '' ELSE 'x' END, CAST(l_partkey AS STRING)) AS rule_id,
       CONCAT('F', CAST(l_suppkey % 5 AS STRING)) AS feed_id,
       CASE l_returnflag WHEN 'N' THEN 'No' ELSE 'Yes' END AS rule_applicable_status
FROM {lineitem}""",
    "fx_approvals": """
SELECT CONCAT(CASE WHEN o_totalprice > 400000 THEN '' ELSE 'x' END, CAST(o_custkey AS STRING)) AS rule_id,
       CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Pending' ELSE 'Rejected' END AS approval_status
FROM {orders}""",
    "fx_status": """
SELECT CONCAT(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS rule_run_id,
       CONCAT(CASE WHEN l_partkey % 6 <> 5 THEN '' ELSE 'x' END, CAST(l_partkey AS STRING)) AS rule_id,
       CASE WHEN l_partkey % 97 = 0 THEN 'Retired' WHEN l_suppkey % 3 = 0 THEN 'Passive' ELSE 'Active' END AS rule_status,
       CASE l_returnflag WHEN 'A' THEN 'Success' WHEN 'R' THEN 'Failure' ELSE 'Started' END AS rule_execution_status,
       CASE WHEN l_tax < 0.005 THEN NULL WHEN l_linestatus = 'F' THEN 'Yes' ELSE 'No' END AS exception_applied,
       CASE WHEN l_quantity > 49.5 AND l_linenumber = 1 THEN NULL ELSE l_shipdate END AS created_dt
FROM {lineitem}""",
    "fx_raw_csv": """
SELECT CAST(c_custkey AS STRING) AS custkey,
       CASE WHEN c_custkey % 50 = 0 THEN 'n/a' ELSE CAST(c_nationkey AS STRING) END AS nationkey,
       CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END AS acctbal,
       '2024-01-31' AS asof, c_mktsegment AS segment
FROM {customer}""",
}

BASE_TABLE = {
    "fx_rules": "part", "fx_feed_map": "lineitem", "fx_approvals": "orders", "fx_status": "lineitem",
    "fx_raw_csv": "customer",
}


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark, sf_dir, name):
    base = BASE_TABLE[name]
    return spark.sql(VIEWS[name], **{base: table(spark, sf_dir, base)})

