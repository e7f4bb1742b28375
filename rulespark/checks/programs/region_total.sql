SELECT 'nation|orders' AS HEADER_DATA, n_name AS COL1, CAST(COUNT(*) AS STRING) AS COL2,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS STRING) AS COL3
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name HAVING COUNT(*) > 50
