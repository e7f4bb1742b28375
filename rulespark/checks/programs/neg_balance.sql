SELECT 'customer|balance' AS HEADER_DATA, CAST(c_custkey AS STRING) AS COL1, c_name AS COL2,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) AS COL3
FROM customer WHERE c_acctbal < 0
