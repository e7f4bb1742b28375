SELECT 'line|part' AS HEADER_DATA, CAST(l_orderkey AS STRING) AS COL1,
       CAST(l_linenumber AS STRING) AS COL2, CAST(l_partkey AS STRING) AS COL3
FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')
