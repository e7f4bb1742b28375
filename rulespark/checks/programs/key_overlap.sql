SELECT 'nation|bal' AS HEADER_DATA, CAST(k AS STRING) AS COL1, '' AS COL2, '' AS COL3
FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT n_nationkey FROM nation
      EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) x
