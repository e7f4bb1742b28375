SELECT 'order|date' AS HEADER_DATA, CAST(o_orderkey AS STRING) AS COL1, o_orderstatus AS COL2,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS COL3
FROM orders
WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) < date_sub(to_date('${as_of_date}', 'yyyyMMdd'), 90)
