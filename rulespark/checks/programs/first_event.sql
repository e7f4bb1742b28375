SELECT 'user|first' AS HEADER_DATA, CAST(user_id AS STRING) AS COL1, event_type AS COL2,
       CAST(event_id AS STRING) AS COL3
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) e WHERE rn = 1
