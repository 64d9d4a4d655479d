-- Orders above a price, per priority; the table comes as a DataFrame.
SELECT o_orderpriority, COUNT(*) AS cnt, MAX(o_totalprice) AS best
FROM {orders}
WHERE o_totalprice >= :min_price AND o_orderstatus <> :status
GROUP BY o_orderpriority
