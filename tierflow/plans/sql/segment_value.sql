-- what customers of each market segment have ordered; customers without orders count too
WITH valued AS (
  SELECT c.c_mktsegment, c.c_custkey, CAST(COALESCE(o.order_value, 0) AS DECIMAL(15, 2)) AS order_value
  FROM silver_customer c LEFT JOIN gold_customer_orders o ON o.c_custkey = c.c_custkey)
SELECT c_mktsegment, COUNT(*) AS n_customers, CAST(SUM(order_value) AS DOUBLE) AS total_value
FROM valued
GROUP BY c_mktsegment
