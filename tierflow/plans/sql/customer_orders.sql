-- orders of each customer
SELECT o_custkey AS c_custkey, COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(15, 2))) AS DOUBLE) AS order_value,
       MAX(CAST(o_orderdate AS DATE)) AS last_order
FROM silver_orders
GROUP BY o_custkey
