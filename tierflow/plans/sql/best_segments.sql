-- market segments with an above-average value per customer
SELECT c_mktsegment, n_customers, total_value,
       CAST(CAST(CAST(total_value AS DECIMAL(18, 2)) / n_customers AS DECIMAL(18, 2)) AS DOUBLE) AS value_per_customer
FROM gold_segment_value
WHERE CAST(total_value AS DECIMAL(18, 2)) * (SELECT SUM(n_customers) FROM gold_segment_value)
      > n_customers * (SELECT SUM(CAST(total_value AS DECIMAL(18, 2))) FROM gold_segment_value);
