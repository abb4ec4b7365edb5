-- Orders, revenue and each month's share of all revenue, by month of purchase.
SELECT DATE_TRUNC('month', o.order_purchase_timestamp::timestamp) AS month,
       COUNT(DISTINCT o.order_id) AS orders,
       COALESCE(SUM(i.price), 0)::numeric AS revenue,
       ROUND(SUM(i.price)::numeric / NULLIF(COUNT(DISTINCT o.order_id), 0), 2) AS ticket,
       ROUND(SUM(i.price)::numeric / NULLIF(SUM(SUM(i.price)) OVER (), 0) * 100::numeric, 3) AS share_pct,
       ROUND(SUM(i.freight_value)::numeric * 0.125::numeric, 3) AS freight_eighth
FROM raw.orders o LEFT JOIN raw.order_items i ON i.order_id = o.order_id
WHERE o.order_purchase_timestamp >= timestamp '1997-01-01' AND o.order_purchase_timestamp::timestamp < '1998-09-01'
GROUP BY 1
ORDER BY 1;
