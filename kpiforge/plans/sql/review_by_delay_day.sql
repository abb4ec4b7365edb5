-- Reviews by whole days between promise and arrival (rounded half away from zero).
SELECT (EXTRACT(EPOCH FROM (o.order_delivered_customer_date - o.order_estimated_delivery_date)) / 86400)::int AS days_late,
       COUNT(*) AS reviews,
       ROUND(AVG(r.review_score)::numeric, 3) AS mean_score,
       ROUND(COUNT(*) FILTER (WHERE r.review_score >= 4)::numeric / COUNT(*) * 100, 1) AS good_pct
FROM raw.orders o JOIN raw.order_reviews r ON r.order_id = o.order_id
WHERE o.order_status = 'delivered' AND r.review_score IS NOT NULL
GROUP BY 1
ORDER BY reviews DESC, days_late
LIMIT 25;
