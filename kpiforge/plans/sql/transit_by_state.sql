-- Time from purchase to arrival and lateness, by the state of the customer.
WITH arrived AS (
    SELECT c.customer_state AS state,
           o.order_purchase_timestamp::timestamp AS bought,
           o.order_delivered_customer_date::timestamp AS came,
           o.order_estimated_delivery_date::timestamp AS promised
    FROM raw.orders o JOIN raw.customers c USING (customer_id)
    WHERE o.order_status = 'delivered' AND o.order_delivered_customer_date IS NOT NULL
)
SELECT state,
       COUNT(*) AS arrivals,
       ROUND(COUNT(*) FILTER (WHERE came > promised)::numeric / NULLIF(COUNT(promised), 0) * 100, 2) AS late_pct,
       ROUND(AVG(EXTRACT(EPOCH FROM (came - bought)) / 3600)::numeric, 2) AS mean_hours,
       ROUND(PERCENTILE_CONT(0.9) WITHIN GROUP (
           ORDER BY EXTRACT(EPOCH FROM (came - bought)) / 86400)::numeric, 2) AS p90_days,
       MAX(DATE_PART('epoch', came - promised))::bigint AS "worst_late_seconds"
FROM arrived
GROUP BY state
ORDER BY late_pct DESC, state;
