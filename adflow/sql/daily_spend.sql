SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users
FROM events_view
WHERE ts >= CAST(:start AS timestamp_ntz) AND ts < CAST(:end AS timestamp_ntz)
GROUP BY event_type
