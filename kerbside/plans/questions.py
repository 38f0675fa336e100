"""Standing business questions as SQL over the registered views.

Percentages have one decimal, and each result is ordered to the last tie.
"""

from kerbside.functions.measures import exact_mean_sql, exact_sum_sql

QUESTIONS = {
    # Which city had the highest total revenue from completed rides?
    "top_revenue_city": f"""
        SELECT city, {exact_sum_sql('fare_amount')} AS total_revenue
        FROM rides WHERE ride_status = 'completed'
        GROUP BY city ORDER BY total_revenue DESC, city LIMIT 1""",
    # What percentage of rides were cancelled, by city?
    "cancel_pct": """
        SELECT city, round(100.0D * count_if(ride_status = 'cancelled') / count(*), 1) AS cancelled_pct
        FROM rides GROUP BY city ORDER BY cancelled_pct DESC, city LIMIT 20""",
    # Which hour of the day has the highest average surge?
    "peak_hour": f"""
        SELECT trip_hour, {exact_mean_sql('surge_multiplier')} AS avg_surge
        FROM rides GROUP BY trip_hour ORDER BY avg_surge DESC, trip_hour LIMIT 1""",
    # What are the most common cancellation reasons, and who cancels most?
    "cancel_reasons": """
        SELECT reason, cancelled_by, sum(cancellation_count) AS n
        FROM cancellation_analysis GROUP BY GROUPING SETS ((reason), (cancelled_by))
        ORDER BY n DESC, reason, cancelled_by""",
    # Which are the top five payment methods by number of transactions?
    "top_methods": """
        SELECT payment_method, sum(transaction_count) AS transaction_count
        FROM payment_summary GROUP BY payment_method
        ORDER BY transaction_count DESC, payment_method LIMIT 5""",
    # Which city has the most available drivers on an average day?
    "available_city": """
        SELECT city, avg(drivers) AS avg_available FROM (
            SELECT event_date, city, count(DISTINCT driver_id) AS drivers
            FROM driver_locations WHERE availability_status = 'available' GROUP BY event_date, city)
        GROUP BY city ORDER BY avg_available DESC, city LIMIT 1""",
    # How many drivers were ever available, by city?
    "available_distinct": """
        SELECT city, count(DISTINCT driver_id) AS drivers
        FROM driver_locations WHERE availability_status = 'available'
        GROUP BY city ORDER BY drivers DESC, city LIMIT 20""",
    # Which city had the highest revenue over all rides, whatever their status?
    "top_revenue_city_any_status": f"""
        SELECT city, {exact_sum_sql('total_revenue')} AS total_revenue
        FROM daily_ride_metrics GROUP BY city ORDER BY total_revenue DESC NULLS LAST, city LIMIT 1""",
}
