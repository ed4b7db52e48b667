"""Trip reports as SQL over a trips table ``{trips}``; money columns are decimals, so sums are exact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TAXI_REPORTS = {
    "taxi_daily_revenue": """
        SELECT to_date(tpep_pickup_datetime) AS trip_date, round(sum(total_amount), 2) AS total_revenue, count(*) AS total_trips
        FROM {trips} GROUP BY ALL""",
    "taxi_payment_mix": "SELECT payment_type, count(*) AS trips, round(sum(total_amount), 2) AS revenue FROM {trips} GROUP BY payment_type",
    "taxi_top_pickups": """
        SELECT PULocationID, count(*) AS trips, round(sum(total_amount), 2) AS revenue
        FROM {trips} GROUP BY PULocationID ORDER BY revenue DESC, PULocationID LIMIT 20""",
    "taxi_hourly_volume": "SELECT hour(tpep_pickup_datetime) AS pickup_hour, count(*) AS total_trips FROM {trips} GROUP BY ALL",
    "taxi_distance_by_passengers": """
        SELECT passenger_count, round(avg(trip_distance), 2) AS avg_distance, count(*) AS trips FROM {trips} GROUP BY passenger_count""",
    "taxi_top_tips": """
        SELECT VendorID, trip_distance, fare_amount, tip_amount, total_amount
        FROM {trips} ORDER BY tip_amount DESC, total_amount DESC, fare_amount DESC, trip_distance DESC, VendorID LIMIT 20""",
    "taxi_hourly_fare": "SELECT hour(tpep_pickup_datetime) AS hour_of_day, round(avg(fare_amount), 2) AS avg_fare FROM {trips} GROUP BY ALL",
    "taxi_long_trips": """
        SELECT VendorID, trip_distance, fare_amount, total_amount FROM {trips} WHERE trip_distance > 20 ORDER BY trip_distance DESC""",
}


def taxi_report(spark: SparkSession, name: str, trips: DataFrame) -> DataFrame:
    return spark.sql(TAXI_REPORTS[name], trips=trips)
