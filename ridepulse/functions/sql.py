"""The scalar functions SQL users call by name, as temporary SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFINITIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION fn_rental_duration(last_gps TIMESTAMP_NTZ, rental_start TIMESTAMP_NTZ)
       RETURNS INT RETURN greatest(CAST(timestampdiff(MINUTE, rental_start, last_gps) AS INT), 0)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION fn_timesofday(rental_date TIMESTAMP_NTZ)
       RETURNS STRING RETURN CASE
         WHEN hour(rental_date) BETWEEN 7 AND 11 THEN 'Morning'
         WHEN hour(rental_date) BETWEEN 12 AND 17 THEN 'Afternoon'
         WHEN hour(rental_date) BETWEEN 18 AND 22 THEN 'Evening'
         WHEN rental_date IS NOT NULL THEN 'Night' END""",
]


def register_sql_functions(spark: SparkSession) -> None:
    for statement in DEFINITIONS:
        spark.sql(statement)
