"""Click-event ETL, star-schema reporting and purchase prediction on Spark."""
