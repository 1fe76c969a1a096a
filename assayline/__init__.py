"""Daily shop analytics on Spark: raw event records to cleaned tables to KPI tables."""
