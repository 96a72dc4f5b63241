"""lakeops: Spark operators for cleaning, checking, loading and reporting on operational exports."""
