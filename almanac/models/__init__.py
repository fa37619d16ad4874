"""Model fitting with Spark ML."""
