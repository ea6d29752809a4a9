"""Two-stream tracking on Spark: contracts, dedupe, interval join, cleansed and KPI tables, checks."""
