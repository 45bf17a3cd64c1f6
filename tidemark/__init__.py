"""Time-series feature tables on Spark: raw JSON drops -> clean Parquet -> hourly features -> audit."""
