"""Column expressions and naming rules; nothing here runs a Spark job."""
