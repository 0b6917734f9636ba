"""Order analytics on Spark: cleaning, star schema, reports, marts, audits, forecast."""
