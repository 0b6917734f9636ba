"""Star builders, reports, marts, audits, forecast and the daily job."""
