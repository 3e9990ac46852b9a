"""Load-disaggregation analytics on Spark: DataFrame operators keyed by customer."""
