"""Entity reconciliation and graph analytics on Spark."""
