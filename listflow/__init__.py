"""listflow: clean, classify, gate, reconcile and audit listings with Spark DataFrames."""
