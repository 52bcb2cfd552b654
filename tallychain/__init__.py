"""Payment-chain reconciliation on Spark DataFrames."""
