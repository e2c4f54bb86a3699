"""Supply-chain demand, inventory and placement analytics on Spark DataFrames."""
