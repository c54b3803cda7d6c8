"""waybill: contract-driven cleaning, spatial matching and trip analytics on Spark DataFrames."""
