"""martflow: build, load and check a retail star schema with Spark DataFrames."""
