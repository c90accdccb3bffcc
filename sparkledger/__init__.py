"""An evidence-record engine on Spark DataFrames."""
