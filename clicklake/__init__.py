"""Click-event lake: raw, refined and aggregated layers as Spark DataFrames."""
