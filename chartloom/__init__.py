"""Chart and event-feed analytics written on PySpark DataFrames."""
