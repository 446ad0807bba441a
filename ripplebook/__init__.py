"""Market-data analytics on Spark: facts, depth features, event index, recorder and guards."""
