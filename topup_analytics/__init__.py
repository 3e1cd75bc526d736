"""Analytics of mobile top-up order logs on Spark."""
