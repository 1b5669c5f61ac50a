"""Analytics operators for catalogue and listening-event data, written as Spark DataFrame code."""
