"""tidewick: market-candle analytics as Spark DataFrame jobs over all series at once."""
