"""Market-candle analytics as PySpark DataFrame operators."""
