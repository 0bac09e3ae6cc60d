"""Analytics on periodic statistical publications, as DataFrame, SQL and Structured Streaming operators."""
