"""Price monitoring on Spark: composable DataFrame operators for untrusted, repeatedly delivered crawl files."""
