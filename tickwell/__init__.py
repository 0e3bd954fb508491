"""tickwell: a Spark-native lake for raw market data payloads."""
