"""tidemark: market and company analytics as composable Spark DataFrame operators."""
