"""Provider billing risk analytics as composable Spark operators."""
