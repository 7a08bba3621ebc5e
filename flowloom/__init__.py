"""IP-flow security analytics as composable Spark DataFrame operators."""
