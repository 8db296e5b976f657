"""Transaction analytics on Spark: composable DataFrame operators over one transaction fact."""
