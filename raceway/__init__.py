"""Race-data warehouse built from Spark DataFrame operators."""
