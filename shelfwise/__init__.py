"""Weekly retail price regulation as Spark DataFrame operators."""
