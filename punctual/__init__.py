"""Public-transport punctuality analytics expressed as Spark DataFrame operators."""
