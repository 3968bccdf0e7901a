"""Daily feature analytics as Spark DataFrame transformations."""
