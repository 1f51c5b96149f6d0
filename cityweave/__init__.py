"""City open-data analytics as plain Spark DataFrame transformations."""
