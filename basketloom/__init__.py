"""Product-bundle recommendations from order history, as Spark DataFrame operators."""
