"""Daily price-snapshot analytics as DataFrame -> DataFrame functions on Spark."""
