"""Column expressions. Everything here is a composition of Spark built-ins."""
