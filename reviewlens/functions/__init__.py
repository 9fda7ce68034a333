"""Column expressions.  Everything here is a built-in Spark expression, so it
stays inside whole-stage code generation; there are no Python UDFs."""
