"""Column expressions: every function takes and returns Columns and stays in the JVM."""
