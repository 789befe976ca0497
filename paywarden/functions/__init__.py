"""Column expressions; all of them are evaluated inside the JVM."""
