"""Column expressions: text and vectors. All native, evaluated row by row in the JVM."""
