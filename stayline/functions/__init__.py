"""Column functions: strings, scalars, label encoding and vectors. All run inside the JVM."""
