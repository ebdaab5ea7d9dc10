"""Column-level helpers; every one returns a JVM-side expression."""
