"""Column -> Column building blocks (all JVM-side built-ins)."""
