"""Column expressions (pure ``Column -> Column``), all JVM-side except SHAKE-256."""
