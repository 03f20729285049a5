"""Column builders (pure ``Column -> Column`` functions)."""
