"""Column builders: calendar, text and numeric expressions (built-ins only)."""
