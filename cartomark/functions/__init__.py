"""Column expressions: text, geometry, grid, projection and nested JSON."""
