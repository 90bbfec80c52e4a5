"""Table layouts, and reading and writing of tables."""
