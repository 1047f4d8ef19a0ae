"""Functions a column map can name."""
