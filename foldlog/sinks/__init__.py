"""Table loads and message output."""
