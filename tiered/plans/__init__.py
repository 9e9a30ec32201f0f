"""User-level jobs that string operators and tables together."""
