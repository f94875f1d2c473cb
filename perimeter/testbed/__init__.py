"""Nine collections derived from the benchmark tables, and their expected results."""
