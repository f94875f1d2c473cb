"""The reports a user runs."""
