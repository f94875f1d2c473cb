"""Reading, typing, consolidating and auditing the nine collections."""
