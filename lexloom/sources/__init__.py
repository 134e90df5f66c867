"""Reading, writing and intermediate tables."""
