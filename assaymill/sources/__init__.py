"""Reading, loading and writing tables."""
