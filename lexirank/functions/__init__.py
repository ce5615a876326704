"""Column functions, JSON repair and response parsing."""
