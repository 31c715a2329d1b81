"""CSV chunks for other systems, and publishing of result tables."""
