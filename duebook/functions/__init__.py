"""Column functions: dates, amounts, text and fingerprints."""
