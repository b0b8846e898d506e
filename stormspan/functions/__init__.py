"""Column functions: calendar arithmetic, cleaning, thresholds, radar formulas."""
