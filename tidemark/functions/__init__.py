"""Column functions with the exact rounding and NULL rules the features need."""
