"""Column functions of the gap-filling engine."""
