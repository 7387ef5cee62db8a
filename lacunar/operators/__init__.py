"""Operators of the gap-filling engine. Tables are long: one row a cell, NULL for no data."""
