"""Column in, Column out."""
