"""gridcat.functions."""
