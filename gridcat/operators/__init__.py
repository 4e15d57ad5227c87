"""gridcat.operators."""
