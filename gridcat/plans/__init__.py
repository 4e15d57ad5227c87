"""gridcat.plans."""
