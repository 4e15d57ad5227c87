"""gridcat.sources."""
