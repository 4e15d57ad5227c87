"""gridcat.streaming."""
