"""Incremental arrival: new files are landed and merged as they come."""
