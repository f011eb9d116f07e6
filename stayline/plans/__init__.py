"""Named queries with their SQL oracles, and the end-to-end jobs."""
