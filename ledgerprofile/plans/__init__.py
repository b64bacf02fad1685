"""Tag jobs and the query catalogue."""
