"""End-to-end jobs and the registered query catalogue."""
