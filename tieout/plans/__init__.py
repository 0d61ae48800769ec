"""End-to-end jobs, the query registry and its oracle SQL."""
