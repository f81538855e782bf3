"""Registered queries, their oracle SQL and the frames both are derived from."""
