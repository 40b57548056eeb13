"""Whole jobs and the named query catalogue."""
