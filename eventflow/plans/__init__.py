"""Whole jobs (JOB-*) and the query catalogue."""
