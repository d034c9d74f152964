"""Continuous jobs and the tables they keep."""
