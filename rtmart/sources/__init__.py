"""Inputs: topics, relational tables, stored facts and the star-schema views."""
