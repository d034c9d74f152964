"""Operators: each takes frames and returns a frame, on batch tables and, where stateless, on streams too."""
