"""Relational operators the stages are built from."""
