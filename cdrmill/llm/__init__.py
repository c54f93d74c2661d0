"""Operators for preparing a large training corpus (see README)."""
