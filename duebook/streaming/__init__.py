"""Continuous use of the incremental reload."""
