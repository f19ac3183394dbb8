"""Readers, writers and the review tables derived from the driver's tables."""
