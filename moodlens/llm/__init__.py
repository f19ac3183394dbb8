"""Operators of a training-data pipeline, each as one module, and their query catalogue."""
