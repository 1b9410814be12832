"""Composed jobs and the registered query catalog."""
