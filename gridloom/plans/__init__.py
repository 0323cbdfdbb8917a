"""Composite flows: seat allocation, feature assembly, validation and full runs."""
