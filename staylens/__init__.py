"""Encounter-risk analytics as PySpark DataFrame transforms."""

__version__ = "0.1.0"
