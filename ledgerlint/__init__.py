"""Cleaning, profiling and monitoring of retail transaction lines on Spark."""

from ledgerlint.config import CleaningConfig

__all__ = ["CleaningConfig"]
