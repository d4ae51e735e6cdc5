"""Forecast-accuracy auditing on Spark: plain DataFrame functions over long-format tables."""

from veracast.config import Settings
from veracast.context import RunContext

__all__ = ["RunContext", "Settings"]
