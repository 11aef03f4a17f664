"""Safety-report analytics as Spark jobs: clean, map, aggregate, export, check."""

from faultline.config import Settings

__all__ = ["Settings"]
