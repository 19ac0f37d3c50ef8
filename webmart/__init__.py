"""webmart: a web-analytics mart expressed as Spark DataFrame jobs."""

from webmart.settings import MartSettings

__all__ = ["MartSettings"]
