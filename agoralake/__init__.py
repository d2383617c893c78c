"""Forum-post analytics on Spark: bronze, silver and gold layers, tables and reports."""

from agoralake.config import Lake

__all__ = ["Lake"]
