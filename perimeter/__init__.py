"""Network exposure analytics on Spark DataFrames."""

from perimeter.sources.inventory import Inventory

__all__ = ["Inventory"]
