"""Hexagon feature tables on Spark: every operator maps DataFrames to DataFrames."""

from hexmosaic.config import Params

__all__ = ["Params"]
