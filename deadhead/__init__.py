"""Backhaul tour analytics expressed as Spark DataFrame jobs."""

from deadhead.config import Params

__all__ = ["Params"]
