"""The registered queries of the forecast library."""

from . import axes, checks, convert, manifest, models, normalise, stores
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "axes", "checks", "convert", "manifest", "models", "normalise", "stores"]
