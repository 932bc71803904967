"""Spot detection and localization in large images, as Spark jobs."""

from punctum.params import SpotParams

__all__ = ["SpotParams"]
