"""The package for the Python workers, as the rest of the library ships it."""

from __future__ import annotations

from seismark.shipping import ship_package

__all__ = ["ship_package"]
