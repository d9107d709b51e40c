"""Loads every family of queries."""

from __future__ import annotations

from . import checks, dated, declared, loading, modelled, shop, sketched, web  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
