"""Registered queries: every operator run over the given tables, each with its SQL oracle."""

from . import catalogue

__all__ = ["catalogue"]
