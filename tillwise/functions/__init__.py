from . import calendar, exact, rules

__all__ = ["calendar", "exact", "rules"]
