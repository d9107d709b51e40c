"""What a Python worker remembers between tasks.

Workers live on after a query.  Each keeps one memo at a time: asking for another drops the last, so
the memory of one operator is not held while the next one runs.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

_kept: dict[Hashable, Any] = {}


def keep(name: Hashable, make: Callable[[], Any]) -> Any:
    """The worker's memo of that name, made when first asked for."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def drop() -> None:
    """Forget everything: for functions that need no memo."""
    _kept.clear()
