"""What a Python worker keeps from task to task: one model with its memory, by key."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_HELD: dict[str, Any] = {}


def held(key: str, build: Callable[[], Any]) -> Any:
    """What `build` gives, built once in each worker; a new key takes the place of the last."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]
