"""What workers keep between tasks, so that an operator can drop what another one left.

Spark uses a Python worker again for whatever task comes next. A cache that saves much time
within one operator would stay beside all later ones, beyond what the executor counts.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_CLEARS: dict[str, Callable[[], None]] = {}


def hold(owner: str, clear: Callable[[], None]) -> None:
    """Tell how a module's caches are cleared in this process."""
    _CLEARS[owner] = clear


def keep_only(owner: str) -> None:
    """Clear the caches of all other modules; called where a task begins."""
    for name, clear in _CLEARS.items():
        if name != owner:
            clear()
    pa.default_memory_pool().release_unused()
