"""The one large cache of a Python worker.

Workers serve the tasks of several operators in turn. A cache made for one of
them is dropped when another operator's is made, so their sizes do not add up.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable

_HELD: dict[Hashable, object] = {}


def worker_cache(key: Hashable, make: Callable[[], object]):
    """The worker's object for ``key``; making it drops the one before."""
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            gc.collect()  # an encoder and its caches refer to each other
        _HELD[key] = make()
    return _HELD[key]
