"""What a worker process keeps from task to task.

Spark hands a worker process to one operator after another. A process keeps the
models (indexes, automata, tables of units) of one owner only, the last that asked,
so that an executor's memory is bounded by the largest of them, not by the sum of
all operators that ran on it. Tasks of one stage share an owner; a stage that runs two operators
on the same rows may make a model more than once. A large model that is quick to make
goes at the end of its task (:func:`let_go`): an idle process would hold it while stages without Python run.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa

_KEPT: dict[str, dict[str, Any]] = {}


def give_back(collect: bool = True) -> None:
    """Memory that is free, but still held by Arrow's pool or the C library, goes back to the system."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def let_go() -> None:
    """All models of this process go."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def kept(owner: str, part: str, make: Callable[[], Any]) -> Any:
    """The ``part`` of ``owner``'s models in this process, made once; those of other owners go first."""
    if owner not in _KEPT:
        let_go()
        _KEPT[owner] = {}
    mine = _KEPT[owner]
    if part not in mine:
        mine[part] = make()
        give_back()  # what making it took
    return mine[part]
