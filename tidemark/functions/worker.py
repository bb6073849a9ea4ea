"""Objects that outlive a task in its Python worker."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import sys
import types
from collections.abc import Callable

import pyarrow as pa
from pyspark import SparkContext, cloudpickle
from pyspark.core.broadcast import Broadcast

_PLACE = "_kept_between_tasks"


def once_per_worker(kind: str, load: Callable[[], object]) -> Callable[[], object]:
    """A function for tasks that calls ``load`` once per Python worker and returns what it made.

    Functions of this package travel by value, so their globals are new in every task; the object is kept in a module
    of the worker's own. It is known by the content of ``load``, and a worker keeps one object of each kind.
    """
    key = hashlib.sha256(cloudpickle.dumps(load)).hexdigest()
    place = _PLACE

    def get():
        kept = vars(sys.modules.setdefault(place, types.ModuleType(place)))
        if kept.get(kind, (None,))[0] != key:
            kept[kind] = (key, load())
        return kept[kind][1]

    return get


def share(sc: SparkContext, value: object) -> Broadcast:
    """A broadcast of an object together with the code of its class; tasks read it by ``shared``."""
    return sc.broadcast(cloudpickle.dumps(value))


def shared(kept: Broadcast):
    """What ``share`` sent, opened once per task."""
    if not hasattr(kept, "_opened"):
        kept._opened = cloudpickle.loads(kept.value)
    return kept._opened


def give_back() -> None:
    """Hands memory that earlier tasks freed in this Python worker back to the system, beside which the JVM may need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass
