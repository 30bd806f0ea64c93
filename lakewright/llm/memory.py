"""What Python tasks hold beside the JVM: small batches, training in a process of its own, freed memory given back.

Spark keeps idle workers, and a worker keeps what it has freed; both count for
the executor, whose heap doesn't shrink either.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import pickle
import signal
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows that Spark sends to Python at a time; its default of 10,000 is some 34 MB of documents, in the JVM and, in several forms, in Python.
BATCH_ROWS = 1000
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SIGNAL_AT_PARENTS_END = 1


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends at most BATCH_ROWS rows to Python at a time; a smaller setting stays."""
    if not 0 < int(spark.conf.get(_ROWS_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_ROWS_SETTING, str(BATCH_ROWS))


@lru_cache(maxsize=1)
def _libc() -> ctypes.CDLL:
    return ctypes.CDLL(None)


def give_back() -> None:
    """Freed memory to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        _libc().malloc_trim(0)


def leaves_nothing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the worker gives back what it has freed."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def apart(make: Callable[[], bytes]) -> bytes:
    """What make() returns, made in a fork of this process, whose memory ends with it."""
    out, into = os.pipe()
    parent, child = os.getpid(), os.fork()
    if not child:
        failed = True
        try:
            os.close(out)
            with contextlib.suppress(OSError, AttributeError):  # a killed task takes its fork along
                _libc().prctl(_SIGNAL_AT_PARENTS_END, signal.SIGKILL)
            if os.getppid() != parent:
                os._exit(1)
            try:
                made = (True, make())
            except BaseException as e:
                made = (False, f"{type(e).__name__}: {e}")
            with os.fdopen(into, "wb") as f:
                pickle.dump(made, f)
            failed = False
        finally:
            os._exit(failed)  # without the parent's handlers and buffers
    os.close(into)
    try:
        with os.fdopen(out, "rb") as f:
            said = f.read()
    finally:
        _, status = os.waitpid(child, 0)
    fine, made = pickle.loads(said) if said and not status else (False, f"the process ended with status {os.waitstatus_to_exitcode(status)}")
    if not fine:
        raise RuntimeError(made)
    return made
