"""Tables that a plan reads several times, and their release.

``keep`` persists a table. Results are lazy, so only the caller knows when it is
done with them: what is kept inside ``with releasing():`` is let go at its end.
"""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_kept: ContextVar[list[DataFrame] | None] = ContextVar("kept", default=None)


def keep(df: DataFrame) -> DataFrame:
    """``df``, persisted; blocks lost with an executor are recomputed."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if (kept := _kept.get()) is not None:
        kept.append(df)
    return df


@contextmanager
def releasing():
    """Unpersist, at the end, every table kept inside."""
    kept: list[DataFrame] = []
    token = _kept.set(kept)
    try:
        yield
    finally:
        _kept.reset(token)
        for df in reversed(kept):
            df.unpersist()
