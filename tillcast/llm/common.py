"""Shared pieces: tables, folds, bounded samples, columns computed in Python, whole groups from sorted rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one call of a text function gets, unless a single text is longer.
CHUNK_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str) -> Column:
    """True for the fifth of the ids that nothing is learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bounded_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` rows, at most twice as many, chosen by a hash of ``key``; all rows if there are no more."""
    total = df.count()
    if total > size:
        df = df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * size / total))
    return df.limit(2 * size)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = sizes.to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Remembered:
    """A mapping of bounded size in two generations: what is asked for again outlives what is not.

    Entries count their bytes, as ``size_of`` estimates them; the older generation goes when the younger is full.
    """

    def __init__(self, most_bytes: int, size_of: Callable[[object, object], int]):
        self.most, self.size_of = most_bytes // 2, size_of
        self.young: dict = {}
        self.old: dict = {}
        self.held = 0

    def bound(self, most_bytes: int) -> None:
        self.most = most_bytes // 2
        if self.held > self.most:
            self.clear()

    def missing(self, keys) -> list:
        """The keys that are not known; those of the older generation move to the younger."""
        young, old, new = self.young, self.old, []
        for k in keys:
            if k not in young:
                v = old.pop(k, None)
                if v is None:
                    new.append(k)
                else:
                    young[k] = v
                    self.held += self.size_of(k, v)
        return new

    def add(self, pairs) -> None:
        for k, v in pairs:
            self.young[k] = v
            self.held += self.size_of(k, v)

    def settle(self) -> None:
        """To be called when the present keys are done with."""
        if self.held > self.most:
            self.old, self.young, self.held = self.young, {}, 0

    def clear(self) -> None:
        self.old, self.young, self.held = {}, {}, 0


#: What this Python worker remembers between tasks, by the operator that filled it.
_MEMORIES: dict[str, list[Remembered]] = {}


def keep_memory(owner: str, memory: Remembered) -> None:
    """The memory outlives its task, until this worker gets a task of another operator."""
    _MEMORIES.setdefault(owner, []).append(memory)


def drop_memories(but: str | None) -> None:
    for owner, memories in _MEMORIES.items():
        if owner != but:
            for m in memories:
                m.clear()


def give_back() -> None:
    """Returns freed memory to the system at a task's end: workers live on, and idle ones would keep it."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def add_columns(
    df: DataFrame, columns: str | list[str], make: Callable[[], Callable[..., Sequence]], fields: list[T.StructField],
) -> DataFrame:
    """``df`` with ``fields`` computed from ``columns``, the first a text; a new column replaces one of the same name.

    ``make`` is called once a task and returns a function from a list of values for each column (None for
    null) to one sequence of values for each field. It is a narrow step: rows stay where they are. What other
    operators remember in this worker is dropped, but for those named by an attribute ``owner`` of ``make``.
    """
    columns = [columns] if isinstance(columns, str) else columns
    new = [f.name for f in fields]
    rest = [f for f in df.schema.fields if f.name not in new]
    names = [*(f.name for f in rest), *new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in fields]
        drop_memories(getattr(make, "owner", None))
        give_back()
        work = make()
        try:
            for batch in batches:
                for part in chunks(batch, columns[0]):
                    at = part.schema.get_field_index
                    values = work(*(part.column(at(c)).to_pylist() for c in columns))
                    made = [pa.array(v, type=kind) for v, kind in zip(values, kinds, strict=True)]
                    del values
                    yield pa.RecordBatch.from_arrays([*(part.column(at(f.name)) for f in rest), *made], names=names)
        finally:
            del work
            give_back()

    return df.mapInArrow(run, T.StructType([*rest, *fields]))


def whole_groups(batches: Iterator, keys: list[str], rows: int = 0) -> Iterator:
    """Frames that hold only whole groups, from frames sorted by ``keys``; at least ``rows`` rows, but for the last."""
    import pandas as pd

    waiting: list = []
    size = 0
    for frame in batches:
        if not len(frame):
            continue
        waiting.append(frame)
        size += len(frame)
        if size < rows:
            continue
        frame = pd.concat(waiting, ignore_index=True)
        change = np.zeros(len(frame), bool)
        for k in keys:
            v = frame[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cut = int(np.flatnonzero(change)[-1]) if change.any() else 0
        if cut:
            yield frame.iloc[:cut].reset_index(drop=True)
        waiting, size = [frame.iloc[cut:]], len(frame) - cut
    if size:
        yield pd.concat(waiting, ignore_index=True)
