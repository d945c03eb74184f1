"""Arrow batches of whole texts, for the operators whose per-document work is Python."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: [\x20\x09-\x0D], which bytes.split() and bytes.strip() use.
ASCII_SPACE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
#: Rows whose texts a task turns into Python bytes at a time.
SLICE_ROWS = 1000

_kept: dict[str, Callable[[], None]] = {}


def keeps(owner: str, forget: Callable[[], None]) -> None:
    """Say that this Python worker remembers something for ``owner`` from task to task, until ``forget()``.

    Workers serve one operator after the other, so what other owners have kept is forgotten now.
    """
    for other in [o for o in _kept if o != owner]:
        _kept.pop(other)()
    _kept[owner] = forget


def give_back() -> None:
    """Return the memory that this worker has freed to the system: workers wait for their next task with what they hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, at most SLICE_ROWS at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def map_texts(docs: DataFrame, cols: dict[str, str], text_col: str, start: Callable[[], Callable], schema: str, then: Callable[[], None] | None = None) -> DataFrame:
    """Run ``start()(ids, texts)`` on slices of the Arrow batches of ``docs``, with texts as UTF-8 bytes.

    cols: new name to old name of the columns to pass. ``start`` is called once in each task and
    gives a function that takes the slice's passed columns (a dict of Arrow arrays) and a list of
    bytes, and returns a dict of columns for ``schema``; ``then`` is called at the end of each task. Null texts are empty.
    """
    picked = docs.select(*[F.col(old).alias(new) for new, old in cols.items()], F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in slices(batches):
            work = work or start()
            got = work({c: batch.column(c) for c in cols}, batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_pydict(got)
        if then is not None:
            then()

    return picked.mapInArrow(run, schema)


def code_points(text: bytes) -> int:
    return len(text.translate(None, CONTINUATION))


def text_hash_of(text: Column) -> Column:
    """64 bits of a text, to tell rows of one id apart; null is empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def text_hash(text_col: str) -> Column:
    return text_hash_of(F.col(text_col))


def without_rows(docs: DataFrame, id_col: str, text_col: str, gone: DataFrame, twice: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text ``gone`` (gone_id, gone_hash) has, and with one row of those that ``twice`` has.

    Both are written tables of distinct rows; names in ``docs`` do not matter. Rows that repeat an id and its text
    are few or many: only these are grouped, and their task's first is taken before they are shuffled.
    """

    def same(other: DataFrame, key: str) -> Column:
        other_id, other_hash = f"__{key}_id", f"__{key}_hash"
        return docs[id_col].eqNullSafe(other[other_id]) & (text_hash_of(docs[text_col]) == other[other_hash])

    named = {key: df.toDF(f"__{key}_id", f"__{key}_hash") for key, df in (("gone", gone), ("twice", twice))}
    if twice.limit(1).count() == 0:
        return docs.join(named["gone"], same(named["gone"], "gone"), "left_anti")
    once = docs.join(named["twice"], same(named["twice"], "twice"), "left_anti")
    once = once.join(named["gone"], same(named["gone"], "gone"), "left_anti")
    again = docs.join(named["twice"], same(named["twice"], "twice"), "left_semi")
    rows = again.select(F.struct(*[again[c] for c in docs.columns]).alias("row"), again[id_col].alias("id"), text_hash_of(again[text_col]).alias("hash"))
    return once.unionByName(rows.groupBy("id", "hash").agg(F.first("row").alias("row")).select("row.*"))
