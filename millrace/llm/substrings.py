"""Substring dedup by level-wise doubling.

A stretch of `length` words that stands in two places can only exist if shorter stretches in it do. The work
goes by levels, each twice as long as the one before (the last is cut to `length`): windows that repeat at one
level alone are extended to the next, until none is left or `length` is reached.

The first level need not look at every place. Of the first-level windows inside a `length`-word window, the one
with the least hash (leftmost of equals) stands for it; equal windows choose equal representatives at equal
distance. Only representatives are counted, about a tenth of all places. From the second level on, every place
whose parts survived is counted.

Equal texts are collapsed first: with two copies, all windows of a text repeat, and one copy stands for all
against the other texts. A hash is counted by partial sums and the places are joined with the repeated hashes,
so a passage that a third of all documents share is a handful of rows in the count and splits freely (adaptive
skew handling) in the join. Documents are shuffled once; the passes over them reuse that shuffle.

Defined results: null is a text without words; a text shorter than `length` keeps all words; repeated rows are
copies. Windows are told apart by 64-bit hashes of 64-bit word hashes. Texts are known by 96 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import words as W
from .common import content_key, prepare

LONGEST_FIRST = 32
KEY = ["key_a", "key_b"]


def levels(length: int) -> list[int]:
    """Window lengths from the first level to `length`, each at most twice the one before."""
    out = [length]
    while len(out) < 2 or out[0] > LONGEST_FIRST:
        if out[0] == 1:
            break
        out.insert(0, (out[0] + 1) // 2)
    return out


def representatives(hashed: np.ndarray, spread: int) -> np.ndarray:
    """For each place, the place of the least hash (leftmost of equals) among the next `spread`."""
    n = len(hashed) - spread + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, size = np.arange(len(hashed)), 1
    while size < spread:
        step = min(size, spread - size)
        left, right = best[:-step], best[step:]
        best = np.where(hashed[right] < hashed[left], right, left)
        size += step
    return best


def _each(texts: pa.Array, *more: pa.Array) -> Iterator[tuple]:
    """Slices of a batch: its words, and the other columns cut alike."""
    for begin, end in W.slices(texts):
        yield W.find(texts.slice(begin, end - begin)), *(x.slice(begin, end - begin) for x in more)


def _rows(hashed: np.ndarray, at: np.ndarray, found: W.Words, key_a: pa.Array, key_b: pa.Array) -> pa.RecordBatch:
    """(hash, key_a, key_b and place in one number) of the windows at the word indexes `at`."""
    text = np.searchsorted(found.first, at, "right") - 1
    place = at - found.first[text]
    low = key_b.to_numpy(zero_copy_only=False).astype(np.int64)[text]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hashed[at].view(np.int64)),
            pa.array(key_a.to_numpy(zero_copy_only=False)[text]),
            pa.array((low << 32) | place),
        ],
        names=["hash", "key_a", "loc"],
    )


def _first_level(length: int, base: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, key_a, key_b in _each(batch.column(0), batch.column(1), batch.column(2)):
                hashed = W.windows(found.hash, base)
                chosen = representatives(hashed, length - base + 1)
                at = np.unique(chosen[found.room()[: len(chosen)] >= length])
                yield _rows(hashed, at, found, key_a, key_b)

    return emit


def _second_level(length: int, base: int, size: int):
    """Every window of `size` inside a `length`-word window whose representative survived."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for found, key_a, key_b, places in _each(columns[0], *columns[1:]):
                alive = np.zeros(len(found.hash) + 1, bool)
                alive[_global(found, places)] = True
                chosen = representatives(W.windows(found.hash, base), length - base + 1)
                whole = np.flatnonzero(alive[chosen] & (found.room()[: len(chosen)] >= length))
                hashed = W.windows(found.hash, size)
                at = np.flatnonzero(W.covered(whole, length - size + 1, len(found.hash)))
                yield _rows(hashed, at, found, key_a, key_b)

    return emit


def _next_level(previous: int, size: int):
    """Every window of `size` whose first and last `previous` words survived."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for found, key_a, key_b, places in _each(columns[0], *columns[1:]):
                alive = np.zeros(len(found.hash) + size + 1, bool)
                alive[_global(found, places)] = True
                fits = found.room() >= size
                n = len(found.hash)
                at = np.flatnonzero(alive[:n] & alive[size - previous : size - previous + n] & fits)
                yield _rows(W.windows(found.hash, size), at, found, key_a, key_b)

    return emit


def _global(found: W.Words, places: pa.Array) -> np.ndarray:
    """Word indexes of per-text lists of places."""
    lists = places.to_pylist()
    sizes = [len(x or ()) for x in lists]
    flat = np.array([y for x in lists for y in x or ()], dtype=np.int64)
    return flat + np.repeat(found.first[:-1], sizes)


def _repeated(rows: DataFrame) -> DataFrame:
    """Per text the places whose window stands in two places at least."""
    # Computed anew so that the join shuffles it by itself: only then may adaptive execution split the other side.
    twice = rows.groupBy("hash").count().where("count > 1").select(F.col("hash").bitwiseXOR(F.lit(0)).alias("hash"))
    kept = rows.join(twice, "hash", "left_semi")
    key_b = F.shiftright("loc", 32).cast("int").alias("key_b")
    place = F.col("loc").bitwiseAND(0xFFFFFFFF).cast("int")
    return kept.groupBy("key_a", key_b).agg(F.collect_list(place).alias("places"))


def _cut(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept, stretches = [], [], [], []
            texts, places, copies = (batch.column(i) for i in (1, 2, 3))
            for text, starts, n in zip(texts, places, copies.to_pylist()):
                found = text.cast(pa.binary()).as_py().split() if text.is_valid else []
                n_words.append(len(found))
                if n is None or len(found) < length:
                    n_removed.append(0)
                    kept.append(b" ".join(found))
                    stretches.append([])
                    continue
                if n > 1:
                    gone = np.ones(len(found), bool)
                else:
                    gone = W.covered(starts.values.to_numpy(), length, len(found))
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                stretches.append([{"begin": b, "end": e} for b, e in edge.reshape(-1, 2).tolist()])
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(compress(found, ~gone)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(stretches, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                ],
                names=["id", "n_words", "n_removed", "kept", "removed"],
            )

    return cut


def remove_repeats(docs: DataFrame, length: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, `n_words`, `n_removed`, `kept` (text), `removed` (ranges of words).

    Removed are the words of every `length`-word window whose words also begin anywhere else, in the same
    text or another. Words are runs of anything but ASCII white space; kept ones are joined by one space.
    """
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(*content_key(text), F.col(id_col).alias("id"), text.alias("text"))
    # One row per distinct text: how many copies, and which id stands for them.
    chosen = rows.groupBy(*KEY).agg(F.min("id").alias("chosen"), F.count(F.lit(1)).alias("copies"))
    # Not written as an equality: that would become a join key, and cost a shuffle of its own.
    stands = (F.col("id") <= F.col("chosen")) & (F.col("id") >= F.col("chosen"))
    once = rows.join(chosen, KEY).where(F.coalesce(stands, F.col("chosen").isNull()))

    steps = levels(length)
    base = steps[0]
    out = "hash bigint, key_a bigint, loc bigint"
    found = once.select("text", *KEY).mapInArrow(_first_level(length, base), out)
    alive = _repeated(found)
    for k, size in enumerate(steps[1:], start=1):
        emit = _second_level(length, base, size) if k == 1 else _next_level(steps[k - 1], size)
        found = once.join(alive, KEY).select("text", *KEY, "places").mapInArrow(emit, out)
        alive = _repeated(found)

    marks = chosen.join(alive, KEY, "left").where("copies > 1 or places is not null")
    joined = rows.join(marks.select(*KEY, "places", "copies"), KEY, "left")
    schema = "n_words bigint, n_removed bigint, kept string, removed array<struct<begin:int,end:int>>"
    id_type = rows.schema["id"].dataType.simpleString()
    done = joined.select("id", "text", "places", "copies").mapInArrow(_cut(length), f"id {id_type}, {schema}")
    return done.withColumnRenamed("id", id_col)
