"""Benchmark decontamination with a distributed positional inverted index.

Training documents are cut into segments of about a megabyte of whole texts. Each segment is one row of a
stored index: its distinct terms (as sorted 64-bit hashes) and, for every term, the ascending list of the
positions where it stands. Positions run on over the texts of a segment with a gap between texts, so that no
phrase reaches from one text into the next. The index is built without a shuffle and can serve any number of
benchmarks.

Test items are cut into blocks with a bounded number of words, and only a block is ever sent to the executors.
A test phrase that lacks one of its terms in a segment is dropped there; for the others the list of the rarest
term gives the possible beginnings, and the offset-adjusted lists of the other terms, from rare to common, are
intersected with it.

Defined results: a null text has no words, and neither hits nor is hit. Repeated rows stay repeated rows. Items
with a null id mark words but are not listed. Only the id and text columns are read, so other columns may have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import words as W
from .common import forget, stored

BLOCK_WORDS = 200_000


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: str = "alnum", lower: bool = True
) -> DataFrame:
    """The stored index: one row per segment with `doc_ids`, `bounds`, `terms`, `offsets`, `postings`."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for begin, end in W.slices(texts):
                found = W.find(texts.slice(begin, end - begin), words, lower)
                place = np.arange(len(found.hash)) + found.text_of()
                order = np.argsort(found.hash, kind="stable")
                ranked = found.hash[order]
                fresh = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]) != 0)
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.array([ids.slice(begin, end - begin).to_pylist()], pa.list_(ids.type)),
                        *(
                            pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
                            for x in (
                                found.first.astype("<u4"),
                                ranked[fresh].astype("<u8"),
                                np.append(fresh, len(ranked)).astype("<u4"),
                                place[order].astype("<u4"),
                            )
                        ),
                    ],
                    names=["segment", "doc_ids", "bounds", "terms", "offsets", "postings"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    schema = T.StructType(
        [T.StructField("segment", T.LongType()), T.StructField("doc_ids", T.ArrayType(id_type))]
        + [T.StructField(c, T.BinaryType()) for c in ("bounds", "terms", "offsets", "postings")]
    )
    return stored(rows.mapInArrow(build, schema), "positional-index")


class Segment:
    """One row of the index, opened."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.first = np.frombuffer(row["bounds"], "<u4").astype(np.int64)
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.offsets = np.frombuffer(row["offsets"], "<u4").astype(np.int64)
        self.postings = np.frombuffer(row["postings"], "<u4").astype(np.int64)
        self.begin = self.first[:-1] + np.arange(len(self.first) - 1)  # position of each text's first word
        self.n_words = np.diff(self.first)
        self.span = int(self.first[-1]) + len(self.doc_ids) + 1

    def look_up(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each term here, and its number of postings (0: not here)."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        if not len(self.terms):
            return at, np.zeros(len(terms), np.int64)
        counts = self.offsets[at + 1] - self.offsets[at]
        return at, np.where(self.terms[at] == terms, counts, 0)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, positions, "right") - 1

    def phrases(self, matrix: np.ndarray, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (phrase, first position). matrix: the terms of each phrase, as indexes into `at`."""
        size = counts[matrix]
        alive = np.flatnonzero((size > 0).all(axis=1))
        if not len(alive):
            return alive, alive
        rarity = np.argsort(size[alive], axis=1, kind="stable")
        offset = rarity[:, 0]
        term = at[matrix[alive, offset]]
        n = self.offsets[term + 1] - self.offsets[term]
        owner = np.repeat(np.arange(len(alive)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = self.postings[self.offsets[term][owner] + inside] - offset[owner]
        # The lists of all terms the phrases need, as one ascending list of (term, position).
        needed = np.unique(at[matrix[alive]])
        lists = [self.postings[self.offsets[t] : self.offsets[t + 1]] + t * self.span for t in needed]
        keys = np.concatenate(lists)
        keep = start >= 0
        owner, start = owner[keep], start[keep]
        for k in range(1, matrix.shape[1]):
            if not len(start):
                break
            offset = rarity[owner, k]
            wanted = at[matrix[alive[owner], offset]] * self.span + start + offset
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            keep = (keys[place] == wanted) & (start + offset < self.span)
            owner, start = owner[keep], start[keep]
        return alive[owner], start

    def near(self, terms: np.ndarray, at: np.ndarray, counts: np.ndarray, span: int) -> list[tuple[int, int, int]]:
        """(text, begin, end) of the shortest stretches of at most `span` words that hold all terms."""
        if not len(terms) or (counts[terms] == 0).any():
            return []
        terms = terms[np.argsort(counts[terms], kind="stable")]
        lists = [self.postings[self.offsets[t] : self.offsets[t + 1]] for t in at[terms]]
        ends = np.unique(np.concatenate(lists))
        after = np.searchsorted(lists[0], ends, "right") - 1
        ends = ends[(after >= 0) & (ends - lists[0][np.maximum(after, 0)] < span)]
        begin = ends.copy()
        for places in lists:
            after = np.searchsorted(places, ends, "right") - 1
            begin = np.minimum(begin, np.where(after >= 0, places[np.maximum(after, 0)], -span))
        text = self.text_of(ends)
        keep = (ends - begin < span) & (begin >= self.begin[text])
        # Of stretches with one begin only the first to end is shortest.
        keep[1:] &= ~(keep[:-1] & (begin[1:] == begin[:-1]))
        return [(t, int(b - self.begin[t]), int(e + 1 - self.begin[t])) for t, b, e in zip(text[keep], begin[keep], ends[keep])]


class Block:
    """Test items: the distinct phrases they are cut into, and which items each phrase is from."""

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        self.ids = [i for i, _ in items]
        texts = [np.frombuffer(h, "<u8") for _, h in items]
        self.vocabulary, flat = np.unique(np.concatenate([*texts, np.zeros(0, np.uint64)]), return_inverse=True)
        bounds = np.cumsum([0, *map(len, texts)])
        self.items = [flat[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        by_length: dict[int, dict[tuple, set[int]]] = {}
        for i, terms in enumerate(self.items):
            length = min(window, len(terms))
            for k in range(len(terms) - length + 1 if length else 0):
                by_length.setdefault(length, {}).setdefault(tuple(terms[k : k + length]), set()).add(i)
        self.groups = [(np.array([*found]), [sorted(x) for x in found.values()]) for found in by_length.values()]


def _items(benchmark: DataFrame, id_col: str, text_col: str, words: str, lower: bool) -> DataFrame:
    """Items as word hashes, numbered into blocks of at most BLOCK_WORDS words (or one longer item)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            found = W.find(batch.column(1), words, lower)
            rows = [found.hash[a:b].astype("<u8").tobytes() for a, b in zip(found.first[:-1], found.first[1:])]
            numbers = []
            for row in rows:
                if size and size + len(row) // 8 > BLOCK_WORDS:
                    block, size = block + 1, 0
                size += len(row) // 8
                numbers.append(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), batch.column(0), pa.array(rows, pa.binary())],
                names=["block", "item", "hashes"],
            )

    rows = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("block", T.LongType()), rows.schema["item"], T.StructField("hashes", T.BinaryType())])
    return stored(rows.mapInArrow(hashed, schema), "test-items")


def _by_block(index: DataFrame, items: DataFrame, window: int, search, schema: T.StructType) -> DataFrame:
    """`search` over the index for each block of items; a block has a bounded size."""
    spark = index.sparkSession
    out = None
    for block in sorted(r.block for r in items.select("block").distinct().collect()):
        rows = items.where(F.col("block") == block).select("item", "hashes").collect()
        shared = spark.sparkContext.broadcast([(r.item, bytes(r.hashes)) for r in rows])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            opened = Block(shared.value, window)
            types = [f.type for f in _arrow(schema)]
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1).to_pylist()[0]
                    found = search(opened, Segment(row), row["segment"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(found, types)], names=schema.names
                    )

        part = index.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    words: str = "alnum",
    lower: bool = True,
    index: DataFrame | None = None,
) -> DataFrame:
    """One row per document: id, `n_words`, `n_hit`, `items` (distinct ids, as strings, sorted), `stretches`.

    `stretches` are the disjoint ranges of hit words, as (begin, end). An item of fewer words than `window`
    is one window; an item without words has none. An empty benchmark hits nothing.
    """
    if index is None:
        index = build_index(docs, id_col, text_col, words, lower)
    items = _items(benchmark, item_id_col, item_text_col, words, lower)
    stretch = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("id", index.schema["doc_ids"].dataType.elementType),
            T.StructField("n_words", T.LongType()),
            T.StructField("stretches", stretch),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )

    def search(block: Block, segment: Segment, number: int) -> list[list]:
        at, counts = segment.look_up(block.vocabulary)
        delta = np.zeros(segment.span + 1, np.int64)
        named: dict[int, set[str]] = {}
        for matrix, owners in block.groups:
            phrase, start = segment.phrases(matrix, at, counts)
            np.add.at(delta, start, 1)
            np.add.at(delta, start + matrix.shape[1], -1)
            for p, text in set(zip(phrase.tolist(), segment.text_of(start).tolist())):
                named.setdefault(text, set()).update(str(block.ids[i]) for i in owners[p] if block.ids[i] is not None)
        hit = np.cumsum(delta) > 0
        edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0))
        begins, ends = edge[::2], edge[1::2]
        text = segment.text_of(begins)
        stretches: dict[int, list] = {}
        for t, b, e in zip(text.tolist(), begins.tolist(), ends.tolist()):
            base = int(segment.begin[t])
            stretches.setdefault(t, []).append({"begin": b - base, "end": e - base})
        n = len(segment.doc_ids)
        return [
            [number] * n,
            list(range(n)),
            segment.doc_ids,
            segment.n_words.tolist(),
            [stretches.get(i, []) for i in range(n)],
            [sorted(named.get(i, ())) for i in range(n)],
        ]

    found = _by_block(index, items, window, search, schema)
    if found is None:  # no test items at all
        found = _by_block(index, items.sparkSession.createDataFrame([(0, None, b"")], items.schema), window, search, schema)
    return _merged(found).select(
        F.col("id").alias(id_col), "n_words", _length(F.col("stretches")).alias("n_hit"), "items", "stretches"
    )


def _merged(found: DataFrame) -> DataFrame:
    """One row per document from one per document and block; lists of a document are bounded by its length."""
    rows = found.groupBy("segment", "n").agg(
        F.first("id").alias("id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("stretches"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return rows.withColumn("stretches", _joined(F.col("all")))


def _joined(stretches: Column) -> Column:
    """Sorted ranges with overlapping ones made one."""
    kind = "array<struct<begin:int,end:int>>"

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["end"] < x["begin"])
        grown = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(apart, F.concat(done, F.array(x))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))
        )

    disjoint = F.aggregate(stretches, F.array().cast(kind), add)
    return F.when(F.size(stretches) <= 1, stretches).otherwise(disjoint)


def _length(stretches: Column) -> Column:
    return F.aggregate(stretches, F.lit(0).cast("bigint"), lambda n, x: n + (x["end"] - x["begin"]))


def proximity(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    words: str = "alnum",
    lower: bool = True,
    index: DataFrame | None = None,
) -> DataFrame:
    """Rows (id, item_id, `begin`, `end`): the shortest stretches of at most `span` words of a document that
    hold every distinct word of an item, in any order. Items without words match nothing."""
    if index is None:
        index = build_index(docs, id_col, text_col, words, lower)
    items = _items(benchmark, item_id_col, item_text_col, words, lower)
    schema = T.StructType(
        [
            T.StructField(id_col, index.schema["doc_ids"].dataType.elementType),
            T.StructField("item", items.schema["item"].dataType),
            T.StructField("begin", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )

    def search(block: Block, segment: Segment, number: int) -> list[list]:
        at, counts = segment.look_up(block.vocabulary)
        rows = [
            (segment.doc_ids[t], block.ids[i], b, e)
            for i, terms in enumerate(block.items)
            for t, b, e in segment.near(np.unique(terms), at, counts, span)
        ]
        return [list(c) for c in zip(*rows)] if rows else [[], [], [], []]

    found = _by_block(index, items, 1, search, schema)
    if found is None:
        found = index.sparkSession.createDataFrame([], schema)
    return found.withColumnRenamed("item", item_id_col)
