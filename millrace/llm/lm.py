"""Documents scored by cross-entropy difference between a target and a background language model.

Both models are word bigram models over one vocabulary: all words of all documents. The background model counts all
documents, the target model those that are labelled as wanted. Bigram chances are smoothed towards the model's own
word chances, and these towards the word chances of all documents, with the same strengths in both. A document's
score is its mean loss per token under the target model minus that under the background model: the lower, the more
it is like the target.

Counts cover every document and every word; words and pairs of words are told apart by 64-bit hashes. Losses are summed
in fixed point (steps of 2^-24), so that the order of rows does not matter.

`differences` scores the documents that the models are counted on, which is what selecting from a corpus needs. A loss is
-log(n of the pair + pull * chance of its own word) + log(n of the word before + pull). All that the first term needs comes
together where the pairs of one own word do, and so does the second, for that word's part as the word before. So each
text's pairs are shuffled once, by own word, in packed blocks; their sums go back to the texts of the block. Nothing is
joined and no pair is stored. Words that a bucket could not hold are among the most frequent ones, of which there are at
most `HOT`; their counts are known from the pass that counts the words, and their pairs are dealt out by both words.

`fit` and `score` serve other documents: pairs are counted and stored as a table, each pair's losses come from joins
with the counts of its two words, and each text's pairs meet their losses in a join. That takes many times the input in
shuffles.

Only if a caller gives `size`, the vocabulary is the most frequent words, and classes (by length and first letter) stand
for the others.

Defined results: null and empty texts have no tokens and null losses. Without any wanted document the target
model is the smoothing alone. Labels of one id are merged by their maximum; null ids are never wanted. Words and pairs
that were not counted have the chance that smoothing leaves them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F

from . import words as W
from .common import BATCH_BYTES, content_key, prepare, shuffles_dropped, stored

CLASSES = 32
FLUSH = 500_000
PAIRS = 1_500_000  # pairs that a task holds before it passes them on
HOT = 1_000  # most frequent words whose pairs may be dealt out over all buckets
BUCKET = 2_000_000  # pairs of texts that are meant to meet in one bucket
BLOCK_TEXTS = 1 << 14  # texts of a block, so that a text's number and two flags fit 16 bits
BIGRAM_PULL, WORD_PULL = 50.0, 500.0
STEP = 1 << 24


@dataclass
class Vocabulary:
    """Sorted hashes of the words that have a number of their own, or None if all have; a text's start is number 0."""

    hashes: np.ndarray | None
    seen: int = 0  # words of their own where there is no list

    @property
    def size(self) -> int:
        return 1 + CLASSES + (self.seen if self.hashes is None else len(self.hashes))

    def numbers(self, found: W.Words) -> np.ndarray:
        if self.hashes is None:
            return found.hash.view(np.int64)
        at = np.minimum(np.searchsorted(self.hashes, found.hash), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == found.hash if len(self.hashes) else np.zeros(len(found.hash), bool)
        length = np.minimum(np.log2(found.end - found.start).astype(np.int64), 7) if len(known) else at
        first = found.data[found.start]
        kind = np.where(first >= 0x80, 3, np.where((first | 0x20) - 0x61 <= 25, np.where(first & 0x20 > 0, 0, 1), 2))
        return np.where(known, 1 + CLASSES + at, 1 + length * 4 + kind)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, n) of the words of a task, summed up as far as memory allows."""
    held, counts, size = [], [], 0

    def merged() -> pa.RecordBatch:
        distinct, inverse = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
        held[:], counts[:] = [distinct], [total]
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(total)], names=["hash", "n"])

    for batch in batches:
        for begin, end in W.slices(batch.column(0), 4 << 20):
            distinct, n = np.unique(W.find(batch.column(0).slice(begin, end - begin)).hash, return_counts=True)
            held.append(distinct)
            counts.append(n)
            size += len(distinct)
            if size > FLUSH:
                out = merged()
                size = out.num_rows
                if size > FLUSH // 2:
                    yield out
                    held, counts, size = [], [], 0
    if held:
        yield merged()


def vocabulary(docs: DataFrame, text_col: str = "text", size: int | None = None) -> Vocabulary:
    """All words, or the most frequent of all documents (ties by hash), as many as fit beside the classes."""
    if size is None:
        return Vocabulary(None)
    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_word_counts, "hash bigint, n bigint")
    counts = counts.groupBy("hash").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.col("n").desc(), "hash").limit(max(0, size - 1 - CLASSES)).collect()
    return Vocabulary(np.sort(np.array([r.hash for r in top], np.int64).view(np.uint64)))


def _pairs(found: W.Words, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Number of the word before each word, and its own; 0 stands before the first."""
    own = words.numbers(found)
    before = np.zeros_like(own)
    before[1:] = own[:-1]
    before[found.first[:-1][np.diff(found.first) > 0]] = 0
    return before, own


def _hashed(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    return W.joined(before.view(np.uint64), own.view(np.uint64))


def pair_counts(rows: DataFrame, words: Vocabulary) -> DataFrame:
    """rows: text, wanted. Per pair of words its count in all documents and in the wanted ones."""
    names = ["before", "own", "n", "n_wanted"]

    def summed(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        before, own, *counts = (np.concatenate(c) for c in zip(*parts))
        _, at, inverse = np.unique(_hashed(before, own), return_index=True, return_inverse=True)
        return [before[at], own[at], *(np.bincount(inverse, c, len(at)).astype(np.int64) for c in counts)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            wanted = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for begin, end in W.slices(batch.column(0)):
                found = W.find(batch.column(0).slice(begin, end - begin))
                ones = np.ones(len(found.hash), np.int64)
                held.append(summed([[*_pairs(found, words), ones, wanted[begin:end][found.text_of()]]]))
                size += len(held[-1][0])
                if size > PAIRS:
                    held = [summed(held)]
                    size = len(held[0][0])
                    if size > PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], names=names)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in summed(held)], names=names)

    parts = rows.select("text", "wanted").mapInArrow(count, "before bigint, own bigint, n bigint, n_wanted bigint")
    return parts.groupBy("before", "own").agg(F.sum("n").alias("n"), F.sum("n_wanted").alias("n_wanted"))


@dataclass
class Models:
    words: Vocabulary
    pairs: DataFrame  # before, own, n, n_wanted
    singles: DataFrame  # own, n, n_wanted
    tokens: int
    wanted_tokens: int

    def losses(self, pairs: DataFrame) -> DataFrame:
        """Of each pair in a table like `pairs`: its key and its losses in steps of the fixed point."""
        own = self.singles.select("own", F.col("n").alias("own_n"), F.col("n_wanted").alias("own_wanted"))
        first = self.pairs.groupBy("before").agg(F.sum("n").alias("first_n"), F.sum("n_wanted").alias("first_wanted"))
        rows = pairs.join(own, "own", "left").join(first, "before", "left")
        everywhere = (_or_none("own_n") + 0.5) / F.lit(self.tokens + 0.5 * self.words.size)

        def loss(n: str, single: str, context: str, tokens: int) -> Column:
            word = (_or_none(single) + WORD_PULL * everywhere) / F.lit(tokens + WORD_PULL)
            chance = (F.col(n) + BIGRAM_PULL * word) / (_or_none(context) + BIGRAM_PULL)
            return F.round(-F.log(chance) * STEP).cast("bigint")

        return rows.select(
            F.xxhash64("before", "own").alias("pair"),
            loss("n_wanted", "own_wanted", "first_wanted", self.wanted_tokens).alias("target"),
            loss("n", "own_n", "first_n", self.tokens).alias("background"),
        )


def _or_none(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def _labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str) -> DataFrame:
    """id, text, wanted of each document."""
    wanted = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    wanted = wanted.agg(F.max(label).alias("label")).where("label > 0").select("id", F.lit(True).alias("wanted"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # Always by a shuffle of both sides, so that the plan is the same for few labels and for many.
    rows = rows.join(wanted.hint("merge"), "id", "left")
    return rows.select("id", "text", F.coalesce("wanted", F.lit(False)).alias("wanted"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int | None = None,
) -> Models:
    """Count both models. Documents whose label is above 0 are the target; all documents are the background."""
    prepare(docs.sparkSession)
    words = vocabulary(docs, text_col, size)
    rows = _labelled(docs, labels, label, id_col, text_col)
    pairs = stored(pair_counts(rows, words), "lm_pairs")
    singles = pairs.groupBy("own").agg(F.sum("n").alias("n"), F.sum("n_wanted").alias("n_wanted"))
    singles = stored(singles, "lm_words")
    total = singles.agg(F.count("*").alias("seen"), F.sum("n").alias("n"), F.sum("n_wanted").alias("n_wanted")).first()
    words.seen = total.seen
    return Models(words, pairs, singles, total.n or 0, total.n_wanted or 0)


def score(
    docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text", counted: bool = False
) -> DataFrame:
    """One row per document: id, `n_tokens`, `target_loss`, `background_loss`, `difference` (per token).

    `counted` says that `docs` are the documents that the models were fitted on, so that every pair is in the table.
    """
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    pairs = models.pairs
    if not counted:
        others = pair_counts(docs.select(text.alias("text"), F.lit(False).alias("wanted")), models.words)
        pairs = pairs.unionByName(others.withColumn("n", F.lit(0).cast("bigint"))).groupBy("before", "own")
        pairs = pairs.agg(F.sum("n").alias("n"), F.sum("n_wanted").alias("n_wanted"))
    words = models.words

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's pairs with their numbers."""
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in (1, 2)]
            for begin, end in W.slices(batch.column(0)):
                found = W.find(batch.column(0).slice(begin, end - begin))
                before, own = _pairs(found, words)
                row = found.text_of()
                order = np.lexsort((_hashed(before, own), row))
                before, own, row = before[order], own[order], row[order]
                new = np.ones(len(row), bool)
                new[1:] = (before[1:] != before[:-1]) | (own[1:] != own[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(row)))
                columns = [*(k[begin:end][row[at]] for k in keys), before[at], own[at], n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["key_a", "key_b", "before", "own", "n"]
                )

    texts = docs.select(text.alias("text"), *content_key(text))
    bags = texts.mapInArrow(bag, "key_a bigint, key_b int, before bigint, own bigint, n bigint")
    bags = bags.select("key_a", "key_b", F.xxhash64("before", "own").alias("pair"), F.col("n").cast("int").alias("n"))
    # Copies of a text add to one sum, and their tokens too: the means are those of one copy.
    sums = bags.join(models.losses(pairs), "pair").groupBy("key_a", "key_b")
    sums = sums.agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.col(c)).alias(c) for c in ("target", "background")))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x09-\x0D\x20]+")), F.lit(0)).cast("bigint").alias("n_tokens"),
        *content_key(text),
    )
    rows = rows.join(sums, ["key_a", "key_b"], "left")
    target, background = (F.col(c) / F.col("n") / STEP for c in ("target", "background"))
    return rows.select(
        F.col("id").alias(id_col),
        "n_tokens",
        target.alias("target_loss"),
        background.alias("background_loss"),
        (target - background).alias("difference"),
    )


@dataclass
class Totals:
    """What the losses need of the whole corpus: its size, and the counts of its most frequent words."""

    seen: int
    counts: list[int]  # tokens, those of wanted texts, texts with words, wanted ones of them
    hot: np.ndarray  # hashes, ascending
    hot_counts: np.ndarray  # by word: n, n wanted, as a text's last word, as that of a wanted text

    @property
    def buckets(self) -> int:
        return 1 + self.counts[0] // BUCKET

    def is_hot(self, own: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(own), bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, own), len(self.hot) - 1)] == own

    def first_terms(self, own: np.ndarray) -> list[np.ndarray]:
        """Of words by their counts (n, n wanted): pull times chance, under the target and the background model."""
        everywhere = (own[:, 0] + 0.5) / (self.counts[0] + 0.5 * (1 + CLASSES + self.seen))
        both = ((own[:, 1], self.counts[1]), (own[:, 0], self.counts[0]))
        return [BIGRAM_PULL * (n + WORD_PULL * everywhere) / (tokens + WORD_PULL) for n, tokens in both]

    def second_terms(self, own: np.ndarray) -> list[np.ndarray]:
        """Of words by their four counts: what they add to the loss of a word that follows them."""
        return [_steps(np.log(own[:, k] - own[:, k + 2] + BIGRAM_PULL)) for k in (1, 0)]


def _steps(loss: np.ndarray) -> np.ndarray:
    return np.rint(loss * STEP).astype(np.int64)


def totals(rows: DataFrame) -> Totals:
    """rows: text, wanted. All words are counted; the counts of the most frequent ones are kept."""
    names = ["own", "n", "n_wanted", "last", "last_wanted"]

    def summed(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        own, *counts = (np.concatenate(c) for c in zip(*parts))
        distinct, inverse = np.unique(own, return_inverse=True)
        return [distinct, *(np.bincount(inverse, c, len(distinct)).astype(np.int64) for c in counts)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            wanted = batch.column(1).to_numpy(zero_copy_only=False)
            for begin, end in W.slices(batch.column(0)):
                found = W.find(batch.column(0).slice(begin, end - begin))
                chosen = wanted[begin:end][found.text_of()]
                last = found.room() == 1
                counts = (np.ones(len(last), np.int64), chosen, last, chosen & last)
                held.append(summed([[found.hash.view(np.int64), *counts]]))
                size += len(held[-1][0])
                if size > PAIRS:
                    held = [summed(held)]
                    size = len(held[0][0])
                    if size > PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], names=names)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in summed(held)], names=names)

    parts = rows.select("text", "wanted").mapInArrow(count, ", ".join(f"{name} bigint" for name in names))
    words = parts.groupBy("own").agg(*(F.sum(name).alias(name) for name in names[1:]))
    watch = Observation()
    words = words.observe(watch, F.count("*").alias("seen"), *(F.sum(name).alias(name) for name in names[1:]))
    top = words.orderBy(F.col("n").desc(), "own").limit(HOT).collect()
    found = watch.get if top else {}
    # A word that is not among them has at most one in `HOT` tokens.
    hot = sorted((r for r in top if r.n > BUCKET // 8), key=lambda r: r.own % (1 << 64))
    return Totals(
        found.get("seen") or 0,
        [found.get(name) or 0 for name in names[1:]],
        np.array([r.own for r in hot], np.int64).view(np.uint64),
        np.array([r[1:] for r in hot], np.int64).reshape(-1, 4),
    )


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers in one compressed value; their kinds are known to who reads it."""
    plain = np.array([len(c) for c in columns], np.int64).tobytes() + b"".join(c.tobytes() for c in columns)
    return len(plain).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(plain, asbytes=True)


def _unpacked(value: bytes, *kinds: type) -> list[np.ndarray]:
    plain = pa.Codec("zstd").decompress(value[8:], int.from_bytes(value[:8], "little"), asbytes=True)
    at, columns = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(plain, np.int64, len(kinds)).tolist(), kinds):
        columns.append(np.frombuffer(plain, kind, n, at))
        at += columns[-1].nbytes
    return columns


# A block's pairs for one bucket: own words and their runs, then for each row the word before, text and flags, count.
_ROWS = (np.uint64, np.uint32, np.uint64, np.uint16, np.uint32)
# What comes back of them: texts, tokens, sums under both models.
_SUMS = (np.uint16, np.uint32, np.int64, np.int64)


def _block(texts: pa.Array, wanted: np.ndarray, known: Totals) -> tuple[np.ndarray, list[tuple[int, bytes]]]:
    """Tokens of each text, and the packed pairs of the texts for each bucket."""
    found = [W.find(texts.slice(begin, end - begin)) for begin, end in W.slices(texts)]
    tokens = np.concatenate([np.diff(f.first) for f in found])
    words, own = np.unique(np.concatenate([f.hash for f in found]), return_inverse=True)
    del found
    ends = np.cumsum(tokens)[tokens > 0]
    if not len(ends):
        return tokens, []
    words = np.append(words, np.uint64(0))  # before a text's first word
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[np.append(0, ends[:-1])] = len(words) - 1
    last = np.zeros(len(own), np.uint64)
    last[ends - 1] = 1
    # One number for each token, so that sorting brings equal pairs of a text together.
    wide, docs = np.uint64(len(words).bit_length()), np.uint64(len(tokens).bit_length())
    if 2 * int(wide) + int(docs) + 1 > 64:
        raise ValueError("too many different words in one block")
    text = np.repeat(np.arange(len(tokens), dtype=np.uint64), tokens)
    code = ((((own.astype(np.uint64) << wide) | before.astype(np.uint64)) << docs | text) << np.uint64(1)) | last
    del own, before, last, text
    code.sort()
    one = np.uint64(1)
    start = np.flatnonzero(np.append(True, code[1:] >> one != code[:-1] >> one))
    n = np.diff(np.append(start, len(code))).astype(np.uint32)
    code = code[start + n - 1]
    text = (code >> one) & ((one << docs) - one)
    flags = (text << np.uint64(2) | wanted[text].astype(np.uint64) << one | code & one).astype(np.uint16)
    before = words[(code >> (docs + one)) & ((one << wide) - one)]
    own = words[code >> (wide + docs + one)]
    del code, text
    # Ranges of hashes, so that rows stay in order; pairs of hot words by both words.
    place = own.copy()
    hot = known.is_hot(own)
    place[hot] = W.joined(before[hot], own[hot])
    bucket = (place >> np.uint64(32)) * np.uint64(known.buckets) >> np.uint64(32)
    if hot.any():
        order = np.argsort(bucket, kind="stable")
        own, before, flags, n, bucket = (c[order] for c in (own, before, flags, n, bucket))
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    out = []
    for begin, end in zip(cuts, np.append(cuts[1:], len(bucket))):
        mine = own[begin:end]
        runs = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
        sizes = np.diff(np.append(runs, len(mine))).astype(np.uint32)
        out.append((int(bucket[begin]), _packed(mine[runs], sizes, before[begin:end], flags[begin:end], n[begin:end])))
    return tokens, out


def _digest(rows: pa.RecordBatch) -> bytes:
    """Of the ids and texts of a block."""
    made = hashlib.sha256()
    for column in (rows.column(0).cast(pa.string()), rows.column(1)):
        for part in W.flat(column):
            made.update(np.ascontiguousarray(part))
    return made.digest()


def _summed(values: list[bytes], known: Totals) -> list[bytes]:
    """The packed pairs that meet in a bucket, and for each block the sums of its texts."""
    parts = [_unpacked(value, *_ROWS) for value in values]
    words, runs, before, flags, n = (np.concatenate(c) for c in zip(*parts))
    bounds = np.cumsum([0] + [len(p[4]) for p in parts])
    del parts
    n = n.astype(np.int64)
    distinct, inverse = np.unique(words, return_inverse=True)
    own = np.repeat(inverse, runs)
    chosen, last = flags & 2 > 0, flags & 1 > 0
    counts = np.stack([np.bincount(own, c, len(distinct)) for c in (n, n * chosen, last, last & chosen)], axis=1)
    hot = known.is_hot(distinct)
    counts[hot] = known.hot_counts[np.searchsorted(known.hot, distinct[hot])]
    pair = W.joined(before, distinct[own])
    del before
    order = np.argsort(pair)
    pair = pair[order]
    start = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    group = np.empty(len(pair), np.int64)
    group[order] = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(pair))))
    word = own[order[start]]
    del pair, order
    together = [np.bincount(group, c, len(start)) for c in (n * chosen, n)]
    sums = []
    for found, pull, second in zip(together, known.first_terms(counts), known.second_terms(counts)):
        sums.append(n * _steps(-np.log(found + pull[word]))[group] + (n - last) * second[own])
    text = flags >> 2
    out = []
    for begin, end in zip(bounds[:-1], bounds[1:]):
        mine = text[begin:end]
        tokens = np.bincount(mine, n[begin:end]).astype(np.uint32)
        there = np.flatnonzero(tokens)
        by_text = [np.zeros(len(tokens), np.int64) for _ in sums]
        for total, rows in zip(by_text, sums):
            np.add.at(total, mine, rows[begin:end])
        out.append(_packed(there.astype(np.uint16), tokens[there], *(total[there] for total in by_text)))
    return out


def differences(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`score` of the documents that `fit` counts, in one shuffle of their pairs and with no table of them.

    The models are those of `fit`; losses are rounded to steps term by term, so that a mean loss differs from that of
    `score` by a step (2^-24) at most.
    """
    prepare(docs.sparkSession)
    rows = _labelled(docs, labels, label, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    with shuffles_dropped(docs.sparkSession):
        known = totals(rows)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in W.slices(batch.column(1), BATCH_BYTES):
                for at in range(begin, end, BLOCK_TEXTS):
                    part = batch.slice(at, min(BLOCK_TEXTS, end - at))
                    tokens, found = _block(part.column(1), part.column(2).to_numpy(zero_copy_only=False), known)
                    # A number that a repeated task finds again; the counts of tokens tell if it did not.
                    block = int.from_bytes(_digest(part)[:8], "little", signed=True)
                    ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0))
                    home = [block % known.buckets] + [bucket for bucket, _ in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(home, pa.int32()),
                            pa.array([block] * len(home), pa.int64()),
                            pa.array([_packed(tokens)] + [value for _, value in found], pa.binary()),
                            pa.concat_arrays([ids, pa.nulls(len(found), ids.type)]),
                        ],
                        names=["bucket", "block", "body", "ids"],
                    )

    def meet(table: pa.Table) -> pa.Table:
        heads = table.filter(table["ids"].is_valid())
        pairs = table.filter(table["ids"].is_null())
        if not len(pairs):
            return heads.drop_columns("bucket")
        sums = pa.chunked_array([pa.array(_summed(pairs["body"].to_pylist(), known), pa.binary())])
        pairs = pairs.set_column(pairs.schema.get_field_index("body"), "body", sums)
        return pa.concat_tables([heads, pairs]).drop_columns("bucket")

    starts = [int(_steps(np.log(known.counts[k] + BIGRAM_PULL))) for k in (3, 2)]

    def finish(table: pa.Table) -> pa.Table:
        heads = table.filter(table["ids"].is_valid())
        # Blocks of the same rows have the same number and the same sums.
        copies = len(heads)
        tokens = _unpacked(heads["body"][0].as_py(), np.int64)[0]
        read, target, background = (np.zeros(len(tokens), np.int64) for _ in range(3))
        for value in table.filter(table["ids"].is_null())["body"].to_pylist():
            text, n, *sums = _unpacked(value, *_SUMS)
            for total, part in zip((read, target, background), (n, *sums)):
                total[text] += part
        if (read != tokens * copies).any():
            raise RuntimeError("a block's pairs and its texts do not belong together")
        whole = [total // copies + start for total, start in zip((target, background), starts)]
        columns = [heads["ids"].combine_chunks().flatten()]
        columns += [pa.array(np.tile(c, copies)) for c in (tokens, *whole)]
        return pa.Table.from_arrays(columns, names=["id", "n_tokens", "target", "background"])

    blocks = rows.mapInArrow(pack, f"bucket int, block bigint, body binary, ids array<{kind}>")
    sums = blocks.groupBy("bucket").applyInArrow(meet, f"block bigint, body binary, ids array<{kind}>")
    found = sums.groupBy("block").applyInArrow(
        finish, f"id {kind}, n_tokens bigint, target bigint, background bigint"
    )
    target, background = (
        F.when(F.col("n_tokens") > 0, F.col(c)) / F.nullif("n_tokens", F.lit(0)) / STEP for c in ("target", "background")
    )
    return found.select(
        F.col("id").alias(id_col),
        "n_tokens",
        target.alias("target_loss"),
        background.alias("background_loss"),
        (target - background).alias("difference"),
    )
