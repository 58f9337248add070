"""Spelling variants: words one edit apart, found by generated edits and Bloom filters.

The vocabulary is counted over all texts. Every word's edits (one letter left out, or replaced by a later letter that
occurs somewhere) are generated as hashes only and probed against blocked Bloom filters: one filter for each word length,
made of 64-bit blocks of which a key sets `BITS` bits, so a probe is one look-up. What passes is joined with the
vocabulary by hash; the join and a comparison of the two spellings remove false positives. Insertions need no probes
of their own: they are the deletions of the longer word.

Filters are built by Spark (blocks are or-ed by key) and broadcast in batches of at most `FILTER_BYTES`. A vocabulary
beyond one batch takes several passes; a length beyond one batch is split by hash. So no broadcast grows with the data.

A word is a variant of the near word that occurs most often if that one is `RATIO` times as frequent. Following these
from word to word ends after a logarithmic number of steps, since counts grow by `RATIO` each time; the ends are found
by pointer doubling.

Defined results: null and empty texts have no words; documents with null ids have words like any other, which none of
`noise` touches. Repeated rows count as often as they stand. An empty vocabulary gives no rows. Among near words of equal
count the smallest in code-point order is the form.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import words as W
from .common import prepare, stored

LEAST_LENGTH, LEAST_COUNT, RATIO, NOISE = 7, 2, 10, 31
BITS, WORDS_PER_BLOCK = 5, 4  # 16 bits for each word
FILTER_BYTES = 16 << 20  # of one batch of filters
LONGEST = 64  # words from this length on share one filter
PROBED = "id bigint, edit bigint, place int, put int"
AT_ONCE = 1 << 21  # probes that a task makes at a time
PENDING = 200_000  # distinct words that a task holds before it hands them on
PIECE = 1 << 20  # letters of a text that are read at a time

_LETTERS = "a-zÀ-ÿ"
_MULTIPLIER = 0x9E3779B97F4A7C15


# --- counting words -----------------------------------------------------------------------------


def _runs(text: str, least: int) -> Iterator[Counter]:
    """Counts of the lower-cased runs of at least `least` letters, for bounded pieces cut beside a run."""
    # Only ASCII capitals are lowered; bytes do just that.
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    find, gap = re.compile(f"[{_LETTERS}]{{{least},}}"), re.compile(f"[^{_LETTERS}]")
    begin = 0
    while begin < len(lowered):
        cut = len(lowered)
        if cut - begin > PIECE:
            found = gap.search(lowered, begin + PIECE)
            cut = found.start() if found else cut
        yield Counter(find.findall(lowered, begin, cut))
        begin = cut


def damaged(run: str, h: int) -> str:
    """The run without the letter that `h` names."""
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    noise: int | None = NOISE,
) -> DataFrame:
    """Words and how often they occur: (word, n).

    With `noise`, a run loses a letter where that number divides the crc32 of "<id>:<run>".
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(pending.keys(), pa.string()), pa.array(pending.values(), pa.int64())], ["word", "n"])
            pending.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for found in _runs(text.as_py() or "", least_length):
                    if noise and name is not None:
                        seed = zlib.crc32(f"{name}:".encode())
                        for run in [r for r in found if zlib.crc32(r.encode(), seed) % noise == 0]:
                            n = found.pop(run)
                            short = damaged(run, zlib.crc32(run.encode(), seed))
                            if len(short) >= least_length:
                                pending[short] += n
                    pending.update(found)
                    if len(pending) > PENDING:
                        yield flush()
        yield flush()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


# --- hashes of words and of their edits ----------------------------------------------------------


def _letter(points: np.ndarray) -> np.ndarray:
    """A fixed 64-bit number for each code point."""
    points = points.astype(np.uint64)
    with np.errstate(over="ignore"):
        return W.mix(points * np.uint64(_MULTIPLIER) + np.uint64(0x5851F42D4C957F2D))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _MULTIPLIER | 1, np.uint64)]))


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words after one another, and where each word begins."""
    lengths = np.array([len(w) for w in words], np.int64)
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, "<u4"), np.concatenate([[0], np.cumsum(lengths)])


def hashes(words: list[str]) -> np.ndarray:
    """64-bit hash of each word: a polynomial in its letters, so that an edit's hash follows from it."""
    points, first = _points(words)
    if not len(words):
        return np.zeros(0, np.uint64)
    place = np.arange(len(points)) - np.repeat(first[:-1], np.diff(first))
    with np.errstate(over="ignore"):
        terms = np.append(_letter(points) * _powers(int(np.diff(first).max()))[place], np.uint64(0))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        return W.mix(total[first[1:]] - total[first[:-1]])


def edits(points: np.ndarray, alphabet: np.ndarray, begin: int, end: int) -> Iterator[tuple[np.ndarray, int]]:
    """Hashes of the edits at the places from `begin` to `end`, for words of one length (rows of code points).

    Yields (hashes, how much shorter): the deletions, then the replacements by later letters. An edit that another
    deletion makes too, or that changes nothing, is 0.
    """
    n, length = points.shape
    power = _powers(length)
    with np.errstate(over="ignore"):
        letters = _letter(points)
        terms = letters * power[:length]
        left = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        whole = left[:, -1:] + terms[:, -1:]
        # Without a letter, those behind it move down by one power.
        right = np.zeros_like(terms)
        right[:, 1:] = letters[:, 1:] * power[: length - 1]
        right = np.cumsum(right[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        after = np.zeros((n, length), np.uint64)
        after[:, :-1] = right[:, 1:]
        gone = W.mix(left + after)
        gone[:, 1:][points[:, 1:] == points[:, :-1]] = 0
        yield gone[:, begin:end], 1
        others = _letter(alphabet)
        moved = whole[:, :, None] + (others[None, None, :] - letters[:, begin:end, None]) * power[None, begin:end, None]
        swapped = W.mix(moved)
        swapped[alphabet[None, None, :] <= points[:, begin:end, None]] = 0
        yield swapped, 0


# --- blocked Bloom filters ------------------------------------------------------------------------


def _mask(h: np.ndarray) -> np.ndarray:
    """The bits of its block that a key sets."""
    with np.errstate(over="ignore"):
        h = W.mix(h ^ np.uint64(0xD1B54A32D192ED03))
        out = np.zeros(h.shape, np.uint64)
        for k in range(BITS):
            out |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return out


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


class Filters:
    """Filters of one batch: for each length the blocks numbered from `low` on, out of all blocks of that length."""

    def __init__(self, parts: dict[int, tuple[int, int, np.ndarray]] | None = None) -> None:
        self.parts = parts or {}

    def add(self, length: int, blocks: int, low: int, high: int) -> None:
        self.parts[length] = (blocks, low, np.zeros(high - low, np.uint64))

    def passes(self, h: np.ndarray, length: int) -> np.ndarray:
        """Which hashes may belong to words of this length; 0 stands for no edit."""
        part = self.parts.get(min(length, LONGEST))
        if part is None:
            return np.zeros(h.shape, bool)
        blocks, low, bits = part
        at = _block(h, blocks).astype(np.int64) - low
        inside = (at >= 0) & (at < len(bits)) & (h != 0)
        mask = _mask(h)
        return inside & (bits[np.clip(at, 0, len(bits) - 1)] & mask == mask)


def _batches(sizes: dict[int, int], most: int) -> list[list[tuple[int, int, int, int]]]:
    """Batches of (length, blocks, low, high) with at most `most` blocks together, for `sizes` words of each length."""
    out: list[list[tuple[int, int, int, int]]] = []
    room = 0
    for length, n in sorted(sizes.items()):
        blocks, low = -(-n // WORDS_PER_BLOCK) + 1, 0
        while low < blocks:
            if not room:
                out.append([])
                room = most
            high = min(blocks, low + room)
            out[-1].append((length, blocks, low, high))
            room -= high - low
            low = high
    return out


def _blocked(words: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """All filters as rows (length, block, bits)."""

    def keys(spelled: pa.Array) -> pa.Array:
        found = spelled.to_pylist()
        h = hashes(found)
        lengths = np.minimum([len(w) for w in found], LONGEST)
        blocks = np.array([-(-sizes[int(k)] // WORDS_PER_BLOCK) + 1 for k in lengths], np.uint64)
        columns = [pa.array(lengths, pa.int32()), pa.array(_block(h, blocks).astype(np.int64)), pa.array(_mask(h).view(np.int64))]
        return pa.StructArray.from_arrays(columns, ["length", "block", "bits"])

    rows = words.select(F.arrow_udf(keys, "length int, block bigint, bits bigint")("word").alias("key")).select("key.*")
    return rows.groupBy("length", "block").agg(F.bit_or("bits").alias("bits"))


def _probed(words: DataFrame, alphabet: np.ndarray, filters: Filters) -> DataFrame:
    """Edits of the words that pass the filters: hashes of word and edit, place from 0, code point put there (0: none)."""
    shared = words.sparkSession.sparkContext.broadcast(filters.parts)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(shared.value)
        for batch in batches:
            spelled = batch.column(0).to_pylist()
            own = hashes(spelled)
            lengths = np.array([len(w) for w in spelled])
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                cells = int(length) * (len(alphabet) + 1)
                step = max(1, AT_ONCE // cells)
                places = max(1, AT_ONCE // (len(alphabet) + 1)) if cells > AT_ONCE else int(length)
                for a in range(0, len(rows), step):
                    some = rows[a : a + step]
                    points = _points([spelled[i] for i in some])[0].reshape(len(some), int(length))
                    for begin in range(0, int(length), places):
                        for h, shorter in edits(points, alphabet, begin, min(begin + places, int(length))):
                            at = np.nonzero(filters.passes(h, int(length) - shorter))
                            if len(at[0]):
                                put = np.zeros(len(at[0]), np.uint32) if shorter else alphabet[at[2]]
                                columns = [own[some[at[0]]].view(np.int64), h[at].view(np.int64), at[1] + begin, put.astype(np.int32)]
                                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "edit", "place", "put"])

    return words.select("word").mapInArrow(probe, PROBED)


def _spelled(point: Column) -> Column:
    """The letter of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "utf-32")


# --- near words -----------------------------------------------------------------------------------


def _identified(words: DataFrame) -> DataFrame:
    def own(spelled: pa.Array) -> pa.Array:
        return pa.array(hashes(spelled.to_pylist()).view(np.int64), pa.int64())

    return words.withColumn("id", F.arrow_udf(own, "bigint")("word"))


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of words (word, n, near, near_n) that differ by one edit, in both directions.

    `words`: (word, n), stored, each word once.
    """
    spark = prepare(words.sparkSession)
    length = F.least(F.char_length("word"), F.lit(LONGEST))
    sizes = {r.length: r.n for r in words.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct().collect()
    alphabet = np.array(sorted(ord(r.letter) for r in letters if r.letter), np.uint32)
    named = stored(_identified(words), "spelling-words")
    blocks = stored(_blocked(words, sizes), "spelling-filters")
    found = None
    for batch in _batches(sizes, FILTER_BYTES // 8):
        filters = Filters()
        wanted = F.lit(False)
        for size, n, low, high in batch:
            filters.add(size, n, low, high)
            wanted = wanted | ((F.col("length") == size) & (F.col("block") >= low) & (F.col("block") < high))
        # Bounded: at most FILTER_BYTES of blocks, however large the vocabulary is.
        got = blocks.where(wanted).toArrow()
        lengths, places, bits = (got.column(k).to_numpy() for k in range(3))
        for size, (_, low, out) in filters.parts.items():
            of = lengths == size
            out[places[of] - low] = bits[of].view(np.uint64)
        probed = _probed(words, alphabet, filters)
        found = probed if found is None else found.unionByName(probed)
    if found is None:
        found = spark.createDataFrame([], PROBED)
    # Hashes alone meet first; few false positives are left when the spellings come in.
    pairs = found.join(named.select(F.col("id").alias("edit"), F.col("word").alias("near"), F.col("n").alias("near_n")), "edit")
    made = F.concat(
        F.substr("word", F.lit(1), F.col("place")),
        F.when(F.col("put") == 0, "").otherwise(_spelled(F.col("put"))),
        F.substr("word", F.col("place") + 2),
    )
    pairs = pairs.join(named, "id").where(made == F.col("near")).select("word", "n", "near", "near_n")
    pairs = stored(pairs, "spelling-pairs")
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(back)


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Each word with its form and root: (word, form, root, n, n_near, form_n).

    `words`: (word, n), each word once. `ratio` is over 1, so forms never lead in a circle.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    words = stored(words, "spelling-vocabulary")
    beside = near_words(words)
    first = F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("first")
    beside = beside.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    rows = words.join(beside, "word", "left")
    form_n = -F.col("first.rank")
    good = form_n >= ratio * F.col("n")
    rows = rows.select(
        "word",
        F.when(good, F.col("first.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(good, form_n).alias("form_n"),
    )
    rows = stored(rows, "spelling-forms")
    return rows.join(_roots(rows, ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "form", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(rows: DataFrame, ratio: int) -> DataFrame:
    """Where the forms of a word end: (word, root), for words that have a form."""
    most = rows.agg(F.max("n"), F.min("n")).first()
    steps = math.ceil(math.log(max(1, (most[0] or 1) / (most[1] or 1)), ratio)) + 1  # counts grow by `ratio` each time
    links = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        links = stored(links, "spelling-links")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return links


# The contract of `op11_spelling`: crc32 bit by bit, replacements by what is left without one letter.
_KEY = "hex(encode(concat(doc_id, ':', r)))"
_BITS = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
_CRC = (
    f"xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(0, length({_KEY}) // 2),"
    f" lambda i: ('0x' || substr({_KEY}, 2 * i + 1, 2))::bigint)), lambda c, b: {_BITS}), 4294967295)"
)
SQL = f"""WITH RECURSIVE runs AS (
 SELECT doc_id, r, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) AS r FROM documents) d GROUP BY 1, 2),
damaged AS (SELECT r, c, {_CRC} AS h FROM runs),
v AS (
 SELECT w AS word, cast(sum(c) AS bigint) AS n FROM (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS w, c FROM damaged) x
 WHERE length(w) >= 7 GROUP BY 1 HAVING sum(c) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v) x),
pairs AS (
 SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
 UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
 UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY word),
forms AS (
 SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * v.n THEN top END AS form_n,
  CASE WHEN top >= 10 * v.n THEN (SELECT min(encode(near)) FROM pairs p WHERE p.word = v.word AND p.near_n = top) END AS form
 FROM v LEFT JOIN best ON v.word = best.word),
chain AS (
 SELECT word, word AS root, 0 AS step FROM v
 UNION ALL SELECT c.word, decode(f.form), step + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, decode(form) AS form, root, n, n_near, form_n FROM forms f
JOIN (SELECT * FROM chain QUALIFY row_number() OVER (PARTITION BY word ORDER BY step DESC) = 1) c ON f.word = c.word"""
