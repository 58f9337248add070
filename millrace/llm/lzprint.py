"""Lempel-Ziv phrase fingerprints.

A text is parsed from left to right into phrases, each the shortest stretch that is not in the dictionary yet, which
it then joins; what is left at the end and known is dropped. The set of phrases says how the text compresses:
texts that would help to compress each other share phrases. Phrases are hashed and the least `SIZE` hashes are
the fingerprint; of two fingerprints the share of common values among the least of both estimates the Jaccard index
of the phrase sets.

Every prefix of a phrase is a phrase, so the end of the next one is found by a short search and not letter by
letter. A text of n characters costs time and memory in proportion to n, in the task that holds it. Null counts as
empty; empty texts have an empty fingerprint, which is like itself (1) and unlike all others (0).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import words as W
from .common import prepare

SIZE = 128
BUCKETS = 8  # ranges of ids for each shuffle partition


def parse(text: str, known: set[str], start: int = 0) -> list[int]:
    """Ends of the phrases from `start` on; they are added to `known`."""
    ends = []
    add, append, n = known.add, ends.append, len(text)
    while start < n:
        phrase = text[start : start + 4]
        if phrase in known:
            end = start + 5
            while end <= n:
                phrase = text[start:end]
                if phrase not in known:
                    break
                end += 1
            else:
                break
        else:
            three = phrase[:3]
            if three not in known:
                two = three[:2]
                if two in known:
                    phrase = three
                elif two[:1] in known:
                    phrase = two
                else:
                    phrase = two[:1]
            end = start + len(phrase)
        add(phrase)
        append(end)
        start = end
    return ends


def hashes(text: str, ends: list[int], start: int = 0) -> np.ndarray:
    """32-bit hashes of the phrases text[start:ends[0]], text[ends[0]:ends[1]], ..."""
    if not ends:
        return np.zeros(0, np.uint32)
    letters = np.frombuffer(text[start : ends[-1]].encode("utf-32-le", "surrogatepass"), "<u4")
    after = np.array(ends) - start
    begins = np.append(0, after[:-1])
    lengths = after - begins
    offset = np.arange(len(letters)) - np.repeat(begins, lengths)
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    mixed = _LETTERS.take(letters) if letters.max() < len(_LETTERS) else _mixed(letters)
    with np.errstate(over="ignore"):
        return (W.mix(np.add.reduceat(mixed * powers.take(offset), begins)) >> np.uint64(32)).astype(np.uint32)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, np.uint64(0x9E3779B97F4A7C15)))


def _mixed(letters: np.ndarray) -> np.ndarray:
    return W.mix(letters.astype(np.uint64) + np.uint64(1))


_POWERS, _LETTERS = _powers(64), _mixed(np.arange(1 << 14))  # those that most texts need


def least(found: np.ndarray) -> np.ndarray:
    found = np.sort(found)
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found[new][:SIZE]


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard index of two phrase sets by their least hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    twice = both[:-1] == both[1:]
    distinct = np.append(True, ~twice)
    union = both[distinct][:SIZE]
    common = both[:-1][twice]
    # Beyond the shorter horizon of two full signatures nothing is known.
    return float(np.count_nonzero(common <= union[-1]) / len(union))


class Parsed:
    """A text with its phrases, ready to be parsed again with another ending."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.known: set[str] = set()
        self.ends = parse(self.text, self.known)
        self.hashes = hashes(self.text, self.ends)
        self.signature = least(self.hashes)

    def with_ending(self, keep: int, ending: str) -> tuple[str, np.ndarray]:
        """The first `keep` characters and an ending: the text and its signature. Uses the parse up.

        Phrases that end within the kept part are those of the text itself; only the rest is parsed anew.
        """
        edited = self.text[:keep] + ending
        k = bisect_right(self.ends, keep)
        start = self.ends[k - 1] if k else 0
        text, rest = self.text, self.ends[k:]
        self.known.difference_update([text[a:b] for a, b in zip([start, *rest], rest)])
        ends = parse(edited, self.known, start)
        return edited, least(np.concatenate([self.hashes[:k], hashes(edited, ends, start)]))


def fingerprint(text: Column) -> Column:
    """Fingerprint (hexadecimal) of a text column."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([written(Parsed(t.as_py()).signature) for t in texts], pa.string())

    return F.arrow_udf(run, "string")(text)


def alike(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns, 0 to 1; null where one is null."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left.to_pylist(), right.to_pylist())
        return pa.array([None if x is None or y is None else likeness(read(x), read(y)) for x, y in pairs], pa.float64())

    return F.arrow_udf(run, "double")(a, b)


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows (id, text, bucket, guest) such that, within a bucket and sorted, each row is followed by the next.

    Ids are cut into ranges at approximate quantiles, and the first row of each range also stands, as a guest, at
    the end of the range before. Only the bounds and the first ids come to the driver; their number follows the
    shuffle partitions, not the rows.
    """
    spark = docs.sparkSession
    n = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / n for k in range(1, n)]
    bounds = docs.agg(F.percentile_approx("id", shares, 20 * n).alias("b")).first().b or []
    edges = np.unique(np.array(bounds, np.float64))

    def place(ids: pa.Array) -> pa.Array:
        at = np.searchsorted(edges, ids.cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False), "right")
        return pa.array(at.astype(np.int32))

    order = F.struct(F.col("id").isNotNull(), F.col("id"), F.xxhash64("text"))
    rows = docs.select("id", "text", F.arrow_udf(place, "int")("id").alias("bucket"), order.alias("order"))
    first = rows.groupBy("bucket").agg(F.min("order").alias("order"))
    found = sorted(first.collect(), key=lambda r: r.bucket)
    before = [(found[k - 1].bucket, r.bucket, r.order) for k, r in enumerate(found)]
    heads_type = T.StructType(
        [T.StructField("host", T.IntegerType()), T.StructField("bucket", T.IntegerType()), rows.schema["order"]]
    )
    heads = spark.createDataFrame(before, heads_type)
    # Bounded: one row for each range. Nulls in the order compare as equal.
    same = (rows["bucket"] == heads["bucket"]) & rows["order"].eqNullSafe(heads["order"])
    guests = rows.join(F.broadcast(heads), same).select("id", "text", heads["host"].alias("bucket"), rows["order"])
    guests = guests.dropDuplicates(["bucket"])
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    return both.repartition("bucket").sortWithinPartitions("bucket", "guest", "order")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited form and against the next text in order of a numeric id.

    The edited form has its last floor(n / 2) code points replaced by the first as many (or all) of the next text.
    The last text is followed by the first. Null ids come first; rows with one id are ordered by a hash of the text.
    Returns id, `n_chars`, `edited` (text), `fingerprint`, `edited_fingerprint`, `near_edited`, `near_next`.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    names = ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (bucket, id, parsed text) of a row whose next one is not known yet
        for batch in batches:
            ids, texts, buckets, guests = batch.columns
            out: list[tuple] = []
            for k in range(batch.num_rows):
                bucket, new = buckets[k].as_py(), Parsed(texts[k].as_py())
                if waiting and waiting[0] == bucket:
                    _, own_id, own = waiting
                    n = len(own.text)
                    edited, signature = own.with_ending(n - n // 2, new.text[: n // 2])
                    out.append(
                        (own_id, n, edited, written(own.signature), written(signature))
                        + (likeness(own.signature, signature), likeness(own.signature, new.signature))
                    )
                waiting = None if guests[k].as_py() else (bucket, ids[k].as_py(), new)
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t or ids.type) for c, t in zip(columns, kinds)], names=names
            )

    schema = f"id {id_type}, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    done = _with_next(rows).select("id", "text", "bucket", "guest").mapInArrow(run, schema)
    return done.withColumnRenamed("id", id_col)
