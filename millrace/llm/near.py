"""Near-duplicate documents by Order MinHash and banded alignment.

A text is a sequence of k-word shingles; the r-th occurrence of a shingle in its text is labelled r, so that
all labelled shingles differ. For each of `sketches` random orders, the `picks` least labelled shingles are
taken and put back into text order; their hash is one Order MinHash value. Two texts agree in a value with
about the chance J^picks that the same shingles come out least, and only if they stand in the same order, so
the values follow edit similarity rather than common content. With the defaults a pair of long texts at similarity
0.8 is missed with a chance of about 2e-6. Of few shingles the least are drawn without replacement, and the chance
is higher: 4 shingles and the same with one more at an end agree in a value only if that one is the largest of
five, so the pair is missed with a chance of 0.8^24 = 0.5 %.

Texts with a value in common are compared by alignment: with n and m shingles and a longest common
subsequence of L, the similarity is L / (n + m - L) - the Jaccard index of the shingles, counted in order. For a
threshold t this allows (n + m)(1 - t)/(1 + t) shingles outside the alignment, which bounds how far it can leave
the diagonal; the alignment looks at this band alone and is exact for the decision.

Not all pairs of a bucket are compared. First each member meets a few pivots of its bucket, chosen anew in each
bucket; links make components. Then only members of one bucket that are still in different components meet,
and only if their lengths and shingle histograms (kept as parity bits) allow the threshold. So no link that joins different
components is lost, and a group of thousands of copies costs a few comparisons for each copy.

Equal texts are one node throughout. Counts and minima are pre-aggregated before they are joined, so a bucket
may hold any share of all rows.

Defined results: every row keeps its row; a null text counts as empty, texts without words are linked to
equal texts only; a text of fewer words than a shingle is one shingle. `class_id` is the least non-null id
of a class (null if there is none). Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import words as W
from .common import content_key, forget, fresh, prepare, stored
from .components import components

SKETCHES, PICKS, PIVOTS, CELLS = 24, 4, 4, 1024
PARITY = [f"parity_{k}" for k in range(CELLS // 64)]
NODE = ["key_a", "key_b"]


def shingles(hashed: np.ndarray, size: int) -> np.ndarray:
    """Shingle hashes of one text; a shorter text is one shingle, a text without words has none."""
    if len(hashed) == 0:
        return hashed
    return W.windows(hashed, min(size, len(hashed)))


def labelled(found: np.ndarray) -> np.ndarray:
    """Shingles with the number of the occurrence worked in."""
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    fresh = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]) != 0)
    run = np.arange(len(found)) - np.repeat(fresh, np.diff(np.append(fresh, len(found))))
    label = np.empty(len(found), np.uint64)
    label[order] = run.astype(np.uint64)
    return W.joined(found, label)


def sketch(found: np.ndarray, orders: np.ndarray, picks: int) -> np.ndarray:
    """Order MinHash values of one text."""
    items = labelled(found)
    picks = min(picks, len(items))
    with np.errstate(over="ignore"):
        keys = (items[None, :] ^ orders[:, :1]) * orders[:, 1:]
    keys ^= keys >> np.uint64(32)
    if len(items) > 4 * picks:
        least = np.argpartition(keys, picks - 1, axis=1)[:, :picks]
    else:
        least = np.argsort(keys, axis=1, kind="stable")[:, :picks]
    chosen = items[np.sort(least, axis=1)]
    out = W.mix(np.arange(1, len(orders) + 1, dtype=np.uint64))
    for k in range(picks):
        out = W.joined(out, chosen[:, k])
    return out


def histogram(found: np.ndarray) -> np.ndarray:
    """Shingles by cell of their hash. What two histograms differ by lies outside any alignment."""
    return np.bincount((found >> np.uint64(40)).astype(np.int64) % CELLS, minlength=CELLS)


def parity(found: np.ndarray) -> np.ndarray:
    """Whether each cell of the histogram is odd, as bits. Two histograms differ by at least the bits that do."""
    return np.packbits((histogram(found) & 1).astype(np.uint8)).view(np.int64)


def banded_lcs(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence among the cells at most `band` off the diagonal; bit-parallel."""
    if len(a) < len(b):
        a, b = b, a
    m = len(b)
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b.tolist()):
        where.setdefault(x, []).append(j)
    low, width = 0, min(m, band + 1)  # the window of columns: low to low + width - 1
    state, total = (1 << width) - 1, 0
    for i, x in enumerate(a.tolist()):
        top = min(m, i + band + 1)
        if top > low + width:
            state |= ((1 << (top - low - width)) - 1) << width
            width = top - low
        while low < i - band and width:
            total += ~state & 1
            state >>= 1
            low, width = low + 1, width - 1
        if width == 0:
            break
        matches = 0
        for j in where.get(x, ()):
            if low <= j < low + width:
                matches |= 1 << (j - low)
        hit = state & matches
        state = ((state + hit) | (state - hit)) & ((1 << width) - 1)
    return total + width - state.bit_count()


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the aligned similarity of two shingle sequences reaches the threshold."""
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return False
    need = threshold * total / (1 + threshold) - 1e-9  # shingles that must be aligned
    if min(len(a), len(b)) < need:
        return False
    apart = np.abs(histogram(a) - histogram(b)).sum()
    if (total - apart) / 2 < need:
        return False
    # Equal ends are always part of a best alignment.
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    head = int(differs[0]) if len(differs) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1]) if n else differs[:0]
    tail = int(differs[0]) if len(differs) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    same = head + tail
    if same >= need:
        return True
    if same + min(len(a), len(b)) < need:
        return False
    return same + banded_lcs(a, b, int(total - 2 * need)) >= need


def _sketched(rows: DataFrame, size: int, sketches: int, picks: int) -> DataFrame:
    """Per row its node, number of shingles, Order MinHash values and histogram parities."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        orders = np.stack([W.seeds(sketches, 11), W.seeds(sketches, 12) | np.uint64(1)], axis=1)
        for batch in batches:
            for begin, end in W.slices(batch.column(0)):
                found = W.find(batch.column(0).slice(begin, end - begin))
                n, odd, values = [], [], []
                for first, last in zip(found.first[:-1], found.first[1:]):
                    one = shingles(found.hash[first:last], size)
                    n.append(len(one))
                    odd.append(parity(one))
                    values.append(sketch(one, orders, picks).view(np.int64) if len(one) else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(begin, end - begin),
                        batch.column(2).slice(begin, end - begin),
                        pa.array(n, pa.int64()),
                        pa.array(values, pa.list_(pa.int64())),
                        *(pa.array(column) for column in np.array(odd, np.int64).reshape(-1, len(PARITY)).T.copy()),
                    ],
                    names=[*NODE, "n", "sketch", *PARITY],
                )

    return rows.select("text", *NODE).mapInArrow(
        emit, f"key_a bigint, key_b int, n bigint, sketch array<bigint>, {', '.join(f'{c} bigint' for c in PARITY)}"
    )


def _verified(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (u, v) of nodes whose texts are similar."""

    def decide(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for k in range(len(left)):
            a, b = (shingles(W.find(x.slice(k, 1)).hash, size) for x in (left, right))
            out.append(similar(a, b, threshold))
        return pa.array(out, pa.bool_())

    alike = F.arrow_udf(decide, "boolean")
    by = lambda c: [F.col(f"{c}.key_a").alias("key_a"), F.col(f"{c}.key_b").alias("key_b")]
    first = pairs.select("u", "v", *by("u")).join(texts, NODE).select("u", "v", F.col("text").alias("left"))
    both = first.select("u", "v", "left", *by("v")).join(texts, NODE)
    return both.where(alike("left", "text")).select("u", "v")


def _possible(a: str, b: str, threshold: float) -> Column:
    """What every similar pair meets: lengths, and how far the histograms may differ."""
    total = F.col(f"{a}.n") + F.col(f"{b}.n")
    need = total * (threshold / (1 + threshold)) - 1e-6
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in PARITY), F.lit(0))
    return (F.least(f"{a}.n", f"{b}.n") >= need) & (differ <= total - 2 * need)


def classes(
    docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, sketches: int, picks: int
) -> DataFrame:
    """Stored table with a row for each distinct text: key, `class_id`, `class_rows`, `heads`.

    `heads` counts the rows of the class that carry its id.
    """
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(*content_key(text), F.col(id_col).alias("id"), text.alias("text"))
    node = F.struct(*NODE).alias("node")

    nodes = _sketched(rows, size, sketches, picks).groupBy(*NODE).agg(
        *(F.first(c).alias(c) for c in ("n", "sketch", *PARITY))
    )
    nodes = stored(nodes.select(node, "n", "sketch", *PARITY), "order-minhash")
    facts = nodes.select("node", "n", *PARITY)
    members = nodes.select("node", F.explode("sketch").alias("bucket"))
    # Pivots of a bucket: least by orders that differ from bucket to bucket.
    order = lambda k: F.xxhash64("bucket", "node", F.lit(k))
    pivots = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"),
        *(F.min(F.struct(order(k).alias("o"), F.col("node"))).alias(f"p{k}") for k in range(PIVOTS)),
    )
    chosen = F.array(*(F.col(f"p{k}.node") for k in range(PIVOTS)))
    shared = members.join(pivots.where("size > 1").select("bucket", chosen.alias("pivots")), "bucket")
    shared = stored(shared, "buckets")
    stars = shared.select(F.col("node").alias("a"), F.explode("pivots").alias("b")).where("a <> b")
    stars = stars.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    stars = stars.join(facts.select(F.struct("*").alias("a")), F.col("u") == F.col("a.node"))
    stars = stars.join(facts.select(F.struct("*").alias("b")), F.col("v") == F.col("b.node"))
    stars = stored(stars.where(_possible("a", "b", threshold)).select("u", "v"), "pairs")

    # Only texts that meet another are moved; they are stored once, one row for each text.
    wanted = shared.select("node.*").distinct()
    texts = rows.join(wanted, NODE, "left_semi").groupBy(*NODE).agg(F.first("text").alias("text"))
    texts = stored(texts, "candidates")
    links = stored(_verified(stars, texts, size, threshold), "links")
    parts = stored(components(links), "components")

    # Members of one bucket in different components.
    placed = shared.select("bucket", "node").join(parts, "node", "left")
    placed = placed.select("bucket", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    left = placed.join(mixed, "bucket", "left_semi").join(nodes.select("node", "n", "sketch", *PARITY), "node")
    left = stored(left, "mixed")
    apart = (F.col("a.root") != F.col("b.root")) & (F.col("a.node") < F.col("b.node"))
    # A pair meets in every bucket the two share; it is taken in the least one.
    here = F.col("a.bucket") == F.array_min(F.array_intersect("a.sketch", "b.sketch"))
    rest = left.alias("a").join(
        left.alias("b"), (F.col("a.bucket") == F.col("b.bucket")) & apart & _possible("a", "b", threshold) & here
    )
    rest = rest.select(F.col("a.node").alias("u"), F.col("b.node").alias("v"), F.col("a.root").alias("ru"), F.col("b.root").alias("rv"))
    rest = rest.distinct().join(stars, ["u", "v"], "left_anti")
    more = _verified(rest.select("u", "v"), texts, size, threshold)
    more = more.join(parts.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u", "left")
    more = more.join(parts.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v", "left")
    again = components(more.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
    again = again.select(F.col("node").alias("root"), F.col("root").alias("top"))

    owned = rows.groupBy(*NODE, "id").agg(F.count(F.lit(1)).alias("copies"))
    owned = owned.select(node, "id", "copies").join(parts, "node", "left")
    owned = owned.select("node", "id", "copies", F.coalesce("root", "node").alias("root")).join(again, "root", "left")
    owned = stored(owned.select("node", "id", "copies", F.coalesce("top", "root").alias("root")), "owned")
    per_class = owned.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("copies").alias("class_rows"))
    owned = owned.join(per_class, "root")
    heads = owned.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(F.sum("copies").alias("heads"))
    owned = owned.select("node", "root", "class_id", "class_rows").distinct().join(heads, "root")
    return stored(owned.select("node.*", "root", "class_id", "class_rows", "heads"), "classes")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    sketches: int = SKETCHES,
    picks: int = PICKS,
) -> DataFrame:
    """One row per document: id, `class_id`, `class_rows` (rows in the class), `keep` (its id is the class's)."""
    found = classes(docs, id_col, text_col, size, threshold, sketches, picks)
    rows = docs.select(*content_key(F.col(text_col).cast("string")), F.col(id_col).alias("id")).join(found, NODE)
    keep = F.col("id").eqNullSafe(F.col("class_id"))
    return rows.select(F.col("id").alias(id_col), "class_id", "class_rows", keep.alias("keep"))


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    sketches: int = SKETCHES,
    picks: int = PICKS,
) -> DataFrame:
    """The documents, whole rows, with one of each class: that with the class's id (any of several such)."""
    found = classes(docs, id_col, text_col, size, threshold, sketches, picks)
    names = {c: fresh(c) for c in (*NODE, "root", "class_id", "heads")}
    found = found.select(*(F.col(c).alias(n) for c, n in names.items()))
    keys = [k.alias(names[c]) for k, c in zip(content_key(F.col(text_col).cast("string")), NODE)]
    rows = docs.select("*", *keys).join(found, [names[c] for c in NODE])
    rows = rows.where(F.col(id_col).eqNullSafe(F.col(names["class_id"])))
    several = F.col(names["heads"]) > 1
    one = rows.where(~several).unionAll(rows.where(several).dropDuplicates([names["root"]]))
    return one.select(*docs.columns)
