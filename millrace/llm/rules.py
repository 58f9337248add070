"""Quality rules as learned decision lists.

A rule is a conjunction of thresholds on text statistics ("share of repeated words at least 0.31 and words per line at
most 4"). Rules are found by sequential covering: on two thirds of the labelled sample a rule takes on the condition with
the most information gain until it covers no good text or nothing helps; on the remaining third its last conditions are cut
off again while that makes it more precise; a rule that stays imprecise ends the search; what an accepted rule covers is
taken out before the next rule is grown. The list is emitted as one ordered Spark conditional expression: the first rule
that holds decides, and no rule means "keep".

Fitting uses a bounded sample of labelled rows (`rows` of each label, the least by a hash of the id); every text is read
whole, long ones in pieces cut between words.

Defined results: null and empty texts have no words, and every count is 0. Shares of nothing are 0. Labels that are null or
whose id is null are not used; of several labels of one id the largest holds, and of several rows of one id the one with the
least statistics. Without labels of both kinds the list is empty and keeps everything. An empty table has no rows.
Statistics come as one struct, so columns of the same names do not clash.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import words as W
from .common import prepare

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_digits", "n_upper",
)
WINDOW = 5  # words in which repetition is looked for
SYMBOLS = b"#*$%&|<>"
PIECE = 1 << 20  # bytes of a text that are worked on at a time

ROWS = 4000  # labelled rows of each label
LONGEST_RULE, MOST_RULES, LEAST_COVER, LEAST_PRECISION = 4, 24, 5, 0.9

_BLANK = " \t\n\v\f\r"


def _classes() -> np.ndarray:
    """For each byte value: 1 for a symbol, 2 for a digit, 3 for a capital, else 0."""
    table = np.zeros(256, np.uint8)
    table[list(SYMBOLS)], table[0x30:0x3A], table[0x41:0x5B] = 1, 2, 3
    return table


_CLASS, _SPACE = _classes(), W.separators("space")


def _repeated(lines: list[str]) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    counted = Counter(lines)
    blank = sum(n for line, n in counted.items() if not line.strip(_BLANK))
    kinds = sum(1 for line in counted if line.strip(_BLANK)) if len(counted) < len(lines) else len(lines) - blank
    return len(lines) - blank, len(lines) - blank - kinds


def _among_texts(text: np.ndarray, hashed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text: its distinct words, and its words in windows that it holds twice or more."""
    own = W.joined(hashed, W.mix(text.astype(np.uint64)))
    kinds = np.unique(own, return_index=True)[1]
    distinct = np.bincount(text[kinds], minlength=n)
    window = W.windows(hashed, WINDOW)
    if not len(window):
        return distinct, np.zeros(n, np.int64)
    whole = np.flatnonzero(text[: len(window)] == text[WINDOW - 1 :])
    window = W.joined(window[whole], W.mix(text[whole].astype(np.uint64)))
    order = np.argsort(window)
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    inside = W.covered(whole[twice], WINDOW, len(hashed))
    return distinct, np.bincount(text[inside], minlength=n)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _simple(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of bounded length: counts of words, characters and kinds of bytes; (text, hash) of each word."""
    found = W.find(texts)
    data, bounds = W.flat(texts)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lengths = np.append(0, np.cumsum(chars[found.end] - chars[found.start]))
    kind = _CLASS[data]
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    out[:, 0] = np.diff(found.first)
    out[:, 1] = lengths[found.first[1:]] - lengths[found.first[:-1]]
    for column, k in ((2, 1), (7, 2), (8, 3)):
        out[:, column] = _sums(kind == k, bounds)
    return out, found.text_of(), found.hash


def _pieces(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """Parts of a long text, each ending between words, and whether a part is one word longer than a piece."""
    view, begin = np.frombuffer(data, np.uint8), 0
    gaps = np.flatnonzero(_SPACE[view])
    while begin < len(data):
        if len(data) - begin <= PIECE:
            yield data[begin:], False
            return
        k = np.searchsorted(gaps, begin + PIECE, side="right")
        if k and gaps[k - 1] >= begin:
            cut, alone = int(gaps[k - 1]) + 1, False
        else:
            cut, alone = int(gaps[k]) + 1 if k < len(gaps) else len(data), True
        yield data[begin:cut], alone
        begin = cut


def _long(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Counts of one long text, and the hashes of its words."""
    out, hashes = np.zeros(len(COUNTS), np.int64), []
    for part, alone in _pieces(data):
        if alone:
            word = part.strip(_BLANK.encode())
            view = np.frombuffer(part, np.uint8)
            kinds = np.bincount(_CLASS[view], minlength=4)
            out[[0, 1, 2, 7, 8]] += [1, np.count_nonzero((view & 0xC0) != 0x80) - (len(part) - len(word)), *kinds[1:]]
            hashes.append(np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64))
        else:
            got, _, hashed = _simple(pa.array([part], pa.binary()).cast(pa.string()))
            out += got[0]
            hashes.append(hashed)
    return out, np.concatenate(hashes)


def counts(texts: pa.Array) -> np.ndarray:
    """`COUNTS` of each text."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    for begin, end in W.slices(texts, PIECE):
        part = texts.slice(begin, end - begin)
        data, bounds = W.flat(part)
        if bounds[-1] > PIECE:
            got, hashed = _long(data.tobytes())
            got, text = got[None, :], np.zeros(len(hashed), np.int64)
        else:
            got, text, hashed = _simple(part)
        out[begin:end] = got
        out[begin:end, 6], out[begin:end, 4] = _among_texts(text, hashed, end - begin)
        for i, value in enumerate(part, begin):
            out[i, 5], out[i, 3] = _repeated((value.as_py() or "").split("\n"))
    return out


def statistics(text: Column) -> Column:
    """Struct of `COUNTS` of a text."""

    def run(texts: pa.Array) -> pa.Array:
        got = counts(texts)
        return pa.StructArray.from_arrays([pa.array(got[:, k]) for k in range(len(COUNTS))], list(COUNTS))

    return F.arrow_udf(run, ", ".join(f"{name} bigint" for name in COUNTS))(text.cast("string"))


def base_failed(stats: Column) -> Column:
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def features(stats: Column) -> dict[str, Column]:
    """What rules may ask about, by name."""
    s = {name: stats[name] for name in COUNTS}
    return {
        "words": s["n_words"].cast("double"),
        "chars_per_word": _share(s["word_chars"], s["n_words"]),
        "symbol_share": _share(s["n_symbols"], s["word_chars"]),
        "repeated_line_share": _share(s["n_dup_lines"], s["n_lines"]),
        "repeated_word_share": _share(s["n_repeat_words"], s["n_words"]),
        "words_per_line": _share(s["n_words"], s["n_lines"]),
        "distinct_word_share": _share(s["n_distinct"], s["n_words"]),
        "digit_share": _share(s["n_digits"], s["word_chars"]),
        "capital_share": _share(s["n_upper"], s["word_chars"]),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
        value = x[:, names.index(self.feature)]
        return value >= self.threshold if self.at_least else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold!r}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    dropped: int  # bad texts of the sample that it decided
    wrong: int  # good ones

    def holds(self, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(x, names) for c in self.conditions])


@dataclass
class DecisionList:
    """Ordered rules; each rejects what it covers."""

    rules: list[Rule] = field(default_factory=list)

    def decided_by(self, asked: dict[str, Column]) -> Column:
        """Number of the first rule that holds, from 1; 0 where none does."""
        out = F.lit(0)
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            holds = F.lit(True)
            for c in rule.conditions:
                holds = holds & (asked[c.feature] >= c.threshold if c.at_least else asked[c.feature] <= c.threshold)
            out = F.when(holds, number).otherwise(out)
        return out

    def __str__(self) -> str:
        lines = [
            f"WHEN {' AND '.join(map(str, r.conditions))} THEN reject  -- {r.dropped} bad, {r.wrong} good" for r in self.rules
        ]
        return "\n".join(["CASE", *lines, "ELSE keep END"])


def _best(x: np.ndarray, bad: np.ndarray, names: Sequence[str]) -> tuple[float, Condition | None]:
    """The condition with the most information gain over the rows given (bad ones are to be covered)."""
    n_bad, n = int(bad.sum()), len(bad)
    best: tuple[float, Condition | None] = (0.0, None)
    before = np.log2(n_bad / n)
    for k, name in enumerate(names):
        order = np.argsort(x[:, k], kind="stable")
        value, hit = x[order, k], bad[order]
        cut = np.flatnonzero(value[1:] > value[:-1])  # a threshold after each of these
        if not len(cut):
            continue
        low = np.cumsum(hit)[cut]
        size = cut + 1
        middle = (value[cut] + value[cut + 1]) / 2
        for at_least, p, t in ((False, low, size), (True, n_bad - low, n - size)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / t) - before), 0.0)
            top = int(np.argmax(gain))
            if gain[top] > best[0] + 1e-9:
                best = (float(gain[top]), Condition(name, at_least, float(middle[top])))
    return best


def _grown(x: np.ndarray, bad: np.ndarray, names: Sequence[str]) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < LONGEST_RULE and bad.any() and not bad.all():
        gain, condition = _best(x, bad, names)
        if condition is None:
            break
        rule.append(condition)
        inside = condition.holds(x, names)
        x, bad = x[inside], bad[inside]
    return rule


def _pruned(rule: list[Condition], x: np.ndarray, bad: np.ndarray, names: Sequence[str]) -> list[Condition]:
    """The beginning of the rule that is most precise on rows it was not grown on; the shortest of equals."""
    best, kept = -2.0, rule
    for length in range(1, len(rule) + 1):
        inside = Rule(tuple(rule[:length]), 0, 0).holds(x, names)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best:
            best, kept = worth, rule[:length]
    return kept


def cover(x: np.ndarray, bad: np.ndarray, third: np.ndarray, names: Sequence[str]) -> DecisionList:
    """Sequential covering. `third`: rows to prune on; the others are to grow on."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MOST_RULES and (bad & left & ~third).sum() >= LEAST_COVER:
        rule = _grown(x[left & ~third], bad[left & ~third], names)
        if not rule:
            break
        rule = _pruned(rule, x[left & third], bad[left & third], names)
        inside = Rule(tuple(rule), 0, 0).holds(x, names) & left
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        unseen, clean = int((inside & bad & third).sum()), int((inside & ~bad & third).sum())
        precise = min(p - LEAST_PRECISION * (p + n), unseen - LEAST_PRECISION * (unseen + clean)) >= 0
        if p < LEAST_COVER or not unseen or not precise:
            break
        rules.append(Rule(tuple(rule), p, n))
        left &= ~inside
    return DecisionList(rules)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = ROWS,
) -> DecisionList:
    """Learn what sets texts of label 0 apart, among those that do not fail the base rules anyway."""
    spark = prepare(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    order = F.xxhash64(F.col("id").cast("string"))
    ids = [(r.id, y) for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(order, "id").limit(rows).collect()]
    if not ids:
        return DecisionList()
    # Bounded: at most `rows` ids of each label. Copies of an id become one row before anything is collected.
    sample = spark.createDataFrame(ids, known.schema)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    chosen = chosen.select("id", "y", statistics(F.col("text")).alias("stats"))
    chosen = chosen.groupBy("id", "y").agg(F.min("stats").alias("stats")).where(~base_failed(F.col("stats")))
    asked = features(F.col("stats"))
    third = F.pmod(F.xxhash64(F.lit("prune"), F.col("id").cast("string")), F.lit(3)) == 0
    got = chosen.select("id", "y", third.alias("third"), *(c.alias(name) for name, c in asked.items())).orderBy("id").collect()
    bad = np.array([r.y == 0 for r in got], bool)
    if not len(got) or bad.all() or not bad.any():
        return DecisionList()
    x = np.array([[r[name] for name in asked] for r in got], np.float64)
    return cover(x, bad, np.array([r.third for r in got], bool), list(asked))
