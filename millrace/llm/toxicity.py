"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

The kernel of two words sums, over all subsequences of three letters they share, a weight that decays with the
stretch each takes up in its word (normalised, so a word meets itself at 1). Letters may be left out between
or put in, so "idi-ot", "id1ot" and "idioot" stay close to "idiot"; separators inside a word are dropped, and
letters spelled out one by one are read as one word.

Landmarks are words that set toxic training documents apart, with some common words beside them. Each word of the sample is
tested against chance by its likelihood ratio; of the words tested, those are taken among which a share of `FALSE_SHARE` at most
is expected to be there by chance. How clear a word must be thus follows from the sample. The three-letter
subsequences of all landmarks form a small vocabulary; the kernel values of a word are a product over it. A
document, whose sentences share its label, is described by its best match with each landmark (matches below
`FLOOR` count as 0), once as it is and once to the power `SHARP`, which is again a kernel and tells a word from
its near relatives. The Nystroem map turns these values into coordinates in which the kernel is a dot product, and a linear
support vector machine with squared hinge loss separates them. Its margin is turned into a probability.

Fitting uses a bounded sample of labelled rows (`rows` of each label, the least by a hash of the id); nothing
else is sampled: every text is read whole. What a worker remembers of words is bounded in bytes.

Defined results: null and empty texts have no words and get the score of "no match". Where the sample lacks one
of the labels, every score is the share of label 1 in it (0 without any label). Labels that are null or whose id
is null are not used; of several labels of one id the largest holds, and of several rows of one id
the text with the least hash is learnt from. An empty table has no scores. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import words as W
from .common import forget, kept_by_worker, prepare, stored

DECAY, FLOOR, SHARP, LONGEST = 0.6, 0.5, 8, 20
ROWS, LANDMARKS, COMMON = 4000, 160, 8
PENALTIES = (1e-4, 3e-4, 1e-3, 3e-3, 1e-2)  # tried on the sample itself
FAR_BYTES, NEAR_BYTES = 24 << 20, 48 << 20  # what a worker remembers of words without a match, and of words with one
FALSE_SHARE, LEAST_TEXTS = 0.05, 3  # of landmarks that may be there by chance; texts a word must stand in to be tested

_PARTS = re.compile(r"[^\W_]+")
_SYMBOLS = 64


def _letters(o: np.ndarray) -> np.ndarray:
    """Code points as numbers below 64: a-z, 0-9, and the others dealt over what is left."""
    o = o.astype(np.int32)
    letter, digit = (o >= 97) & (o <= 122), (o >= 48) & (o <= 57)
    return np.where(letter, o - 97, np.where(digit, o - 22, 36 + o * 7 % 28))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _codes(words: list[str]) -> np.ndarray:
    """Letters of words of one length."""
    return _letters(_points("".join(words))).reshape(len(words), -1)


def forms(token: str) -> list[str]:
    """The spellings of a token to compare: its letters and digits as one word, and each part.

    What is longer than `LONGEST` is cut into overlapping pieces.
    """
    if token.isalnum() and len(token) <= LONGEST:
        return [token.lower()] if len(token) >= 3 else []
    parts = _PARTS.findall(token.lower())
    whole = "".join(parts)
    found = {whole, *parts} if len(parts) > 1 else {whole}
    out = []
    for word in found:
        if len(word) <= LONGEST:
            if len(word) >= 3:
                out.append(word)
        else:
            step = LONGEST // 2
            out += [word[k : k + LONGEST] for k in range(0, len(word) - step, step)]
    return out


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(length), 3)))
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1).astype(np.float64)


def _subsequences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words of one length: the three-letter subsequences as numbers, and their weights."""
    at, weight = _triples(codes.shape[1])
    return (codes[:, at[:, 0]] * _SYMBOLS + codes[:, at[:, 1]]) * _SYMBOLS + codes[:, at[:, 2]], weight


def self_kernel(codes: np.ndarray) -> np.ndarray:
    """Kernel of each word with itself; words of one length."""
    n, length = codes.shape
    same = (codes[:, :, None] == codes[:, None, :]) * DECAY**2
    level = same
    for _ in range(2):
        total = np.zeros((n, length + 1, length + 1))
        for i in range(length):
            for j in range(length):
                total[:, i + 1, j + 1] = (
                    level[:, i, j] + DECAY * (total[:, i, j + 1] + total[:, i + 1, j]) - DECAY**2 * total[:, i, j]
                )
        level = same * total[:, :-1, :-1]
    return level.sum(axis=(1, 2))


@dataclass
class Landmarks:
    """Landmark words and the product form of their kernel values."""

    words: list[str]

    def __post_init__(self):
        self.slot = np.full(_SYMBOLS**3, -1, np.int32)
        columns: dict[int, np.ndarray] = {}
        for k, word in enumerate(self.words):
            codes = _codes([word])
            found, weight = _subsequences(codes)
            scale = 1 / np.sqrt(self_kernel(codes)[0])
            for u, w in zip(found[0].tolist(), weight):
                columns.setdefault(u, np.zeros(len(self.words)))[k] += w * scale
        for i, u in enumerate(columns):
            self.slot[u] = i
        self.matrix = np.array([*columns.values()], np.float32).reshape(len(columns), len(self.words))
        self.most = np.append(self.matrix.max(axis=1, initial=0), 0)  # the last one is for what no landmark has
        self.groups = self._alike()
        self.group_most = np.stack([self.matrix[:, g].max(axis=1) for g in self.groups], axis=1) if self.words else self.matrix

    def _alike(self) -> list[np.ndarray]:
        """Landmarks by likeness: each joins the first group whose first one it is near."""
        groups: list[list[int]] = []
        for k, word in enumerate(self.words):
            codes = _codes([word])
            found, weight = _subsequences(codes)
            near = weight @ self.matrix[self.slot[found[0]]] / np.sqrt(self_kernel(codes)[0])
            home = next((g for g in groups if near[g[0]] >= FLOOR), None)
            groups.append([k]) if home is None else home.append(k)
        return [np.array(g) for g in groups]

    def values(self, found: list[str]) -> np.ndarray:
        """Normalised kernel of each word with each landmark; below `FLOOR` it is 0."""
        out = np.zeros((len(found), len(self.words)), np.float32)
        lengths = np.array([len(w) for w in found])
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            near, value = self.near(_codes([found[r] for r in rows]))
            out[rows[near]] = value
        return out

    def near(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words (of one length) a landmark is near, and their kernel values."""
        none = np.zeros((0, len(self.words)), np.float32)
        if not self.words or codes.shape[1] < 3:
            return np.zeros(0, np.int64), none
        places, weight = _triples(codes.shape[1])
        step = max(1, 400_000 // len(places))
        rows, values = [np.zeros(0, np.int64)], [none]
        for begin in range(0, len(codes), step):
            part = codes[begin : begin + step]
            slots = self.slot[_subsequences(part)[0]]
            # An upper bound: every subsequence at its largest weight in any landmark.
            bound = self.most[slots] @ weight
            near = np.flatnonzero(bound >= FLOOR * np.sqrt((weight**2).sum()))
            norm = np.sqrt(self_kernel(part[near]))
            close = bound[near] >= FLOOR * norm
            near, norm = near[close], norm[close]
            for at in range(0, len(near), 400):
                value = self._exact(slots[near[at : at + 400]], weight.astype(np.float32), norm[at : at + 400])
                some = value.any(axis=1)
                rows.append(begin + near[at : at + 400][some])
                values.append(value[some])
        return np.concatenate(rows), np.concatenate(values)


    def _exact(self, slots: np.ndarray, weight: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Kernel values of some words; only groups of landmarks whose bound a word reaches are worked out for it."""
        row, col = np.nonzero(slots >= 0)
        slot, weight = slots[row, col], weight[col, None]
        reach = np.add.reduceat(self.group_most[slot] * weight, np.searchsorted(row, np.arange(len(slots))))
        reach /= norm[:, None]
        good = reach >= FLOOR - 1e-5
        out = np.zeros((len(slots), len(self.words)), np.float32)
        for g in np.flatnonzero(good.any(axis=0)):
            columns, rows = self.groups[g], np.flatnonzero(good[:, g])
            if len(columns) == 1:  # the bound is the value
                out[rows, columns[0]] = reach[rows, g]
                continue
            own = good[row, g]
            share = self.matrix[slot[own][:, None], columns] * weight[own]
            out[rows[:, None], columns] = np.add.reduceat(share, np.searchsorted(row[own], rows)) / norm[rows, None]
        out[out < FLOOR] = 0
        return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
    """Distinct tokens of a batch (hash, and bytes or where they are), and (token, text) of every occurrence."""
    found = W.find(texts)
    text = found.text_of()
    size = found.end - found.start
    hashes, owner = [found.hash], [text]
    # Letters spelled out: runs of at least three tokens of one letter are one more token.
    extra = []
    if len(size):
        single = (size == 1) | ((size == 2) & (found.data[found.start] >= 0xC0))
        edge = np.diff(np.concatenate([[0], single.astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for a, b in zip(begins[ends - begins >= 3].tolist(), ends[ends - begins >= 3].tolist()):
            for t in np.unique(text[a:b]):
                run = np.arange(a, b)[text[a:b] == t]
                if len(run) >= 3:
                    extra.append((b"".join(found.data[found.start[i] : found.end[i]].tobytes() for i in run), int(t)))
    if extra:
        spelled = W.find(pa.array([raw for raw, _ in extra], pa.binary()).cast(pa.string()))
        hashes.append(spelled.hash)
        owner.append(np.array([t for _, t in extra]))
    distinct, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    n = len(found.hash)

    def spellings(chosen: np.ndarray) -> list[bytes]:
        data = found.data.tobytes()
        at = first[chosen].tolist()
        return [data[found.start[k] : found.end[k]] if k < n else extra[k - n][0] for k in at]

    return distinct, spellings, inverse, np.concatenate(owner)


def spelled_forms(texts: pa.Array) -> pa.Array:
    """The distinct spellings of each text's tokens, a slice of the batch after the other."""
    parts = [pa.array([], pa.list_(pa.string()))]
    for begin, end in W.slices(texts):
        out: list[set[str]] = [set() for _ in range(end - begin)]
        distinct, spellings, token, owner = tokens(texts.slice(begin, end - begin))
        found = [forms(t.decode("utf-8", "replace")) for t in spellings(np.arange(len(distinct)))]
        for t, o in zip(token.tolist(), owner.tolist()):
            out[o].update(found[t])
        parts.append(pa.array([sorted(s) for s in out], pa.list_(pa.string())))
    return pa.concat_arrays(parts)


def _separates(o: np.ndarray) -> np.ndarray:
    """Code points that are neither letters nor digits; beyond ASCII, those of the punctuation blocks."""
    plain = ((o >= 97) & (o <= 122)) | ((o >= 48) & (o <= 57)) | ((o >= 65) & (o <= 90))
    signs = (o >= 0x80) & (o < 0xC0) | (o >= 0x2000) & (o < 0x2070) | (o >= 0x3000) & (o < 0x3040)
    return ~plain & ((o < 0x80) | signs)


class Matcher:
    """Best matches of texts with landmarks; remembers the words it has seen, up to a bounded number."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.far: list[np.ndarray] = []  # words that match nothing: ascending runs, each over twice as long as the next
        self.near: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # landmarks that a word matches, and how well
        self.near_bytes = 0

    def is_far(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), bool)
        for run in self.far:
            out |= _among(hashes, run)
        return out

    def _remember(self, far: np.ndarray) -> None:
        if sum(run.nbytes for run in self.far) > FAR_BYTES:
            self.far = []
        far = np.sort(far)
        while self.far and len(self.far[-1]) <= 2 * len(far):
            far = np.sort(np.concatenate([self.far.pop(), far]), kind="stable")
        self.far.append(far)

    def learn(self, hashes: np.ndarray, tokens: list[bytes]) -> None:
        """Match words that have not been seen. Most are letters with signs at the ends only: these go by length."""
        best: dict[int, np.ndarray] = {}

        def note(rows: np.ndarray, values: np.ndarray) -> None:
            for r, value in zip(rows.tolist(), values):
                best[r] = np.maximum(best[r], value) if r in best else value

        joined = b" ".join(tokens).decode("utf-8", "replace").lower()
        points = np.append(_points(joined), np.uint32(32))
        ends = np.flatnonzero(points == 32)
        begins = np.append(0, ends[:-1] + 1)
        keep = ~_separates(points)
        keep[ends] = False
        edge = np.diff(keep.astype(np.int8), prepend=0)
        run_begin, run_end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        run_of = np.searchsorted(ends, run_begin)
        runs = np.bincount(run_of, minlength=len(ends))
        simple = (runs[run_of] == 1) & (run_end - run_begin <= LONGEST)
        lengths = np.where(simple, run_end - run_begin, 0)
        codes = _letters(points)
        for length in np.unique(lengths[lengths >= 3]):
            which = np.flatnonzero(lengths == length)
            rows, values = self.landmarks.near(codes[run_begin[which][:, None] + np.arange(length)])
            note(run_of[which[rows]], values)
        odd = np.unique(run_of[~simple])
        flat = [(f, i) for i in odd.tolist() for f in forms(joined[begins[i] : ends[i]])]
        if flat:
            values = self.landmarks.values([f for f, _ in flat])
            alive = np.flatnonzero(values.any(axis=1))
            note(np.array([i for _, i in flat])[alive], values[alive])
        alive = np.zeros(len(hashes), bool)
        alive[list(best)] = True
        self._remember(hashes[~alive])
        if self.near_bytes > NEAR_BYTES:
            self.near, self.near_bytes = {}, 0
        for r, value in best.items():
            columns = np.flatnonzero(value)
            self.near[int(hashes[r])] = columns.astype(np.int16), value[columns]
            self.near_bytes += 320 + 6 * len(columns)

    def matches(self, texts: pa.Array) -> np.ndarray:
        """Best match of each text with each landmark."""
        best = np.zeros((len(texts), len(self.landmarks.words)), np.float32)
        for begin, end in W.slices(texts):
            distinct, spellings, token, owner = tokens(texts.slice(begin, end - begin))
            if not len(distinct):
                continue
            far = self.is_far(distinct)
            rest = np.flatnonzero(~far)
            unknown = [i for i in rest.tolist() if int(distinct[i]) not in self.near]
            if unknown:
                self.learn(distinct[unknown], spellings(np.array(unknown)))
            rows = [i for i in rest.tolist() if int(distinct[i]) in self.near]
            if not rows:
                continue
            slot = np.full(len(distinct), -1)
            slot[rows] = np.arange(len(rows))
            value = np.zeros((len(rows), len(self.landmarks.words)), np.float32)
            for k, i in enumerate(rows):
                columns, found = self.near[int(distinct[i])]
                value[k, columns] = found
            used = np.flatnonzero(slot[token] >= 0)
            pairs = np.unique(slot[token[used]] * len(texts) + owner[used])
            np.maximum.at(best, pairs % len(texts) + begin, value[pairs // len(texts)])
        return best


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def matcher(words: list[str]) -> Matcher:
    """The matcher of these landmarks in this worker process, so that all its tasks share what it knows."""
    return kept_by_worker(("matcher", *words), lambda: Matcher(Landmarks(words)))


@dataclass
class Model:
    """A fitted model; `score` is a column function."""

    landmarks: list[str]
    weights: list[float]  # on the landmark values, with the Nystroem map worked in
    bias: float
    slope: float
    shift: float

    def probabilities(self, best: np.ndarray) -> np.ndarray:
        margin = _sharpened(best) @ np.array(self.weights, np.float64) + self.bias if self.landmarks else self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin + np.zeros(len(best))) + self.shift, -30, 30)))

    def score(self, text: Column) -> Column:
        """Probability of label 1, between 0 and 1."""

        def run(texts: pa.Array) -> pa.Array:
            return pa.array(self.probabilities(matcher(self.landmarks).matches(texts)), pa.float64())

        return F.arrow_udf(run, "double")(text)


def _svm(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps; y is -1 or 1."""
    design = np.hstack([x, np.ones((len(x), 1))])
    ridge = penalty * np.eye(design.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(design.shape[1])
    active = np.ones(len(y), bool)
    for _ in range(50):
        part = design[active]
        w = np.linalg.solve(ridge + part.T @ part / len(y), part.T @ y[active] / len(y))
        before, active = active, y * (design @ w) < 1
        if (before == active).all() or not active.any():
            break
    return w[:-1], float(w[-1])


def _penalty(x: np.ndarray, y: np.ndarray, folds: int = 5) -> float:
    """The penalty of `PENALTIES` whose margins, calibrated on the other folds, predict a left-out fold best."""
    fold, losses = np.arange(len(y)) % folds, dict.fromkeys(PENALTIES, 0.0)
    for k in range(folds):
        own, rest = fold == k, fold != k
        if not own.any() or abs(y[rest].sum()) == rest.sum():
            continue
        for penalty in PENALTIES:
            weights, bias = _svm(x[rest], y[rest], penalty)
            slope, shift = _calibrate(x[rest] @ weights + bias, y[rest])
            losses[penalty] += np.logaddexp(0, -y[own] * (slope * (x[own] @ weights + bias) + shift)).sum()
    return min(PENALTIES, key=losses.get)


def _sharpened(best: np.ndarray) -> np.ndarray:
    return np.hstack([best, best**SHARP])


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from margins to probabilities, by Newton steps."""
    target = np.where(y > 0, (np.sum(y > 0) + 1) / (np.sum(y > 0) + 2), 1 / (np.sum(y < 0) + 2))
    design = np.stack([margin, np.ones_like(margin)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, design.T @ (p - target))
        theta = theta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def held_out(id_col: Column) -> Column:
    """Rows that fitting never sees: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = ROWS,
    landmarks: int = LANDMARKS,
) -> Model:
    """Fit on at most `rows` labelled documents of each label that are not held out."""
    spark = prepare(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    order = F.xxhash64(F.col("id").cast("string"))
    # The same ids are found again in the documents by a broadcast: their number is bounded by `rows`.
    ids = [
        (r.id, y) for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(order, "id").limit(rows).collect()
    ]
    positive = sum(y for _, y in ids)
    share = positive / len(ids) if ids else 0.0
    constant = Model([], [], 0.0, 1.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    if share in (0.0, 1.0):
        return constant
    sample = spark.createDataFrame(ids, known.schema)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")
    # One text of each id, whatever the number of its rows; read again from here on.
    least = F.min_by("text", F.xxhash64(F.coalesce("text", F.lit(""))))
    chosen = stored(chosen.groupBy("id", "y").agg(least.alias("text")), "toxic-sample")

    def spelled(texts: pa.Array) -> pa.Array:
        forget()
        return spelled_forms(texts)

    counts = chosen.select("y", F.explode(F.arrow_udf(spelled, "array<string>")("text")).alias("word"))
    counts = counts.groupBy("word").agg(F.sum("y").alias("hot"), F.sum(1 - F.col("y")).alias("cold"))
    counts = stored(counts, "toxic-words")
    n_hot, n_cold = float(positive), float(len(ids) - positive)
    common = F.col("hot") + F.col("cold")
    # Likelihood ratio of "as frequent in both".
    even_hot, even_cold = common * (n_hot / (n_hot + n_cold)), common * (n_cold / (n_hot + n_cold))
    telling = 2 * (F.col("hot") * F.log(F.greatest("hot", F.lit(1)) / even_hot)
                   + F.col("cold") * F.log(F.greatest("cold", F.lit(1)) / even_cold))
    tested = counts.where(common >= LEAST_TEXTS)
    ranked = tested.where(F.col("hot") > even_hot).select("word", telling.alias("ratio"))
    best = ranked.orderBy(F.col("ratio").desc(), "word").limit(landmarks).collect()
    words = [r.word for r in best[: _beyond_chance([r.ratio for r in best], tested.count())]]
    words += [r.word for r in counts.orderBy(common.desc(), "word").limit(COMMON).collect() if r.word not in words]
    if not words:
        return constant

    def described(texts: pa.Array) -> pa.Array:
        return pa.array(list(matcher(words).matches(texts)), pa.list_(pa.float32()))

    got = chosen.select("id", "y", F.arrow_udf(described, "array<float>")("text").alias("x")).collect()
    got = sorted(got, key=lambda r: str(r.id))
    x = np.array([r.x for r in got]).reshape(len(got), len(words))
    y = np.array([1.0 if r.y else -1.0 for r in got])
    if len(got) == 0 or abs(y.sum()) == len(y):
        return constant
    gram = Landmarks(words).values(words).astype(np.float64)
    gram = (gram + gram.T) / 2
    n = len(words)
    root = np.zeros((2 * n, 2 * n))
    root[:n, :n], root[n:, n:] = _inverse_root(gram), _inverse_root(gram**SHARP)
    coordinates = _sharpened(x) @ root
    weights, bias = _svm(coordinates, y, _penalty(coordinates, y))
    slope, shift = _calibrate(coordinates @ weights + bias, y)
    return Model(words, (root @ weights).tolist(), bias, slope, shift)


def _beyond_chance(ratios: list[float], tested: int) -> int:
    """How many of the greatest likelihood ratios to take so that `FALSE_SHARE` of them at most is expected by chance.

    The step-up rule for the false discovery rate: the last rank k whose chance is at most k / tested times that share.
    """
    chance = [0.5 * math.erfc(math.sqrt(max(r, 0.0) / 2)) for r in ratios]
    return max((k for k, p in enumerate(chance, 1) if p <= FALSE_SHARE * k / tested), default=0)


def _inverse_root(gram: np.ndarray) -> np.ndarray:
    value, vector = np.linalg.eigh(gram + 1e-2 * np.eye(len(gram)))
    return (vector / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
