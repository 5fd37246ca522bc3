"""Quality rules: gradient-boosted trees over document statistics, trained in numpy.

Statistics of whole texts are counted in numpy over Arrow batches. The trees are flattened
into node arrays and scored level by level for all documents of a batch. Chosen features
are monotonic: a higher share of symbols, repeated lines or repeated words never raises
the verdict. The trees learn ``labels.quality`` on about ``SAMPLE`` labelled documents.

Null text has no words. Labels without a document and documents without a label do not
count in training; a document labelled twice has its lower label. Without any label of both kinds the verdict
is "keep". Repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm import rolling
from busgrid.llm.common import hash_sample, slabs, table, text_bytes

SAMPLE = 20_000
TREES, DEPTH, RATE, BINS, LEAST = 60, 4, 0.2, 64, 20
WINDOW = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
    "digit_share", "mark_share", "line_words", "distinct_share",
)
#: -1: a higher value never raises the verdict.
MONOTONIC = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1}

_SYMBOL, _UPPER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[list(b"!?.,;:()[]{}\"'/\\=+@_^~`-")] = True


def _count(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _later_copies(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each owner how many keys equal an earlier one of the same owner."""
    own = np.bincount(owner, minlength=n)
    tagged = np.unique(rolling.mix(keys ^ rolling.mix(owner.astype(rolling.U))), return_index=True)
    return own - np.bincount(owner[tagged[1]], minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (columns as BASE) and features (as FEATURES) of each text."""
    n = len(offsets) - 1
    starts, ends, first = rolling.words(data, offsets)
    owner = np.repeat(np.arange(n), np.diff(first))
    hashes = rolling.piece_hashes(data, starts, ends)
    white = rolling.WHITE[data]
    n_words = np.diff(first)
    word_chars = _count(~white & ((data & 0xC0) != 0x80), offsets)
    n_symbols = _count(_SYMBOL[data], offsets)

    newline = data == 10
    line_start = np.zeros(len(data) + 1, bool)
    line_start[1:][newline] = True
    line_start[offsets[:-1]] = True
    at = np.flatnonzero(line_start[:-1]) if len(data) else np.zeros(0, np.int64)
    stop = np.append(at[1:], len(data))
    stop = stop - ((stop > at) & newline[np.maximum(stop, 1) - 1]) if len(at) else stop
    worded = _count(~white, np.append(at, len(data))) > 0 if len(at) else np.zeros(0, bool)
    at, stop = at[worded], stop[worded]
    line_owner = np.searchsorted(offsets, at, side="right") - 1
    n_lines = np.bincount(line_owner, minlength=n)
    n_dup_lines = _later_copies(rolling.piece_hashes(data, at, stop), line_owner, n)

    grams = rolling.windows(hashes, WINDOW)
    covered = np.zeros(len(hashes), bool)
    if len(grams):
        whole = owner[: len(grams)] == owner[WINDOW - 1 :]
        place = np.flatnonzero(whole)
        keys = rolling.mix(grams[place] ^ rolling.mix(owner[place].astype(rolling.U)))
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = place[counts[inverse] > 1]
        step = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(step, again, 1)
        np.add.at(step, again + WINDOW, -1)
        covered = np.cumsum(step[:-1]) > 0
    n_repeat = np.bincount(owner[covered], minlength=n)

    base = np.stack([n_words, word_chars, n_symbols, n_dup_lines, n_repeat], 1).astype(np.int64)
    some, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    again = _later_copies(hashes, owner, n)
    features = np.stack(
        [
            np.log1p(n_words),
            word_chars / some,
            n_symbols / chars,
            n_dup_lines / np.maximum(n_lines, 1),
            n_repeat / some,
            _count(_UPPER[data], offsets) / chars,
            _count(_DIGIT[data], offsets) / chars,
            _count(_MARK[data], offsets) / chars,
            n_words / np.maximum(n_lines, 1),
            1 - again / some,
        ],
        1,
    )
    return base, features


@dataclass
class Trees:
    """All nodes of all trees in arrays; a leaf points to itself."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                low = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def train(x: np.ndarray, y: np.ndarray, signs: np.ndarray) -> Trees:
    """Trees of logistic loss over quantile bins.

    A split on a signed feature is refused if its sides would stand the wrong way round,
    and both sides are kept on their side of the middle from then on, so that the whole
    tree is monotonic.
    """
    empty = np.zeros(0, np.int64)
    share = np.clip(y.mean() if len(y) else 1.0, 1e-4, 1 - 1e-4)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(start, empty, empty, empty.astype(float), empty, empty, empty.astype(float))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        k = len(feature)
        feature.append(0), cut.append(np.inf), left.append(k), right.append(k), value.append(0.0)
        return k

    margin = np.full(len(y), start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        root = node()
        roots.append(root)
        work = [(root, np.arange(len(y)), -np.inf, np.inf, 0)]
        while work:
            k, rows, low, high, depth = work.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[k] = RATE * float(np.clip(g / (h + 1), low, high))
            best = None
            for f in range(x.shape[1]) if depth < DEPTH and len(rows) >= 2 * LEAST else ():
                b, size = bins[rows, f], len(cuts[f]) + 1
                gl = np.cumsum(np.bincount(b, grad[rows], size))[:-1]
                hl = np.cumsum(np.bincount(b, hess[rows], size))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=size))[:-1]
                vl, vr = np.clip(gl / (hl + 1), low, high), np.clip(
                    (g - gl) / (h - hl + 1), low, high
                )
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                bad = (nl < LEAST) | (len(rows) - nl < LEAST) | (signs[f] * (vr - vl) < 0)
                gain[bad] = -1
                if len(gain) and gain.max() > 1e-3 and (best is None or gain.max() > best[0]):
                    i = int(gain.argmax())
                    best = (gain[i], f, i, (vl[i] + vr[i]) / 2)
            if best is None:
                margin[rows] += value[k]
                continue
            _, f, i, middle = best
            feature[k], cut[k], left[k], right[k] = f, cuts[f][i], node(), node()
            goes = bins[rows, f] <= i
            up = (middle, high) if signs[f] < 0 else (low, middle)
            down = (low, middle) if signs[f] < 0 else (middle, high)
            lo, hi = (up, down) if signs[f] else ((low, high), (low, high))
            work.append((left[k], rows[goes], *lo, depth + 1))
            work.append((right[k], rows[~goes], *hi, depth + 1))
    return Trees(
        start, np.array(roots), np.array(feature), np.array(cut), np.array(left),
        np.array(right), np.array(value),
    )


def _rows(batches: Iterator[pa.RecordBatch], extra) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last, part, at in slabs(data, offsets):
            base, features = statistics(part, at)
            columns = {"doc_id": batch.column("doc_id").slice(first, last - first)}
            columns |= {name: pa.array(base[:, i]) for i, name in enumerate(BASE)}
            columns |= extra(base, features)
            yield pa.RecordBatch.from_pydict(columns)


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees trained on about ``sample`` labelled documents."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
    )
    chosen = F.broadcast(hash_sample(known, "doc_id", sample))  # about ``sample`` rows of two numbers
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(chosen, "doc_id").select("quality", "doc_id", "text")
    names = [f"f_{name}" for name in FEATURES]

    def features_of(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last, part, at in slabs(data, offsets):
                _, features = statistics(part, at)
                columns = {"quality": batch.column("quality").slice(first, last - first)}
                columns |= {name: pa.array(features[:, i]) for i, name in enumerate(names)}
                yield pa.RecordBatch.from_pydict(columns)

    schema = "quality int, " + ", ".join(f"{name} double" for name in names)
    found = texts.mapInArrow(features_of, schema).toPandas()
    found = found.sort_values(names + ["quality"])  # the order of rows does not matter then
    signs = np.array([MONOTONIC.get(name, 0) for name in FEATURES])
    return train(found[names].to_numpy(float), found["quality"].to_numpy(float), signs)


def judge(documents: DataFrame, trees: Trees) -> DataFrame:
    """Base counts, base_failed, score and kept of each document."""

    def score(batches):
        def extra(base, features):
            failed = (base[:, 0] < 20) | (100 * base[:, 4] > 30 * base[:, 0])
            scores = trees.score(features)
            return {
                "base_failed": pa.array(failed),
                "kept": pa.array(~failed & (scores >= 0.5)),
                "score": pa.array(scores),
            }

        yield from _rows(batches, extra)

    counts = ", ".join(f"{name} long" for name in BASE)
    schema = f"doc_id long, {counts}, base_failed boolean, kept boolean, score double"
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(score, schema)


def op10_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return judge(documents, fit(documents, table(spark, sf_dir, "labels")))
