"""Language identification by a byte convolutional network, trained and run in numpy.

A text is cut into windows of ``WINDOW`` bytes that cover all of it. Each byte is embedded,
filters of several widths slide over the window, each filter's largest value goes through
a softmax layer. A text's probabilities are the mean over its windows, weighted by their
bytes. Training reads windows spread over whole texts of about ``PER_LANGUAGE`` documents
of each language.

Text that is null or has no letter is ``und`` with score 0; so is every text if there is
nothing to learn from. Repeated rows each get a row. A null id counts as held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm.common import (
    hash_sample,
    held_out,
    lean,
    packed,
    slabs,
    table,
    text_bytes,
    unpacked,
)

WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 3, 4), 16, 6
PER_LANGUAGE, WINDOWS_PER_TEXT = 400, 3
EPOCHS, BATCH, RATE = 6, 64, 0.01
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    training: bool = False

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list, np.ndarray]:
        """The largest value of each filter over each window, where it stood, the input."""
        x = self.embedding[windows]
        n, length, dim = x.shape
        best, places = [], []
        for width, weight, bias in zip(WIDTHS, self.filters, self.biases, strict=True):
            seen = np.lib.stride_tricks.sliding_window_view(
                x.reshape(n, length * dim), width * dim, axis=1
            )[:, ::dim]
            value = seen.reshape(-1, width * dim) @ weight
            value = value.reshape(n, length - width + 1, FILTERS)
            place = value.argmax(1) if self.training else None
            best.append(np.maximum(value.max(1) + bias, 0))
            places.append(place)
        return np.concatenate(best, 1), places, x

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(windows)[0] @ self.out + self.out_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(windows: np.ndarray, truth: np.ndarray, languages: list[str]) -> Network:
    """Adam on the cross entropy of windows."""
    rng = np.random.default_rng(7)
    scale = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    net = Network(
        languages,
        scale(256, DIM),
        [scale(w * DIM, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        scale(FILTERS * len(WIDTHS), len(languages)),
        np.zeros(len(languages), np.float32),
    )
    net.training = True
    params = [net.embedding, *net.filters, *net.biases, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(truth))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            b, y, n = windows[rows], truth[rows], len(rows)
            hidden, places, x = net.pooled(b)
            d = softmax(hidden @ net.out + net.out_bias)
            d[np.arange(n), y] -= 1
            d /= n
            d_hidden = (d @ net.out.T) * (hidden > 0)
            d_embedding = np.zeros_like(net.embedding)
            d_filters, d_biases = [], []
            for i, width in enumerate(WIDTHS):
                g = d_hidden[:, i * FILTERS : (i + 1) * FILTERS]
                at_byte = places[i][:, :, None] + np.arange(width)
                seen = x[np.arange(n)[:, None, None], at_byte].reshape(n, FILTERS, -1)
                d_filters.append(np.einsum("nf,nfk->kf", g, seen))
                d_biases.append(g.sum(0))
                back = (g[:, :, None] * net.filters[i].T[None]).reshape(n, FILTERS, width, DIM)
                np.add.at(d_embedding, b[np.arange(n)[:, None, None], at_byte], back)
            grads = [d_embedding, *d_filters, *d_biases, hidden.T @ d, d.sum(0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.training = False
    return net


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that cover all texts, the text of each window and its bytes within the text.

    The last window of a text starts so that it ends with the text; a text shorter than a
    window is filled up with zeros.
    """
    sizes = np.diff(offsets)
    count = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), count)
    index = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    weight = np.minimum(WINDOW, sizes[owner] - index * WINDOW)
    inside = np.maximum(np.minimum(index * WINDOW, sizes[owner] - WINDOW), 0)
    place = offsets[owner] + inside
    at = place[:, None] + np.arange(WINDOW)
    short = at >= offsets[owner + 1][:, None]
    padded = np.append(data, np.zeros(1, np.uint8))
    at[short] = len(data)
    return padded[at], owner, weight


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network from about ``per_language`` documents of each language that are not held out."""
    known = documents.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("doc_id", F.col("lang").alias("lang"), "text")
    # Rows are chosen before any text is read into Python. The counts that go to all tasks
    # are as many as the network has outputs.
    chosen = hash_sample(known, "doc_id", per_language, by="lang")

    @lean

    def windows_of(batches):
        for batch in batches:
            names = batch.column("lang")
            for row in range(batch.num_rows):
                data, offsets = text_bytes(batch.column("text").slice(row, 1))
                found, _, _ = cut(data, offsets)
                some = np.unique(np.linspace(0, len(found) - 1, WINDOWS_PER_TEXT).astype(int))
                for window in found[some] if len(found) else ():
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [names[row].as_py()], "window": [window.tobytes()]}
                    )

    rows = chosen.mapInArrow(windows_of, "lang string, window binary").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["lang", "window"])  # the order of rows does not matter then
    languages = sorted(rows["lang"].unique())
    windows = np.frombuffer(b"".join(map(bytes, rows["window"])), np.uint8).reshape(-1, WINDOW)
    return train(windows, rows["lang"].map(languages.index).to_numpy(), languages)


def _predict(texts: pa.Array, network: Network | None) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text of a batch."""
    n = len(texts)
    data, offsets = text_bytes(texts)
    scores = np.zeros((n, len(network.languages) if network else 1))
    for first, last, part, at in slabs(data, offsets) if network else ():
        scores[first:last] = _means(network, part, at)
    lettered = np.array([_has_letter(texts[k]) for k in range(n)], bool)
    known = lettered & (network is not None)
    names = np.array(network.languages if network else [UNKNOWN], object)
    return np.where(known, names[scores.argmax(1)], UNKNOWN), np.where(known, scores.max(1), 0.0)


def identify(documents: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""

    @lean

    def predict(batches):
        for batch in batches:
            names, scores = _predict(batch.column("text"), network)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "lang_pred": pa.array(names, pa.string()),
                    "score": pa.array(scores),
                }
            )

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return texts.mapInArrow(predict, schema)


def accepted(documents: DataFrame, network: Network | None) -> DataFrame:
    """The documents whose language is known; without a network, those with a letter."""

    @lean

    def keep(batches):
        for batch in batches:
            texts = batch.column("text")
            if network is None:
                known = np.array([_has_letter(t) for t in texts], bool)
            else:
                known = _predict(texts, network)[0] != UNKNOWN
            yield batch.filter(pa.array(known))

    rows = documents.select("text", packed(documents).alias("row"))
    return rows.mapInArrow(keep, rows.schema).select(*unpacked(documents, "row"))


def _has_letter(text: pa.Scalar) -> bool:
    return text.is_valid and any(map(str.isalpha, text.as_py()))


def _means(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities of each text; windows go through the network 256 at a time."""
    n = len(offsets) - 1
    total = np.zeros((n, len(network.languages)))
    windows, owner, weight = cut(data, offsets)
    for at in range(0, len(owner), 256):
        part = slice(at, at + 256)
        p = network.probabilities(windows[part]) * weight[part, None]
        np.add.at(total, owner[part], p)
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def op6_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return identify(documents, fit(documents))
