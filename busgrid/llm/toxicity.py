"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The examples are a sample of about ``SAMPLE`` labelled documents. All their words count,
with document frequencies over all documents; a word that no example has counts in the
norm of a text as one that a single document has. The cosine of a text and each example is
exact (``Texts``); its best neighbours are returned as evidence.

The score mixes two votes of neighbours. The first is among the nearest whole texts. In
long texts few words decide, so the second is among the nearest by those words whose
presence goes with the label (G² of at least ``ASSOCIATION``; near copies, which share the
least hash of their word triples, count once there): these examples stand in an inverted
index whose lists are cut into blocks with the largest weight of each, and blocks are
searched in the order of their bounds until the bound falls below the k-th best
similarity. Whole texts have hundreds of words each, whose bounds skip next to nothing:
their index has a block for each kind of text (``Texts``). Each whole text votes by a power
of its similarity and as far as it agrees in those words; the vote by them counts as much
as some copies (``COPIES``, two at least, so that one label, which may be a slip, does not
decide alone). Power and number of copies are learned from examples that were left out of
their own search.

A text without any such term (null, empty, or of other words) has the share of toxic ones
among examples without a term as its second vote. A document labelled more than once is
toxic if one label says so. Without labels of both kinds the second vote is the smoothed
share of toxic ones. Repeated rows each get a row; ties in similarity go to the smaller
document id.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm import rolling
from busgrid.llm.common import hash_sample, held_out, slabs, table, text_bytes

SAMPLE, TERMS, ASSOCIATION = 20_000, 4096, 25.0
NEIGHBOURS, BLOCK, EVIDENCE, CALIBRATE = 15, 128, 3, 3000
#: Words of one in so many examples tell the kinds of texts; so many texts are compared at a time.
OFTEN, KINDS, TEXTS = 16, 8, 128
#: Long lists become so many rows of a matrix at a time.
ROWS = 256
#: Blocks that are searched at a time, in the order of their bounds.
TOGETHER = 8
SHARPNESS, COPIES = (4, 16, 64), (2, 4, 8)
_ENTRY = np.dtype([("column", np.int32), ("weight", np.float32)])
_BETWEEN = np.ones(256, bool)
_BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False


def _slices(starts: np.ndarray, stops: np.ndarray) -> tuple[list[slice], np.ndarray]:
    """Slices to be copied one after the other, and their sizes."""
    return list(map(slice, starts.tolist(), stops.tolist())), stops - starts


def _words(data, offsets):
    """Hash, place and text number of each run of letters, without regard to ASCII case."""
    starts, ends, first = rolling.words(data, offsets, _BETWEEN)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return rolling.piece_hashes(data, starts, ends, rolling.LOWER), starts, ends, owner


class Places:
    """Finds hashes among sorted ones: the leading bits give the place from which to look."""

    def __init__(self, words: np.ndarray):
        bits = max(1, int(len(words) * 2).bit_length())
        self.words, self.shift = words, rolling.U(64 - bits)
        edges = np.arange(1 << bits, dtype=rolling.U) << self.shift
        self.first = np.searchsorted(words, edges).astype(np.int32)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        found = np.full(len(hashes), -1)
        if not len(self.words):
            return found
        at = self.first[(hashes >> self.shift).astype(np.intp)].astype(np.intp)
        left = np.arange(len(hashes))
        while len(left):
            here = np.minimum(at, len(self.words) - 1)
            there = self.words[here]
            same = there == hashes[left]
            found[left[same]] = here[same]
            on = (there < hashes[left]) & (at < len(self.words))
            left, at = left[on], at[on] + 1
        return found


def _term_counts(places: Places, data, offsets):
    """(text, term, count) of the terms found in the texts, ordered by text and term."""
    hashes, _, _, owner = _words(data, offsets)
    n, at = max(len(places.words), 1), places(hashes)
    hit = at >= 0
    pairs, counts = np.unique(owner[hit] * n + at[hit], return_counts=True)
    return pairs // n, pairs % n, counts


def _word_counts(places: Places, data, offsets):
    """(text, word, count) as for terms, and the sum of squares of each text's other words."""
    hashes, _, _, owner = _words(data, offsets)
    n, words, at = len(offsets) - 1, places.words, places(hashes)
    hit = at >= 0
    pairs, counts = np.unique(owner[hit] * max(len(words), 1) + at[hit], return_counts=True)
    tagged = rolling.mix(hashes[~hit] ^ rolling.mix(owner[~hit].astype(rolling.U)))
    _, first, times = np.unique(tagged, return_index=True, return_counts=True)
    rest = np.bincount(owner[~hit][first], (1 + np.log(times)) ** 2, minlength=n)
    return pairs // max(len(words), 1), pairs % max(len(words), 1), counts, rest


@dataclass
class Texts:
    """Unit vectors of whole examples; words are sorted hashes, examples ordered by id.

    An inverted index of them, to choose examples, has a block for each kind of text: kinds
    are groups of examples that share frequent words, as those of one language do, so a list
    has most of its entries in few blocks. Texts are compared some at a time, like ones
    together. A block's lists that are long for the number of texts with the word are
    multiplied as a matrix, the others are added up entry by entry, and an empty list of a
    block costs nothing. Kinds decide about time alone.
    """

    words: np.ndarray
    idf: np.ndarray
    other: float  # idf of a word that no example has
    ids: np.ndarray
    toxic: np.ndarray
    edges: np.ndarray  # of each example's words
    word: np.ndarray
    count: np.ndarray
    deciding: np.ndarray  # whether a word's presence goes with the label
    kind: np.ndarray | None = None  # of each example
    often: np.ndarray | None = None  # frequent words
    leaning: np.ndarray | None = None  # of each frequent word, and of none, to each kind
    weight: np.ndarray = field(init=False)  # of each example's words
    places: Places = field(init=False)
    part: np.ndarray = field(init=False)  # of each example's square that deciding words have
    order: np.ndarray = field(init=False)  # the example of each column; columns go by kind
    column: np.ndarray = field(init=False)
    bounds: np.ndarray = field(init=False)  # of the columns of each kind
    first: np.ndarray = field(init=False)  # of the list of each word and kind
    entry: np.ndarray = field(init=False)  # a column and the weight there
    row: np.ndarray = field(init=False)  # of each word in ``leaning``
    matrix: np.ndarray = field(init=False)  # room for rows of some texts' words,
    product: np.ndarray = field(init=False)  # and for what they give
    here: np.ndarray = field(init=False)  # the words of the text in hand
    asked: np.ndarray = field(init=False)  # and their weights
    sharpness: float = 16.0
    copies: float = 4.0

    def __reduce__(self):
        """What the rest is worked out from, packed: tasks get it."""
        most = int(self.count.max()) if len(self.count) else 0
        packed = {
            "words": self.words, "idf": self.idf, "ids": self.ids, "toxic": self.toxic, "edges": self.edges,
            "word": self.word, "count": self.count.astype(np.min_scalar_type(most)),
            "deciding": self.deciding, "kind": self.kind, "often": self.often, "leaning": self.leaning.ravel(),
        }
        state = {k: (str(v.dtype), zlib.compress(v.tobytes(), 1)) for k, v in packed.items()}
        rest = {"other": self.other, "sharpness": self.sharpness, "copies": self.copies}
        digest = hashlib.sha256(repr(rest).encode())
        for _, data in state.values():
            digest.update(data)
        return _unpacked, (digest.hexdigest(), state, rest)

    def __post_init__(self):
        n, n_words = len(self.ids), len(self.words)
        owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.edges))
        weight = 1 + np.log(self.count)
        weight *= self.idf[self.word]
        norm = np.sqrt(np.bincount(owner, weight**2, minlength=n))
        weight /= norm[owner]
        self.weight = weight
        decides = self.deciding[self.word]
        self.part = np.bincount(owner[decides], weight[decides] ** 2, minlength=n)
        self.places, self.asked, self.here = Places(self.words), np.empty(n_words), np.zeros(n_words, bool)
        if self.kind is None:
            self._find_kinds(owner)
        self.row = np.full(n_words, len(self.often), np.int32)
        self.row[self.often] = np.arange(len(self.often))
        self.order = np.argsort(self.kind, kind="stable")
        self.column = np.empty(n, np.int32)
        self.column[self.order] = np.arange(n)
        self.bounds = np.searchsorted(self.kind[self.order], np.arange(KINDS + 1))
        widest = int(np.diff(self.bounds).max())
        self.matrix = np.empty(ROWS * widest, np.float32)
        self.product = np.empty(TEXTS * widest, np.float32)
        key = self.word.astype(np.int64) * KINDS + self.kind[owner]
        self.first = np.append(0, np.cumsum(np.bincount(key, minlength=n_words * KINDS)))
        by_list = np.argsort(key)
        del key
        entry = np.empty(len(by_list), _ENTRY)
        entry["weight"] = weight[by_list]
        entry["column"] = self.column[owner[by_list]]
        self.entry = entry.view(np.int64)  # numbers are copied faster than records

    def _find_kinds(self, owner):
        """Groups of examples around ``KINDS`` centres, by the cosine over frequent words."""
        n = len(self.ids)
        lists = np.bincount(self.word, minlength=len(self.words))
        self.often = np.flatnonzero(lists > max(n // OFTEN, TEXTS))
        row = np.full(len(self.words), -1)
        row[self.often] = np.arange(len(self.often))
        dense = row[self.word] >= 0
        matrix = np.zeros((n, len(self.often)), np.float32)
        matrix[owner[dense], row[self.word[dense]]] = self.weight[dense]
        size = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
        matrix /= np.maximum(size, 1e-12)[:, None]
        centres = np.zeros((KINDS, len(self.often)), np.float32)
        nearest = np.where(size > 0, 0.0, 2.0)
        for kind in range(KINDS if len(self.often) else 0):  # each far from those before it
            centres[kind] = matrix[nearest.argmin()]
            nearest = np.maximum(nearest, matrix @ centres[kind])
        for _ in range(8):
            self.kind = (matrix @ centres.T).argmax(axis=1).astype(np.int8)
            for kind in range(KINDS):
                total = matrix[self.kind == kind].sum(axis=0)
                centres[kind] = total / max(np.sqrt((total**2).sum()), 1e-12)
        self.leaning = np.append(centres.T, np.zeros((1, KINDS), np.float32), axis=0)

    def near(self, queries: list[tuple[np.ndarray, np.ndarray, float]], k: int, skip=None) -> list:
        """The k most similar examples of each (words, counts, rest), best first.

        With them come the similarities and those of the deciding words alone, which are 1
        where neither text has any.

        Sums in single precision choose examples with a margin; those are compared exactly.
        """
        weights, kinds, found = [], np.zeros(len(queries), np.int64), [None] * len(queries)
        for i, (words, counts, rest) in enumerate(queries):
            weight = (1 + np.log(counts)) * self.idf[words]
            weights.append(weight / max(np.sqrt((weight**2).sum() + rest * self.other**2), 1e-300))
            kinds[i] = (weight @ self.leaning[self.row[words]]).argmax()
        like = np.argsort(kinds, kind="stable")
        for start in range(0, len(like), TEXTS):
            part = like[start : start + TEXTS]
            total = self._totals([(queries[i][0], weights[i]) for i in part])
            for i, row in zip(part, total, strict=True):
                own = -1 if skip is None else skip[i]
                found[i] = self._best(queries[i][0], weights[i], row, k, own)
        return found

    def _totals(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Similarities of some texts (words, weights) and all columns, in single precision."""
        total = np.zeros((len(texts), len(self.ids)), np.float32)
        edges = np.cumsum([0, *[len(words) for words, _ in texts]])
        if not edges[-1]:
            return total
        text = np.repeat(np.arange(len(texts)), np.diff(edges))
        weight = np.concatenate([w for _, w in texts]).astype(np.float32)
        words, at, times = np.unique(
            np.concatenate([w for w, _ in texts]), return_inverse=True, return_counts=True
        )
        starts = self.first[words[:, None] * KINDS + np.arange(KINDS)]
        stops = self.first[words[:, None] * KINDS + np.arange(1, KINDS + 1)]
        size = stops - starts
        # A row costs about as much as adding up as many entries as the block has columns.
        long = times[:, None] * size > np.diff(self.bounds)
        for kind in range(KINDS):
            low, high = self.bounds[kind : kind + 2]
            rows = np.flatnonzero(long[:, kind])
            for one in range(0, len(rows), ROWS):
                some = rows[one : one + ROWS]
                lists, sizes = _slices(starts[some, kind], stops[some, kind])
                entry = np.concatenate([self.entry[s] for s in lists]).view(_ENTRY)
                matrix = self.matrix[: len(some) * (high - low)]
                matrix.fill(0)
                matrix[np.repeat(np.arange(len(some)) * (high - low) - low, sizes) + entry["column"]] = entry["weight"]
                row = np.full(len(words), -1)
                row[some] = np.arange(len(some))
                here = np.flatnonzero(row[at] >= 0)
                left = np.zeros((len(texts), len(some)), np.float32)
                left[text[here], row[at[here]]] = weight[here]
                product = self.product[: len(texts) * (high - low)].reshape(len(texts), -1)
                total[:, low:high] += np.matmul(left, matrix.reshape(len(some), -1), out=product)
        # The others: neighbouring blocks of a word are one stretch of entries.
        short = np.pad(~long, ((0, 0), (1, 1)))
        begin, end = short[:, 1:-1] & ~short[:, :-2], short[:, 1:-1] & ~short[:, 2:]
        word, begin, end = np.nonzero(begin)[0], starts[begin], stops[end]
        full = begin < end
        word, begin, end = word[full], begin[full], end[full]
        by_word = np.searchsorted(word, np.arange(len(words) + 1))
        many = np.diff(by_word)[at]
        of = np.repeat(np.arange(len(at)), many)
        stretch = np.arange(len(of)) + np.repeat(by_word[at] - np.cumsum(many) + many, many)
        lists, sizes = _slices(begin[stretch], end[stretch])
        weight, edges = weight[of], np.searchsorted(of, edges)
        for i, mine in enumerate(map(slice, edges[:-1], edges[1:])):
            if mine.start < mine.stop:
                entry = np.concatenate([self.entry[s] for s in lists[mine]]).view(_ENTRY)
                more = entry["weight"] * np.repeat(weight[mine], sizes[mine])
                np.add.at(total[i], entry["column"].astype(np.intp), more)
        return total

    def _best(self, words, weights, total, k, skip):
        if 0 <= skip:
            total[self.column[skip]] = 0
        least = np.partition(total, len(total) - k)[-k] if len(total) > k else 0.0
        # Each word's addition is off by 2^-24 at most, here and in ``least``.
        margin = max(1e-4, (len(words) + 4) * 2.0**-23)
        some = self.order[np.flatnonzero((total > 0) & (total >= least - margin))]
        if not len(some):
            return some, np.zeros(0), np.zeros(0)
        # Those are compared exactly, by all their words.
        decides = self.deciding[words]
        theirs, size = _slices(self.edges[some], self.edges[some + 1])
        word = np.concatenate([self.word[s] for s in theirs])
        self.here[words], self.asked[words] = True, weights
        hit = np.flatnonzero(self.here[word])
        self.here[words] = False
        word = word[hit]
        products = np.concatenate([self.weight[s] for s in theirs])[hit] * self.asked[word]
        of = np.repeat(np.arange(len(some)), size)[hit]
        sims = np.minimum(np.bincount(of, products, minlength=len(some)), 1.0)
        common = np.bincount(of, products * self.deciding[word], minlength=len(some))
        their_part = self.part[some]
        both = np.sqrt(their_part * (weights[decides] ** 2).sum())
        neither = (their_part == 0) & (not decides.any())
        agree = np.where(neither, 1.0, common / np.maximum(both, 1e-300))
        best = np.lexsort((self.ids[some], -np.round(sims, 12)))[:k]
        return some[best], sims[best], agree[best]

    def mixed(self, value: float, found, sims, agree, sharpness=None, copies=None) -> float:
        """The value by terms, which counts as some copies, and the votes of whole texts."""
        near = sims ** (sharpness or self.sharpness) * agree
        copies = copies or self.copies
        return float(((near * self.toxic[found]).sum() + copies * value) / (near.sum() + copies))


_IN_HAND: dict[str, Texts] = {}


def _unpacked(digest: str, state: dict, rest: dict) -> Texts:
    """Packed texts; a worker keeps those of its last task."""
    if digest not in _IN_HAND:
        _IN_HAND.clear()
        given = {k: np.frombuffer(zlib.decompress(data), kind) for k, (kind, data) in state.items()}
        given["count"], given["leaning"] = given["count"].astype(np.int32), given["leaning"].reshape(-1, KINDS)
        _IN_HAND[digest] = Texts(**given, **rest)
    return _IN_HAND[digest]


@dataclass
class Index:
    """Blocked inverted lists over unit vectors of examples; terms are sorted hashes."""

    terms: np.ndarray
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    first: np.ndarray  # of each term's blocks
    block: np.ndarray  # number of each block that has the term
    most: np.ndarray  # its largest weight
    posting: np.ndarray  # its first posting
    example: np.ndarray
    weight: np.ndarray
    n_blocks: int
    without_terms: float
    calibration: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))
    place: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of a given example, or -1

    def value(self, terms, counts, skip: int = -1) -> float:
        """The score of a text by its terms."""
        if not len(terms):
            return self.without_terms
        found, sims = self.search(terms, self.vector(terms, counts), NEIGHBOURS, skip)
        if not len(found):
            return self.without_terms
        return self.score(self.evidence(found, sims, terms, counts))

    def weights(self, terms, counts):
        return (1 + np.log(counts)) * self.idf[terms]

    def vector(self, terms, counts):
        weights = self.weights(terms, counts)
        return weights / np.sqrt((weights**2).sum())

    def search(self, terms, weights, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k most similar examples and their similarities, exact, best first."""
        found, sims = np.zeros(0, np.int64), np.zeros(0)
        lists, size = _slices(self.first[terms], self.first[terms + 1])
        if not lists:
            return found, sims
        entry = np.concatenate([np.arange(s.start, s.stop) for s in lists])
        weight, block = np.repeat(weights, size), self.block[entry]
        bound = np.bincount(block, weight * self.most[entry], minlength=self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        rank = np.zeros(self.n_blocks, np.int64)
        rank[order] = np.arange(len(order))
        by_rank = np.argsort(rank[block], kind="stable")
        entry, weight, rank = entry[by_rank], weight[by_rank], rank[block][by_rank]
        for at in range(0, len(order), TOGETHER):
            if len(sims) == k and bound[order[at]] < sims[-1]:
                break
            some = slice(*np.searchsorted(rank, [at, at + TOGETHER]))
            parts, size = _slices(self.posting[entry[some]], self.posting[entry[some] + 1])
            value = np.concatenate([self.weight[s] for s in parts]) * np.repeat(weight[some], size)
            here, number = np.unique(
                np.concatenate([self.example[s] for s in parts]), return_inverse=True
            )
            total = np.bincount(number, value)
            keep = (total > (sims[-1] - 1e-15 if len(sims) == k else 0)) & (here != skip)
            found, sims = np.append(found, here[keep]), np.append(sims, total[keep])
            best = np.lexsort((self.ids[found], -sims))[:k]
            found, sims = found[best], sims[best]
        return found, sims

    def evidence(self, found, sims, terms, counts) -> np.ndarray:
        """The vote, weighted by similarity, and how much the text says at all."""
        vote = np.clip((sims * self.toxic[found]).sum() / sims.sum(), 0.01, 0.99)
        return np.array(
            [np.log(vote / (1 - vote)), np.log(self.weights(terms, counts).sum()), 1.0]
        )

    def score(self, evidence: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-evidence @ self.calibration)))


def build(terms, idf, examples: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Index:
    """An index of (doc_id, toxic, term numbers, counts); similar examples share blocks."""
    bare = [toxic for _, toxic, t, _ in examples if not len(t)]
    every = [toxic for _, toxic, _, _ in examples]
    base = (sum(bare) + (sum(every) + 1) / (len(every) + 2)) / (len(bare) + 1)
    some = [e for e in examples if len(e[2])]
    given = [i for i, e in enumerate(examples) if len(e[2])]
    index = Index(
        terms, idf, *(np.zeros(0, np.int64),) * 8, n_blocks=0, without_terms=float(base)
    )
    index.first = np.zeros(len(terms) + 1, np.int64)
    index.place = np.full(len(examples), -1)
    if not some:
        return index
    vectors = [index.vector(t, c) for _, _, t, c in some]
    order = sorted(range(len(some)), key=lambda i: (some[i][2][vectors[i].argmax()], some[i][0]))
    index.place[[given[i] for i in order]] = np.arange(len(order))
    some, vectors = [some[i] for i in order], [vectors[i] for i in order]
    index.ids = np.array([e[0] for e in some])
    index.toxic = np.array([e[1] for e in some], float)
    term = np.concatenate([e[2] for e in some])
    example = np.repeat(np.arange(len(some)), [len(e[2]) for e in some])
    weight = np.concatenate(vectors)
    by_term = np.lexsort((example, term))
    term, index.example, index.weight = term[by_term], example[by_term], weight[by_term]
    key = term * (len(some) // BLOCK + 1) + index.example // BLOCK
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    index.posting = np.append(starts, len(key))
    index.block = index.example[starts] // BLOCK
    index.most = np.maximum.reduceat(index.weight, starts)
    index.first = np.searchsorted(term[starts], np.arange(len(terms) + 1))
    index.n_blocks = len(some) // BLOCK + 1
    _calibrate(index, some, vectors)
    return index


def _calibrate(index: Index, examples, vectors) -> None:
    """Logistic regression of the label on the evidence, each example left out of its search."""
    step = max(1, len(examples) // CALIBRATE)
    a, y = [], []
    for i in range(0, len(examples), step):
        _, toxic, terms, counts = examples[i]
        found, sims = index.search(terms, vectors[i], NEIGHBOURS, skip=i)
        if len(found):
            a.append(index.evidence(found, sims, terms, counts))
            y.append(toxic)
    if len(set(y)) < 2:
        return
    a, y, w = np.array(a), np.array(y, float), index.calibration.copy()
    start, hold = w.copy(), np.diag([1.0, 1.0, 0.1])
    for _ in range(25):  # Newton steps, with a prior around the vote as it is
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (y - p) - hold @ (w - start)
        w = w + np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + hold, grad)
    index.calibration = w


def _sharpen(texts: Texts, index: Index, numbers: np.ndarray) -> None:
    """How alike texts must be to decide, from examples left out of their searches."""
    step = max(1, len(texts.ids) // CALIBRATE)
    chosen = list(range(0, len(texts.ids), step))
    queries, values = [], []
    for i in chosen:
        words = slice(texts.edges[i], texts.edges[i + 1])
        queries.append((texts.word[words], texts.count[words], 0.0))
        own = numbers[texts.word[words]]
        values.append(index.value(own[own >= 0], texts.count[words][own >= 0], index.place[i]))
    ways = [(sharpness, copies) for sharpness in SHARPNESS for copies in COPIES]
    loss = np.zeros(len(ways))
    for i, value, near in zip(chosen, values, texts.near(queries, NEIGHBOURS, chosen), strict=True):
        for j, way in enumerate(ways):
            p = min(max(texts.mixed(value, *near, *way), 1e-3), 1 - 1e-3)
            loss[j] -= np.log(p if texts.toxic[i] else 1 - p)
    if chosen:
        texts.sharpness, texts.copies = ways[int(loss.argmin())]


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Index, Texts]:
    """About ``sample`` labelled documents that are not held out, by their terms and as whole texts."""
    known = (
        labels.where(
            F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
        )
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    chosen = F.broadcast(hash_sample(known, "doc_id", sample))  # about ``sample`` rows of two numbers
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sampled = texts.join(chosen, "doc_id").select("doc_id", "toxic", "text")

    def words_of(batches):
        """Words and counts of each example, and the least hash of its word triples."""
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last, part, at in slabs(data, offsets):
                hashes, _, _, owner = _words(part, at)
                # A text without triples is like those with the same words.
                every = np.bincount(owner, minlength=last - first)
                least = np.full(last - first, np.iinfo(np.uint64).max, np.uint64)
                few = np.flatnonzero(every[owner] < 3)
                least[owner[few]] = 0
                np.add.at(least, owner[few], hashes[few])
                triples = rolling.windows(hashes, 3)
                within = owner[: len(triples)] == owner[2:]
                np.minimum.at(least, owner[: len(triples)][within], triples[within])
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                new = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                starts = np.flatnonzero(np.append(True, new)[: len(hashes)])
                count = np.diff(np.append(starts, len(hashes)))
                cut = pa.array(np.searchsorted(owner[starts], np.arange(last - first + 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(first, last - first),
                        "toxic": batch.column("toxic").slice(first, last - first).cast(pa.int32()),
                        "like": pa.array(least.view(np.int64)),
                        "words": lists(cut, pa.array(hashes[starts].view(np.int64))),
                        "counts": lists(cut, pa.array(count.astype(np.int32))),
                    }
                )

    schema = "doc_id long, toxic int, like long, words array<long>, counts array<int>"
    rows = sampled.mapInArrow(words_of, schema).toArrow()
    ids, toxic, like = (rows[k].to_numpy() for k in ("doc_id", "toxic", "like"))
    size = pc.list_value_length(rows["words"]).to_numpy().astype(np.int64)
    words = pc.list_flatten(rows["words"]).to_numpy().view(np.uint64)
    count = pc.list_flatten(rows["counts"]).to_numpy()
    del rows
    # Rows of one id differ, if at all, in their texts.
    total = np.add.reduceat(np.append(words, rolling.U(0)), np.cumsum(size) - size) if len(size) else like
    order = np.lexsort((total, size, like, toxic, ids))
    start, end = np.cumsum(size) - size, np.cumsum(size[order])
    ids, toxic, like, size = ids[order], toxic[order], like[order], size[order]
    at = np.arange(len(words)) + np.repeat(start[order] - end + size, size)
    words, count = words[at], count[at]
    del at
    vocabulary, word = np.unique(words, return_inverse=True)
    del words
    word, edges = word.astype(np.int32), np.append(0, end).astype(np.int64)
    chosen_terms = _associated(vocabulary, word, np.repeat(np.arange(len(ids)), size), toxic, like)
    idf, other = _document_frequencies(documents, vocabulary)
    numbers = np.full(len(vocabulary), -1)
    numbers[chosen_terms] = np.arange(len(chosen_terms))
    by_terms = []
    for i in range(len(ids)):
        own, times = numbers[word[edges[i] : edges[i + 1]]], count[edges[i] : edges[i + 1]]
        by_terms.append((int(ids[i]), int(toxic[i]), own[own >= 0], times[own >= 0]))
    index = build(vocabulary[chosen_terms], idf[chosen_terms], by_terms)
    texts = Texts(vocabulary, idf, other, ids, toxic.astype(float), edges, word, count, numbers >= 0)
    _sharpen(texts, index, numbers)
    return index, texts


def _associated(vocabulary, word, owner, toxic, like) -> np.ndarray:
    """The numbers of words whose presence goes with the label; near copies count once."""
    kinds, group = np.unique(np.stack([toxic.astype(np.int64), like]), axis=1, return_inverse=True)
    kind_toxic = kinds[0] == 1
    n1, n0 = float(kind_toxic.sum()), float((~kind_toxic).sum())
    if not n1 or not n0:
        return np.zeros(0, np.int64)
    pairs = np.unique(word * np.int64(len(kind_toxic)) + group.ravel()[owner])
    pair_word, pair_toxic = pairs // len(kind_toxic), kind_toxic[pairs % len(kind_toxic)]
    a = np.bincount(pair_word[pair_toxic], minlength=len(vocabulary)).astype(float)
    b = np.bincount(pair_word[~pair_toxic], minlength=len(vocabulary)).astype(float)
    share = (a + b) / (n1 + n0)

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0.0)

    g = 2 * (
        part(a, share * n1) + part(b, share * n0)
        + part(n1 - a, (1 - share) * n1) + part(n0 - b, (1 - share) * n0)
    )
    some = np.flatnonzero((a + b >= 3) & (share < 1) & (g >= ASSOCIATION))
    best = np.lexsort((vocabulary[some].view(np.int64), -g[some]))[:TERMS]
    return np.sort(some[best])


def _document_frequencies(documents: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, float]:
    """log((1 + N) / (1 + df)) + 1 of each word over all documents, and that of a df of 1."""
    n_terms = len(terms)

    def count(batches):
        places = Places(terms)
        seen, n = np.zeros(n_terms, np.int64), 0
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            n += batch.num_rows
            for _, _, part, at in slabs(data, offsets):
                seen += np.bincount(_term_counts(places, part, at)[1], minlength=n_terms)
        numbers = np.append(np.flatnonzero(seen), -1)
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(numbers), "n": pa.array(np.append(seen[seen > 0], n))}
        )

    if not n_terms:
        return np.zeros(0), 1.0
    rows = documents.select("text").mapInArrow(count, "term long, n long")
    found = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row for each word at most
    df = np.zeros(n_terms + 1, np.int64)
    df[found["term"].to_numpy()] = found["n"].to_numpy()  # the last is the number of documents
    return np.log((1 + df[-1]) / (1 + df[:-1])) + 1, float(np.log((1 + df[-1]) / 2) + 1)


def score(documents: DataFrame, index: Index, texts: Texts) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of each document."""
    number_of = np.full(len(texts.words), -1)
    number_of[np.searchsorted(texts.words, index.terms)] = np.arange(len(index.terms))

    def judge(batches):
        values: dict[bytes, float] = {}

        def by_terms(terms, counts):
            key = terms.tobytes() + counts.tobytes()
            if key not in values:
                if len(values) >= 50_000:
                    values.clear()
                values[key] = index.value(terms, counts)
            return values[key]

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            scores = np.full(batch.num_rows, index.without_terms)
            evidence: list[list] = [[] for _ in range(batch.num_rows)]
            for first, last, part, at in slabs(data, offsets, 2 << 20):
                text, word, count, rest = _word_counts(texts.places, part, at)
                edges = np.searchsorted(text, np.arange(last - first + 1))
                some = np.flatnonzero(np.diff(edges))
                own = [slice(edges[row], edges[row + 1]) for row in some]
                near = texts.near([(word[m], count[m], rest[r]) for r, m in zip(some, own, strict=True)], NEIGHBOURS)
                for row, mine, (found, sims, agree) in zip(some, own, near, strict=True):
                    terms = number_of[word[mine]]
                    value = by_terms(terms[terms >= 0], count[mine][terms >= 0])
                    scores[first + row] = texts.mixed(value, found, sims, agree)
                    evidence[first + row] = [
                        {"doc_id": int(texts.ids[i]), "similarity": float(s),
                         "toxic": int(texts.toxic[i])}
                        for i, s in zip(found[:EVIDENCE], sims, strict=False)
                    ]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(scores),
                    "predicted": pa.array((scores >= 0.5).astype(np.int32)),
                    "evidence": pa.array(evidence, _EVIDENCE),
                }
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    kind = "array<struct<doc_id: long, similarity: double, toxic: int>>"
    schema = f"doc_id long, held_out boolean, score double, predicted int, evidence {kind}"
    return rows.mapInArrow(judge, schema)


_EVIDENCE = pa.list_(
    pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())])
)


def op1_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return score(documents, *fit(documents, table(spark, sf_dir, "labels")))
