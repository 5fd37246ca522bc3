"""Where the pattern of byte-level BPE cuts texts, for whole Arrow batches in numpy.

Texts of characters below U+0280 are cut by the classes of their characters; other texts
by the pattern itself. Pieces tile a text, so the places where they start say it all.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import regex

PATTERN = regex.compile(public_tokenizers.PATTERN)
PLAIN = 0x280
LETTER, NUMBER, OTHER, SPACE = range(4)
# The shortenings that the pattern cuts off after an apostrophe.
SHORT_ONE, SHORT_TWO = b"stmd", (b"re", b"ve", b"ll")


def _class(character: str) -> int:
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        if regex.match(pattern, character):
            return kind
    return OTHER


_CLASSES = np.array([_class(chr(c)) for c in range(PLAIN)], np.uint8)
_ASCII = np.append(_CLASSES[:128], np.zeros(128, np.uint8))
_ONE = np.zeros(256, bool)
_ONE[list(SHORT_ONE)] = True


def plain(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have only characters below PLAIN."""
    late = np.searchsorted(np.flatnonzero(data >= 0xC0 + (PLAIN >> 6)), offsets)
    return late[1:] == late[:-1]


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ascending places at which pieces of the texts start."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    simple = plain(data, offsets)
    kind = _ASCII[data]
    lead = np.flatnonzero((data >= 0xC0) & (data < 0xC0 + (PLAIN >> 6)))
    lead = lead[lead + 1 < n]
    of_lead = _CLASSES[((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)]
    kind[lead] = of_lead
    kind[lead + 1] = of_lead

    text_start = np.zeros(n + 1, bool)
    text_start[offsets] = True
    run = text_start[:-1].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    run_at = np.flatnonzero(run)
    run_end = np.append(run_at[1:], n)

    # The last white space before something else: a blank goes with what follows, another
    # character is a piece of its own; what comes before it is a piece.
    spaces = (kind[run_at] == SPACE) & ~text_start[run_end]
    end = run_end[spaces]
    last = end - 1 - ((data[end - 1] & 0xC0) == 0x80)
    start[last] = True
    blank = data[last] == 32
    start[end[blank]] = False

    # An apostrophe alone, no blank before it, and a shortening after it.
    quote = run_at[
        (run_end - run_at == 1) & (data[run_at] == 39) & ~text_start[run_end] & start[run_at]
    ]
    a = data[quote + 1]
    b = data[np.minimum(quote + 2, n - 1)]
    same = (quote + 2 < n) & ~text_start[np.minimum(quote + 2, n)]
    two = np.zeros(len(quote), bool)
    for x, y in SHORT_TWO:
        two |= (a == x) & (b == y)
    two &= same
    size = np.where(_ONE[a], 1, np.where(two, 2, 0))
    quote, size = quote[size > 0], size[size > 0]
    start[quote + 1] = False
    after = quote + 1 + size
    start[after[after < n]] = True

    at = np.flatnonzero(start)
    if simple.all():
        return at
    keep = simple[np.searchsorted(offsets, at, side="right") - 1]
    found = [at[keep]]
    for i in np.flatnonzero(~simple):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        sizes = [len(p.encode()) for p in PATTERN.findall(text)]
        found.append(offsets[i] + np.append(0, np.cumsum(sizes[:-1])).astype(np.int64))
    return np.sort(np.concatenate(found))


def expand(
    sequence: np.ndarray, ids: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of pieces in a row and where each piece's ids start, its end last."""
    sizes = np.diff(offsets)[sequence]
    ends = np.append(0, np.cumsum(sizes))
    at = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
    return ids[np.repeat(offsets[:-1][sequence], sizes) + at], ends
