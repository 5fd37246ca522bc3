"""64-bit hashes of words, word windows and byte windows of many texts at once, in numpy.

Two equal pieces have equal hashes wherever they stand. Two different ones agree with a
chance of about 2^-64, which the operators take as never.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Numbers for each byte of so many bytes at a time; they stay in a core's cache.
CHUNK_BYTES = 1 << 18
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
LOWER = BYTE.copy()
LOWER[65:91] = BYTE[97:123]
_BASE = U(0xD6E8FEB86659FD93)
_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 1024), _BASE, U)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers[:n]


def words(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and for each text its first word's number.

    Words are runs of bytes not flagged in ``between`` (ASCII white space); they never
    cross texts.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    full = ~between[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = full[:-1]
    starts = np.flatnonzero(full & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = full[1:]
    ends = np.flatnonzero(full & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def piece_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE
) -> np.ndarray:
    """A hash of each piece data[start:end]; ``values`` gives the value of a byte."""
    sizes = ends - starts
    out = np.zeros(len(starts), U)
    some = np.flatnonzero(sizes > 0)
    total = np.cumsum(sizes[some])
    done = 0
    while done < len(some):  # pieces of some bytes at a time, or one longer piece
        before = total[done - 1] if done else 0
        last = max(done + 1, int(np.searchsorted(total, before + CHUNK_BYTES, side="right")))
        part = some[done:last]
        size, start = sizes[part], starts[part]
        first = np.cumsum(size) - size
        offset = np.arange(int(size.sum())) - np.repeat(first, size)
        value = values[data[np.repeat(start, size) + offset]]
        value *= powers(int(size.max()))[offset]
        out[part] = np.add.reduceat(value, first)
        done = last
    return mix(out + sizes.astype(U) * U(0x9E3779B97F4A7C15))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n neighbours; the last n - 1 places have none."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U)
    out = np.zeros(count, U)
    for i in range(n):
        out *= U(0x9FB21C651E98DF25)
        out += hashes[i : i + count]
    return mix(out)


def byte_levels(data: np.ndarray, most: int) -> list[np.ndarray]:
    """Hashes of the windows of 1, 2, 4, ... up to ``most`` bytes that start at each place."""
    levels = [BYTE[data]]
    while 2 << (len(levels) - 1) <= most:
        half = 1 << (len(levels) - 1)
        last = levels[-1]
        levels.append(mix_pair(last[: max(0, len(last) - half)], last[half:], len(levels)))
    return levels


def windows_at(levels: list[np.ndarray], size: int, places: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the windows of ``size`` bytes at some places, or at all."""
    count = max(0, len(levels[0]) - size + 1)
    found, done = None, 0
    for k in reversed(range(size.bit_length())):
        if size >> k & 1:
            level = levels[k]
            part = level[done : done + count] if places is None else level[places + done]
            found = part if found is None else mix_pair(found, part, 64 + k)
            done += 1 << k
    return mix(found)


def byte_windows(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` bytes that start at each place."""
    return windows_at(byte_levels(data, size), size)


def mix_pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    out = a * (_BASE + U(2 * salt))
    out ^= out >> U(32)
    out += b
    out *= U(0x9FB21C651E98DF25)
    return out
