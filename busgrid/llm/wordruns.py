"""Words of one text in runs of bounded size, so that a very long text needs little memory."""

from __future__ import annotations

import re
from collections.abc import Iterator

RUN_BYTES = 1 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def word_runs(text: bytes, most: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, cut at white space after ``most`` bytes.

    ``bytes.split`` splits at exactly these characters.
    """
    if len(text) <= most:
        yield text.split()
        return
    start = 0
    while start < len(text):
        gap = _WHITE.search(text, min(start + most, len(text)))
        end = gap.start() if gap else len(text)
        yield text[start:end].split()
        start = end
