"""Words of whole texts in bounded memory."""

from __future__ import annotations

import re
from collections.abc import Iterator

BLANK = re.compile(rb"[\x20\x09-\x0D]")
BLOCK_BYTES = 1 << 20


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, those of about ``size`` bytes at a time.

    A block ends at a blank, so no word is divided, and a long text never becomes one list of all its words.
    """
    start = 0
    while start < len(data):
        blank = BLANK.search(data, start + size)
        stop = blank.start() if blank else len(data)
        # Without an argument, bytes are split at the six ASCII blanks and nowhere else.
        yield data[start:stop].split()
        start = stop
