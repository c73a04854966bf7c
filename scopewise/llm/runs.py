"""Words of whole texts as bytes, in blocks that keep long texts small in memory."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Bytes of a text whose words are listed at once; a longer word makes a block of its own.
BLOCK_BYTES = 1 << 20

_GAP = re.compile(rb"[\x20\x09-\x0D]")


def blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The text in blocks of about ``size`` bytes, cut at white space."""
    at = 0
    while len(data) - at > size:
        gap = _GAP.search(data, at + size)
        if gap is None:
            break
        yield data[at : gap.start()]
        at = gap.start()
    yield data[at:]
