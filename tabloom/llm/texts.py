"""Texts of Arrow batches as byte arrays and as independent pieces, for operators that work on batches of rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_kept: dict[Any, Any] = {}


def kept(key: Any, build: Callable[[], Any]) -> Any:
    """build(), made once per worker process and kept for its next tasks.

    One object is kept at a time: worker processes outlive a query, and the caches of an operator that has had its turn
    would take memory from the next one, as would Arrow's buffers that are free but not given back.
    """
    if key not in _kept:
        _kept.clear()
        pa.default_memory_pool().release_unused()
        _kept[key] = build()
    return _kept[key]


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, bytes, start of each row, end of each row) for runs of rows of about limit bytes; null is empty.

    A row longer than the limit is a run of its own, so memory follows the longest text, not the batch.
    """
    column = pc.fill_null(column, "")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1)
        lo, hi = bounds[row], bounds[end]
        yield row, bytes_[lo:hi], bounds[row:end] - lo, bounds[row + 1 : end + 1] - lo
        row = end


ASCII_SPACE = " \n\t\r"
CHUNK = re.compile(f"[{ASCII_SPACE}]*[^{ASCII_SPACE}]+|[{ASCII_SPACE}]+")
# All other white space, those of ASCII first.
RARE_ASCII = "\x0b\x0c\x1c\x1d\x1e\x1f"
RARE_SPACE = RARE_ASCII + "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def independent_chunks(text: str) -> list[str] | None:
    """The text cut before every white space that follows something else.

    A piece of a byte-level vocabulary's split pattern has white space only at its start or is nothing but white space,
    so each such cut is a cut of the pattern, whatever stands around it: chunks can be encoded one by one. None if the
    text has white space of other kinds, for which this does not hold.
    """
    has = text.__contains__
    if any(map(has, RARE_ASCII if text.isascii() else RARE_SPACE)):
        return None
    if has("\0") or has("\t") or has("\r"):
        return CHUNK.findall(text)
    # The same, faster: a mark before each white space, but for one that follows another.
    cut = text.replace(" ", "\0 ").replace("\n", "\0\n").replace(" \0", " ").replace("\n\0", "\n").split("\0")
    return cut if cut[0] else cut[1:]


# Of each byte: 1 for white space of ASCII_SPACE, 2 for other white space of ASCII, 3 for a byte with which the others begin.
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[*map(ord, ASCII_SPACE)]] = 1
KINDS[[*map(ord, RARE_ASCII)]] = 2
KINDS[[*{s.encode()[0] for s in RARE_SPACE if not s.isascii()}]] = 3


def chunk_starts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """First byte of each independent chunk of adjoining texts in UTF-8, and the rows that are one chunk as a whole.

    The cuts of independent_chunks, for many texts at once: texts with white space of other kinds are left whole.
    """
    kinds = KINDS[data]
    white = kinds == 1
    begin = white.copy()
    begin[1:] &= ~white[:-1]
    whole = []
    for row in np.unique(np.searchsorted(starts, np.flatnonzero(kinds > 1), side="right") - 1).tolist():
        text = data[starts[row] : ends[row]]
        if (kinds[starts[row] : ends[row]] == 2).any() or any(map(text.tobytes().decode().__contains__, RARE_SPACE)):
            begin[starts[row] : ends[row]] = False
            whole.append(row)
    begin[starts[starts < ends]] = True
    return np.flatnonzero(begin), whole
