"""Texts of a batch as runs without ASCII white space, each distinct run once: Arrow splits and numbers them outside of Python."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text split at a time; a longer text comes in pieces that end at white space.
PIECE = 6 << 20
_SPACE = re.compile(rb"[ \t\n\v\f\r]")


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes that are cut at white space only; b"" has none."""
    at = 0
    while len(text) - at > size:
        found = _SPACE.search(text, at + size)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    if at < len(text):
        yield text[at:] if at else text


def distinct_runs(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(the distinct runs, the number of each run of all texts in order, how many runs each text has); the empty run may be among them."""
    runs = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    coded = runs.flatten().dictionary_encode()
    return coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy(zero_copy_only=False), np.diff(runs.offsets.to_numpy())


def sized(batches: Iterator[pa.RecordBatch], column: int, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of rows whose texts have about ``size`` bytes together; a longer text has a slice of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths, dtype=np.int64), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, end - at)
            at = end
