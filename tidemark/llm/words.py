"""Words of whole texts as numpy columns, and their prefix-doubling ranks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidemark.llm.columnar import ragged


def dictionary(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A number per value of the concatenated ``data``; equal numbers for equal bytes only."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    values = pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers)
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass
class Words:
    """Words (runs of bytes other than ASCII white space) of all texts of a slice.

    ``start`` and ``end`` are byte places in the slice, ``doc`` the text of a word,
    ``counts`` the words per text, ``ids`` numbers that only equal words share.
    """

    data: np.ndarray
    inside: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    counts: np.ndarray
    ids: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Number of the first word of every text."""
        return np.cumsum(self.counts) - self.counts

    def joined(self, keep: np.ndarray) -> list[str]:
        """The kept words of every text, joined by one space."""
        lengths = (self.end - self.start)[keep]
        padded = np.append(self.data, np.uint8(32))
        out = padded[ragged(self.start[keep], lengths + 1)]
        stops = np.cumsum(lengths + 1)
        out[stops - 1] = 32
        raw = out.tobytes()
        held = np.cumsum(np.bincount(self.doc[keep], minlength=len(self.counts)))
        edges = np.concatenate([[0], stops])[np.concatenate([[0], held])].tolist()
        return [raw[a : max(a, b - 1)].decode() for a, b in zip(edges, edges[1:], strict=False)]


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = (data != 32) & ((data < 9) | (data > 13))
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edges[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edges[1:]
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(
        data, inside, start, end, doc, np.bincount(doc, minlength=len(offsets) - 1),
        dictionary(data[inside], end - start),
    )
