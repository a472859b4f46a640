"""Quality scores from hashed word n-grams and follow-the-regularised-leader updates.

A text becomes a sequence of words, digit runs and symbol runs; a word that only
repeats the one before it counts as a repetition mark.  Single tokens and
neighbouring pairs are hashed into one weight vector.  A document's features are
the shares of its tokens and pairs, so its score is a sparse dot product over
them, whatever its length.  Training is numpy on a bounded sample with
per-coordinate FTRL-proximal updates, which keep useless weights at zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columnar import RangeHash, mix, plain_text, slices, sums_by_row
from tidemark.llm.rows import map_texts
from tidemark.llm.sampling import labelled_sample

# Token classes of bytes: 0 blank, 1 letter (any byte of a multi-byte character too), 2 digit, 3 symbol.
_KIND = np.full(256, 3, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_HASH = RangeHash(seed=3)
_REPEATED, _START = np.uint64(0x51ED270B1), np.uint64(0x2545F4914F6CDD1D)


@dataclass(frozen=True)
class QualitySettings:
    bucket_bits: int = 18
    rows_per_label: int = 3000  # bound of the training sample, per label
    epochs: int = 4
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    scale: float = 20.0  # features are shares of tokens; this brings them to the size of a weight step
    seed: int = 5


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray = field(repr=False)
    bias: float = 0.0
    scale: float = 1.0
    bucket_bits: int = 18


def token_features(
    data: np.ndarray, offsets: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every token and of every pair (two per token), and tokens per document."""
    kind = _KIND[data]
    begins = np.ones(len(kind), bool)
    begins[1:] = kind[1:] != kind[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(kind))
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    with np.errstate(over="ignore"):
        tokens = _HASH.ranges(_HASH.sums(_LOWER[data]), starts, ends)
        first = np.searchsorted(starts, offsets)
        counts = np.diff(first)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[first[:-1][counts > 0]] = _START
        marked = np.where(tokens == before, _REPEATED, tokens)
        pairs = mix(before * np.uint64(0x9E3779B97F4A7C15) + marked)
        pairs[marked == _REPEATED] = _REPEATED
    features = np.stack([mix(marked), mix(pairs)], axis=1)
    return (features >> np.uint64(64 - bits)).astype(np.int32), counts


def _bags(bits: int):
    kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "body"):
            features, counts = token_features(data, offsets, bits)
            ends = np.cumsum(counts)
            ids, shares = [], []
            for end, count in zip(ends, counts, strict=True):
                own, times = np.unique(features[end - count : end], return_counts=True)
                ids.append(own)
                shares.append((times / max(2 * count, 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(ids, kinds[1]), pa.array(shares, kinds[2])],
                names=["label", "ids", "shares"],
            )

    return run


def train_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    settings: QualitySettings = QualitySettings(),
) -> QualityModel:
    """Train on the texts of ``docs`` that ``labels`` (id, 0 or 1) marks.

    At most ``rows_per_label`` labels of either kind are drawn by a hash of the
    id; that bounded list goes to the documents, and not the documents to the
    list.  Their token shares reach the driver, at most 2^bucket_bits numbers a
    row.  Rows without label are not used; without any row every score is 0.5.
    """
    s = settings
    binary = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")
    )
    chosen, found = labelled_sample(binary, "label", "__id", s.rows_per_label, 2)
    weights = np.zeros(1 << s.bucket_bits, np.float32)
    if not found:
        return QualityModel(weights, 0.0, s.scale, s.bucket_bits)
    bags = (
        docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id"))
        .select("label", plain_text(text_col).alias("body"))
        .mapInArrow(_bags(s.bucket_bits), "label int, ids array<int>, shares array<float>")
        .toArrow()
    )
    truth = np.asarray(bags.column("label"))
    ids = [np.asarray(x.values) for x in bags.column("ids")]
    shares = [np.asarray(x.values) * np.float32(s.scale) for x in bags.column("shares")]
    return _fit(truth, ids, shares, s)


def _fit(truth, ids, shares, s: QualitySettings) -> QualityModel:
    """FTRL-proximal: the weight of a coordinate follows from its summed gradients."""
    size = 1 << s.bucket_bits
    lead = np.zeros(size + 1)  # the last coordinate is the bias
    squares = np.zeros(size + 1)
    random = np.random.default_rng(s.seed)

    def current(at: np.ndarray) -> np.ndarray:
        z = lead[at]
        pull = np.sign(z) * np.maximum(np.abs(z) - np.where(at == size, 0, s.l1), 0)
        return -pull / ((s.beta + np.sqrt(squares[at])) / s.alpha + s.l2)

    ids = [np.append(x, size) for x in ids]
    shares = [np.append(x, np.float32(1)) for x in shares]
    for _ in range(s.epochs):
        for k in random.permutation(len(truth)):
            at, x = ids[k], shares[k]
            w = current(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - truth[k]) * x
            step = (np.sqrt(squares[at] + gradient**2) - np.sqrt(squares[at])) / s.alpha
            lead[at] += gradient - step * w
            squares[at] += gradient**2
    final = current(np.arange(size + 1))
    return QualityModel(final[:-1].astype(np.float32), float(final[-1]), s.scale, s.bucket_bits)


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    text_col: str = "text",
    keep: list[str] | None = None,
    score_col: str = "score",
) -> DataFrame:
    """Columns ``keep`` (default: all) and the score, the probability of label 1.

    Whole texts are scored.  Null and empty texts have no features and get the
    score of the bias alone.  An input column called ``score_col`` is replaced.
    """

    def work(part, data, offsets):
        features, counts = token_features(data, offsets, model.bucket_bits)
        dot = sums_by_row(model.weights[features].sum(axis=1), counts)
        logit = model.bias + model.scale * dot / np.maximum(2 * counts, 1)
        return [pa.array(1 / (1 + np.exp(-np.clip(logit, -35, 35))))]

    kept = docs.columns if keep is None else keep
    return map_texts(docs, kept, plain_text(text_col), f"`{score_col}` double", work)
