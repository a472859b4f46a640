"""Language identification with averaged hashed subword embeddings.

Every word gives its runs of 3, 4 and 5 bytes (with a mark for the word's edge);
each run is hashed to a row of an embedding table, a document is the mean of its
rows, and a linear softmax over that mean gives the language.  The model is
trained by stochastic gradient descent in numpy on a bounded sample; a second
part of the sample sets the softmax temperature and the confidence below which
a document is rejected.

At prediction the table and the softmax fold into one table of class scores per
hash, so a document is one gather and one sum over its runs.  With more languages
than dimensions the two stay apart, and the softmax is applied to the document's
sum, so the table does not grow with the languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columnar import SLICE_BYTES, plain_text, slices, sums_by_row
from tidemark.llm.rows import numbers
from tidemark.llm.sampling import sample_of_every_label

UNKNOWN = "und"
_LENGTHS = (3, 4, 5)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_EDGE = 32

# A byte of text makes some hundred bytes of hashes and class scores.
_SLICE = SLICE_BYTES // 4

# Bytes that are no part of a word become the edge mark; UTF-8 bytes of other letters stay.
_FOLD = np.full(256, _EDGE, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


@dataclass(frozen=True)
class LanguageSettings:
    bucket_bits: int = 16
    dimensions: int = 16
    epochs: int = 6
    least_steps: int = 8000  # a small sample is gone over more often
    steps_per_language: int = 800  # and so is one of many languages, up to ``epochs`` of ``rows_in_all``
    learning_rate: float = 0.5
    rows_per_language: int = 600  # bound of the training sample, per language
    rows_in_all: int = 38_400  # shared evenly by the languages if there are more than 64
    calibration_scores: int = 8_000_000  # bound of the rows held back, times the languages
    calibration_share: float = 0.25
    wrongly_rejected: float = 0.001  # share of right answers that may be rejected
    strictest_threshold: float = 0.5  # below a half no language holds the text
    seed: int = 11


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    scores: np.ndarray = field(repr=False)  # bucket x language: embedding table times softmax weights
    bias: np.ndarray = field(repr=False)
    softmax: np.ndarray | None = field(default=None, repr=False)  # set if ``scores`` is the embedding table alone
    temperature: float = 1.0
    threshold: float = 0.0
    bucket_bits: int = 16


def subword_buckets(
    data: np.ndarray, offsets: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all subwords, document after document, and their number per document.

    Documents must begin and end with a blank; runs with an inner edge are left out.
    """
    folded = _FOLD[data]
    edge = folded == _EDGE
    packed = folded.astype(np.uint64)
    places, buckets = [], []
    inner = np.zeros(len(folded), bool)  # an edge inside the run that starts here
    key = packed.copy()
    for n in range(2, _LENGTHS[-1] + 1):
        m = len(folded) - n + 1
        if m <= 0:
            break
        if n > 2:
            inner[:m] |= edge[n - 2 : n - 2 + m]
        key = key[:m] | (packed[n - 1 : n - 1 + m] << np.uint64(8 * (n - 1)))
        if n not in _LENGTHS:
            continue
        at = np.flatnonzero(~inner[:m])
        places.append(at)
        buckets.append(
            (((key[at] + np.uint64(n)) * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int32)
        )
    counts = np.zeros(len(offsets) - 1, np.int64)
    if not places:
        return np.zeros(0, np.int32), counts
    split = [np.searchsorted(p, offsets) for p in places]
    counts = sum(np.diff(s) for s in split)
    # Runs of one document stand together, one run length after another.
    order = np.empty(int(counts.sum()), np.int32)
    start = np.cumsum(counts) - counts
    for s, b in zip(split, buckets, strict=True):
        per_doc = np.diff(s)
        order[np.arange(s[0], s[-1]) - np.repeat(s[:-1] - start, per_doc)] = b[s[0] : s[-1]]
        start = start + per_doc
    return order, counts


def _bags(bits: int):
    schema = pa.schema(
        [("label", pa.string()), ("ids", pa.list_(pa.int32())), ("weights", pa.list_(pa.float32()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "body"):
            buckets, counts = subword_buckets(data, offsets, bits)
            ends = np.cumsum(counts)
            ids, weights = [], []
            for end, count in zip(ends, counts, strict=True):
                own, times = np.unique(buckets[end - count : end], return_counts=True)
                ids.append(own)
                weights.append((times / max(count, 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(ids, schema.field(1).type), pa.array(weights, schema.field(2).type)],
                schema=schema,
            )

    return run


def _prepared(text_col: str):
    return F.concat(F.lit(" "), F.lower(plain_text(text_col)), F.lit(" ")).alias("body")


def train_language_model(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    order_col: str = "doc_id",
    settings: LanguageSettings = LanguageSettings(),
) -> LanguageModel | None:
    """Train on (text, label) rows; rows without label or letters are not used.

    Every label is learnt.  At most ``rows_per_language`` rows of each, and about
    ``rows_in_all`` together but one at least, are drawn by a hash of ``order_col``;
    what reaches the driver is their subword counts, at most 2^bucket_bits numbers
    a row, and the list of labels.  Returns None without any row.
    """
    usable = labelled.where(plain_text(text_col).rlike(r"\p{L}"))
    rows, languages = sample_of_every_label(
        usable, label_col, order_col, settings.rows_per_language, settings.rows_in_all
    )
    if not languages:
        return None
    bags = (
        rows.select(F.col(label_col).cast("string").alias("label"), _prepared(text_col))
        .mapInArrow(_bags(settings.bucket_bits), "label string, ids array<int>, weights array<float>")
        .toArrow()
    )
    languages = [str(x) for x in languages]
    place = {x: i for i, x in enumerate(languages)}
    truth = np.array([place[x] for x in bags.column("label").to_pylist()], np.int64)
    ids = [np.asarray(x.values) for x in bags.column("ids")]
    weights = [np.asarray(x.values) for x in bags.column("weights")]
    return _fit(languages, truth, ids, weights, settings)


def _fit(languages, truth, ids, weights, s: LanguageSettings) -> LanguageModel:
    random = np.random.default_rng(s.seed)
    classes = len(languages)
    table = random.uniform(-1, 1, (1 << s.bucket_bits, s.dimensions)).astype(np.float32) / s.dimensions
    softmax = np.zeros((classes, s.dimensions), np.float32)
    bias = np.zeros(classes, np.float32)
    order = random.permutation(len(truth))
    # The first row of every language is learnt from, however few it has.
    first = np.unique(truth[order], return_index=True)[1]
    order = np.concatenate([np.delete(order, first), order[first]])
    held = min(int(len(order) * s.calibration_share), len(order) - classes, s.calibration_scores // classes)
    held = order[: max(0, held)] if len(order) >= 20 else order[:0]
    fit = order[len(held) :]
    least = max(s.least_steps, min(s.steps_per_language * classes, s.epochs * s.rows_in_all))
    epochs = max(s.epochs, -(-least // max(1, len(fit))))
    steps, step = max(1, epochs * len(fit)), 0
    for _ in range(epochs):
        for k in random.permutation(fit):
            rate = s.learning_rate * (1 - step / steps)
            step += 1
            mean = weights[k] @ table[ids[k]]
            logits = softmax @ mean + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[truth[k]] -= 1
            back = error @ softmax
            softmax -= rate * np.outer(error, mean)
            bias -= rate * 0.1 * error
            # Rows of one bag are distinct, so plain indexing adds every part once.
            table[ids[k]] -= (rate * len(ids[k]) ** 0.5) * np.outer(weights[k], back)
    check = held if len(held) else fit[: max(1, s.calibration_scores // classes)]
    means = np.array([weights[k] @ table[ids[k]] for k in check]).reshape(-1, s.dimensions)
    logits = means @ softmax.T + bias
    target = truth[check]
    temperature = min(
        np.geomspace(0.05, 5, 60), key=lambda t: _loss(logits / t, target), default=1.0
    )
    found = _softmax(logits / temperature)
    sure = found.max(axis=1, initial=0)[found.argmax(axis=1) == target] if len(found) else np.zeros(0)
    threshold = float(np.quantile(sure, s.wrongly_rejected)) if len(sure) else 0.0
    # Below chance the answer means nothing; above the cap an easy sample would reject honest texts.
    threshold = float(np.clip(threshold * 0.9, 1 / classes, s.strictest_threshold))
    folded = classes <= s.dimensions
    return LanguageModel(
        languages, table @ softmax.T if folded else table, bias, None if folded else softmax, float(temperature),
        threshold if classes > 1 else 0.0, s.bucket_bits,
    )


def _softmax(logits: np.ndarray) -> np.ndarray:
    out = np.exp(logits - logits.max(axis=1, keepdims=True)) if len(logits) else logits
    return out / out.sum(axis=1, keepdims=True)


def _loss(logits: np.ndarray, target: np.ndarray) -> float:
    """Mean log loss, with one more answer that is right by chance: without an error in the
    sample, the temperature would else go to certainty."""
    logs = np.log(_softmax(logits) + 1e-12)
    chance = 1 / (len(target) + 1)
    return -((1 - chance) * logs[np.arange(len(target)), target] + chance * logs.mean(axis=1)).mean()


def identify_language(
    docs: DataFrame,
    model: LanguageModel | None,
    text_col: str = "text",
    keep: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Columns ``keep`` (default: all) and lang_pred, score, rejected of every document.

    The whole text is read.  Null texts and texts without a letter are ``und``
    with score 0 and rejected, and so is everything if nothing could be learnt.
    Rejected documents with letters still carry their likeliest language.  The
    three new columns replace input columns of the same name; ``prefix`` goes
    before their names to keep both.  Only the lower-cased text goes to Python and
    only the three columns come back; the columns kept stay with Spark.
    """
    names = [prefix + c for c in ("lang_pred", "score", "rejected")]
    passed = [c for c in (docs.columns if keep is None else keep) if c not in names]
    lettered = plain_text(text_col).rlike(r"\p{L}")
    if model is None:
        return docs.select(
            *(f"`{c}`" for c in passed),
            F.lit(UNKNOWN).alias(names[0]),
            F.lit(0.0).alias(names[1]),
            F.lit(True).alias(names[2]),
        )
    known_names = np.array(model.languages, object)

    def work(part, data, offsets):
        buckets, counts = subword_buckets(data, offsets, model.bucket_bits)
        mean = sums_by_row(model.scores[buckets], counts) / np.maximum(counts, 1)[:, None]
        if model.softmax is not None:
            mean = mean @ model.softmax.T
        found = _softmax((mean + model.bias) / model.temperature)
        best = found.argmax(axis=1)
        sure = found[np.arange(len(best)), best]
        known = numbers(part, "lettered").astype(bool)
        return [
            pa.array(np.where(known, known_names[best], UNKNOWN), pa.string()),
            pa.array(np.where(known, sure, 0.0)),
            pa.array(~known | (sure < model.threshold)),
        ]

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def identify(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        batches = (pa.RecordBatch.from_arrays([*p], ["body", "lettered"]) for p in parts)
        for part, data, offsets in slices(batches, "body", _SLICE):
            yield pa.StructArray.from_arrays(work(part, data, offsets), ["lang_pred", "score", "rejected"])

    # Not deterministic, or a filter on the result would move below it and find the language anew.
    found = identify.asNondeterministic()(_prepared(text_col), lettered).alias("__found")
    inside = [f"__c{i}" for i in range(len(passed))]
    rows = docs.select(*(F.col(f"`{c}`").alias(i) for c, i in zip(passed, inside, strict=True)), found)
    return rows.select(*inside, "__found.*").toDF(*passed, *names)
