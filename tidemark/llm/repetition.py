"""Quality rules on repetition, from a suffix array over the words of every text.

Suffixes are sorted by prefix doubling: groups that share their first h words are
split by the group of the suffix h words on, and only groups of several suffixes go
on.  Each round's groups are kept; read from the last round to the first they give
the common prefix of two neighbours in the suffix array.  The intervals of the common
prefixes (one pass with a stack over the places that share enough words) are the
repeated substrings; those whose occurrences follow different words cannot be made
longer on either side and are the maximal ones.  Spans of the longest maximal repeat
at every place make up all repeated words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columnar import plain_text
from tidemark.llm.rows import map_texts
from tidemark.llm.words import Words, dictionary, split_words

SYMBOLS = b"#*$%&|<>"


def suffix_ranks(ids: np.ndarray, doc: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """For h = 1, 2, 4, ...: per word a number that suffixes of one text share if and only if
    they share their first h words; the last numbers are the order of the suffixes."""
    n = len(ids)
    stop = np.repeat(np.cumsum(counts), counts)
    rank = np.zeros(n, np.int64)
    open_ = np.arange(n)
    key = doc * (int(ids.max(initial=0)) + 1) + ids
    out, width = [], 0
    while len(open_):
        order = np.argsort(key, kind="stable")
        at, sorted_key = open_[order], key[order]
        new = np.ones(len(at), bool)
        new[1:] = np.diff(sorted_key) != 0
        # A group's number is the place of its first suffix among all suffixes.
        if width:
            base = rank[at]
            parent = np.ones(len(at), bool)
            parent[1:] = np.diff(base) != 0
            index = np.arange(len(at))
            index -= np.maximum.accumulate(np.where(parent, index, 0))
            place = base + index
        else:
            place = np.arange(len(at))
        group = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        rank = rank.copy()
        rank[at] = place[group]
        out.append(rank.astype(np.int32 if n < 1 << 31 else np.int64))
        alone = new & np.concatenate([new[1:], [True]])
        open_ = at[~alone]
        width = 2 * width if width else 1
        later = np.minimum(open_ + width, n - 1)
        following = np.where(open_ + width < stop[open_], rank[later] + 1, 0)
        key = rank[open_] * (n + 2) + following
    return out


def _common(a: np.ndarray, b: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes ``a`` and ``b`` share."""
    n = len(ranks[0])
    shared = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        i, j = a + shared, b + shared
        fits = (i < n) & (j < n) & (i != j)
        same = ranks[k][np.where(fits, i, 0)] == ranks[k][np.where(fits, j, 0)]
        shared += (1 << k) * (fits & same)
    return shared


def maximal_repeats(words: Words, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, length, count) of the maximal repeated substrings of at least ``least`` words, and
    per word the length of the longest of them that starts there."""
    n = len(words.ids)
    covered = np.zeros(n, np.int64)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none, covered
    ranks = suffix_ranks(words.ids, words.doc, words.counts)
    # Only suffixes that share a power of two of at most ``least`` words with another matter.
    level = min(least.bit_length() - 1, len(ranks) - 1)
    crowd = np.bincount(ranks[level], minlength=n)
    suffix = np.empty(n, np.int64)
    suffix[ranks[-1]] = np.arange(n)
    suffix = suffix[crowd[ranks[level][suffix]] > 1]
    if not len(suffix):
        return none, none, none, covered
    prefix = np.zeros(len(suffix) + 1, np.int64)
    prefix[1:-1] = _common(suffix[:-1], suffix[1:], ranks)
    prefix[prefix < least] = 0
    # Intervals: [low, high] of the suffix array with a common prefix of ``size`` words.
    low, high, size = [], [], []
    of = np.full(len(prefix), -1, np.int64)  # the interval that the boundary before a place belongs to
    stack: list[int] = []
    for t in np.flatnonzero((prefix > 0) | np.concatenate([[False], prefix[:-1] > 0])).tolist():
        shared = int(prefix[t])
        begin = t - 1
        while stack and size[stack[-1]] > shared:
            top = stack.pop()
            high[top] = t - 1
            begin = low[top]
        if shared:
            if not stack or size[stack[-1]] < shared:
                stack.append(len(size))
                low.append(begin)
                high.append(-1)
                size.append(shared)
            of[t] = stack[-1]
    if not size:
        return none, none, none, covered
    low, high, size = (np.array(x, np.int64) for x in (low, high, size))
    previous = np.where(np.isin(suffix, words.first[words.counts > 0]), -1, words.ids[suffix - 1])
    change = np.concatenate([[0], np.cumsum(np.diff(previous) != 0)])
    maximal = change[high] > change[low]
    deepest = np.where(prefix[:-1] >= prefix[1:], of[:-1], of[1:])
    held = deepest >= 0
    held[held] = maximal[deepest[held]]
    covered[suffix[held]] = size[deepest[held]]
    return words.doc[suffix[low[maximal]]], size[maximal], (high - low + 1)[maximal], covered


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated_lines(words: Words, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, per text."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(words.data == 10)
    # A text of b breaks has b + 1 lines; lines of all texts in order.
    many = np.bincount(np.searchsorted(offsets, breaks, side="right") - 1, minlength=n) + 1
    doc = np.repeat(np.arange(n), many)
    last = np.zeros(len(doc), bool)
    last[np.cumsum(many) - 1] = True
    end = np.empty(len(doc), np.int64)
    end[last], end[~last] = offsets[1:], breaks
    begin = np.empty(len(doc), np.int64)
    first = np.concatenate([[True], last[:-1]])
    begin[first], begin[~first] = offsets[:-1], breaks + 1
    ids = dictionary(words.data[words.data != 10], end - begin)
    held = np.concatenate([[0], np.cumsum(words.inside)])
    some = held[end] > held[begin]
    lines = np.bincount(doc[some], minlength=n)
    distinct = np.unique(doc[some] * (int(ids.max(initial=0)) + 1) + ids[some])
    return lines - np.bincount(distinct // (int(ids.max(initial=0)) + 1), minlength=n)


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeats", "longest_repeat",
)


def measure_repetition(
    docs: DataFrame, text_col: str = "text", least: int = 8, keep: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with counts of every whole text, named with ``prefix``.

    n_words        words: runs of anything but ASCII white space
    word_chars     code points in words
    n_symbols      characters of ``SYMBOLS``
    n_dup_lines    lines with a word that equal an earlier line of the text
    n_repeat_words words of repeated substrings of at least ``least`` words, first ones included
    n_repeats      maximal repeated substrings of at least ``least`` words
    longest_repeat words of the longest of them, 0 without any

    Null and empty texts have zeros.  Rows are independent, so repeated rows get equal
    counts, and an empty table gives an empty one.  Columns of ``docs`` pass unchanged,
    but for those named like a count.
    """
    if least < 1:
        raise ValueError("a repeat has at least one word")

    def work(part, data, offsets):
        words = split_words(data, offsets)
        doc, length, _, covered = maximal_repeats(words, least)
        steps = np.zeros(len(covered) + 1, np.int64)
        begin = np.flatnonzero(covered)
        np.add.at(steps, begin, 1)
        np.add.at(steps, begin + covered[begin], -1)
        repeated = np.cumsum(steps[:-1]) > 0
        longest = np.zeros(part.num_rows, np.int64)
        np.maximum.at(longest, doc, length)
        counts = (
            words.counts,
            _per_doc(words.inside & ((data & 0xC0) != 0x80), offsets),
            _per_doc(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)), offsets),
            _repeated_lines(words, offsets),
            np.bincount(words.doc[repeated], minlength=part.num_rows),
            np.bincount(doc, minlength=part.num_rows),
            longest,
        )
        return [pa.array(c.astype(np.int64)) for c in counts]

    out = ", ".join(f"`{prefix}{name}` long" for name in MEASURES)
    passed = docs.columns if keep is None else keep
    return map_texts(docs, passed, plain_text(text_col), out, work)


def quality_rules(
    docs: DataFrame, text_col: str = "text", least: int = 8, least_words: int = 20,
    covered_percent: int = 30, longest_percent: int = 20, keep: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """``measure_repetition`` with two verdicts.

    ``base_failed``: fewer than ``least_words`` words, or repeats cover more than
    ``covered_percent`` of them.  ``kept``: not so, and the longest repeat has at most
    ``longest_percent`` of the words; two copies side by side cover twice as much, so
    this also meets a repeat whose copies overlap.  Texts without words are not kept.
    """
    found = measure_repetition(docs, text_col, least, keep, prefix)
    n, covered, longest = (F.col(f"`{prefix}{c}`") for c in ("n_words", "n_repeat_words", "longest_repeat"))
    base = (n < least_words) | (100 * covered > covered_percent * n)
    names = (f"{prefix}base_failed", f"{prefix}kept")
    return found.select(
        *(F.col(f"`{c}`") for c in found.columns if c not in names),
        base.alias(names[0]),
        (~base & (100 * longest <= longest_percent * n)).alias(names[1]),
    )
