"""Stretches of words that repeat with a period, found with a dictionary of basic factors.

For every power of two 2^k the factors of 2^k words get names, equal names for equal
factors of one text; a factor's name is the pair of the names of its halves.  A factor
that occurs once in its text has no name and takes no further part.

The successor of an occurrence is the next occurrence of the same factor.  Where both lie
within 2 * 2^k words, twice the factor's length, successors form arithmetic progressions;
three terms with difference d <= 2^k prove that d is the smallest period of the words they
cover.  (A smaller one would divide d and put an occurrence in between.)  Every run of
exponent 4 is proposed at the level with d <= 2^k < 2 * d.  Progressions of one difference
that begin side by side are one proposal; proposals are extended to both sides by comparing
factors of the dictionary from long to short, and each run is kept once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columnar import plain_text
from tidemark.llm.rows import map_texts
from tidemark.llm.words import split_words

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
_LIST = pa.list_(pa.field("element", _RUN))


def basic_factors(ids: np.ndarray, doc: np.ndarray):
    """Level by level: names of the factors of 2^k words at every word, -1 where the factor
    occurs once in its text or reaches beyond it, with the named places in order of
    (name, place).  Ends before the first level without names."""
    n = len(ids)
    place, key = np.arange(n), doc * (int(ids.max(initial=0)) + 1) + ids
    width = 1
    while len(place):
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        if not twice.any():
            return
        fresh = np.concatenate([[True], ~same])
        names = np.full(n, -1, np.int32)
        held = place[order[twice]]
        names[held] = (np.cumsum(fresh) - 1)[twice]
        yield names, held
        place = np.sort(held)
        place = place[place + width < n]
        # Names differ between texts, so a pair of halves from two texts recurs nowhere.
        place = place[(names[place + width] >= 0) & (doc[place] == doc[np.minimum(place + width, n - 1)])]
        key = names[place].astype(np.int64) * n + names[place + width]
        width *= 2


def _proposals(names: np.ndarray, held: np.ndarray, doc: np.ndarray, width: int):
    """(start, end, period) of stretches with three equally spaced occurrences."""
    name = names[held]
    gap = np.where(name[1:] == name[:-1], np.diff(held), 0)
    gap[gap > width] = 0
    head = gap > 0
    head[1:] &= gap[1:] != gap[:-1]
    # Of equal gaps in a row: the first and the last term, and how many there are.
    first = np.flatnonzero(head)
    after = np.flatnonzero((gap > 0) & np.concatenate([gap[1:] != gap[:-1], np.ones(min(1, len(gap)), bool)]))
    long = after > first
    start, end, period = held[first[long]], held[after[long] + 1] + width, gap[first[long]]
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return start, end, period
    # Progressions that begin side by side overlap by more than a period: one proposal.
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 1) | (np.diff(period) != 0) | (np.diff(doc[start]) != 0)
    return start[new], np.maximum.reduceat(end, np.flatnonzero(new)), period[new]


def _extended(start, end, period, levels):
    """Proposals made as long as the words go on with their period."""
    if not len(levels):
        return start, end
    n = len(levels[0])
    steps = [*range(len(levels) - 1, -1, -1)]
    for k in [steps[0], *steps]:
        names, width = levels[k], 1 << k
        fits = end + width <= n
        a, b = names[np.where(fits, end - period, 0)], names[np.where(fits, end, 0)]
        end = end + width * (fits & (a >= 0) & (a == b))
        fits = start >= width
        back = np.where(fits, start - width, 0)
        a, b = names[back], names[np.minimum(back + period, n - 1)]
        start = start - width * (fits & (a >= 0) & (a == b))
    return start, end


def runs(
    ids: np.ndarray, doc: np.ndarray, least: int = 6, times: int = 4
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs of at least ``least`` words and ``times``
    periods, in order of start and period; starts count over all texts."""
    levels, found = [], [np.zeros((0, 3), np.int64)]
    for k, (names, held) in enumerate(basic_factors(ids, doc)):
        levels.append(names)
        start, end, period = _proposals(names, held, doc, 1 << k)
        start, end = _extended(start, end, period, levels)
        fits = end - start >= np.maximum(least, times * period)
        found.append(np.unique(np.stack([start, end - start, period], 1)[fits], axis=0))
    every = np.unique(np.concatenate(found), axis=0)
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    return every[:, 0], every[:, 1], every[:, 2]


def find_runs(
    docs: DataFrame, text_col: str = "text", least: int = 6, times: int = 4,
    keep: list[str] | None = None, added: tuple[str, str] = ("runs", "collapsed"),
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the periodic runs of every text.

    A run is a stretch of at least ``least`` words (runs of anything but ASCII white
    space) and at least ``times`` smallest periods, that no neighbouring word extends
    with that period.  ``added`` names the runs, an array of (start, length, period) in
    words from 0, by start and then period, and the text without the repetitions: the
    words that no run holds after its first period, joined by one space.

    Null and empty texts have no words, no runs and an empty collapsed text.  Rows are
    independent, so repeated rows get equal results, and an empty table an empty one.
    Columns of ``docs`` pass unchanged, but for those that ``added`` names.
    """
    if least < 1 or times < 4:
        raise ValueError("runs need at least one word and four periods")

    def work(part, data, offsets):
        words = split_words(data, offsets)
        start, length, period = runs(words.ids, words.doc, least, times)
        steps = np.zeros(len(words.ids) + 1, np.int64)
        np.add.at(steps, start + period, 1)
        np.add.at(steps, start + length, -1)
        kept = np.cumsum(steps[:-1]) == 0
        owner = words.doc[start]
        many = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=part.num_rows))])
        rows = pa.StructArray.from_arrays(
            [pa.array(start - words.first[owner]), pa.array(length), pa.array(period)],
            fields=list(_RUN),
        )
        lists = pa.ListArray.from_arrays(pa.array(many.astype(np.int32)), rows, type=_LIST)
        return [lists, pa.array(words.joined(kept), pa.string())]

    out = f"`{added[0]}` {_RUNS}, `{added[1]}` string"
    passed = docs.columns if keep is None else keep
    return map_texts(docs, passed, plain_text(text_col), out, work)


def repeat_tail(text, at, width):
    """A column: the words of ``text`` from number ``at`` on replaced by its ``width`` words
    there, again and again, to the same number of words; joined by one space."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words)
    unit = F.slice(words, at + 1, width)
    tail = F.flatten(F.array_repeat(unit, F.ceil((n - at) / width).cast("int")))
    return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), at), tail), F.lit(1), n), " ")
