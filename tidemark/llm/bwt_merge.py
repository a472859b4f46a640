"""Burrows-Wheeler transforms of shards of strings and their merge by interleave refinement.

Symbols are runs of ``step`` bytes that start at every position, so a suffix is
read ``step`` bytes at a time and its predecessor lies ``step`` bytes before it.
Each string ends with symbols of its own, which makes all suffixes different and
every shard's order final.

The merge never compares suffixes of two shards.  It keeps only which shard each
place of the merged order takes its next suffix from.  One round reads the
shards' transforms in that order and deals them stably by symbol: the
interleaving that was right for the first k symbols becomes right for k + 1.  A
place where neighbours first part in round k has a common prefix of k - 1
symbols; places that never part within the wanted length bound the repeated
intervals.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.columnar import RangeHash

_HASH = RangeHash(seed=21)
SHARD = 1 << 13


def step_for(length: int) -> int:
    """Largest divisor of the wanted length that is at most 32."""
    return max(d for d in range(1, min(32, length) + 1) if length % d == 0)


class Strings:
    """Strings with their symbols; a string of n bytes has n + 1 suffixes."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, step: int):
        self.step, self.lengths = step, lengths
        self.count = int(lengths.sum()) + len(lengths)
        self.first = np.cumsum(lengths + 1) - (lengths + 1)
        self.owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        self.at = np.arange(self.count) - self.first[self.owner]
        begin = (np.cumsum(lengths) - lengths)[self.owner] + self.at
        full = self.at + step <= lengths[self.owner]
        sums = _HASH.sums(data)
        grams = _HASH.ranges(sums, begin[full], begin[full] + step)
        distinct, rank = np.unique(grams, return_inverse=True)
        symbols = np.empty(self.count, np.int64)
        symbols[full] = rank
        symbols[~full] = len(distinct) + np.arange(self.count - len(rank))
        kind = np.uint16 if self.count <= 1 << 16 else np.uint32
        self.symbols = symbols.astype(kind)
        # The predecessor, round the string's end for the first ones.
        self.before = (self.at - step) % (lengths[self.owner] + 1) + self.first[self.owner]

    def sorted_suffixes(self, low: int, high: int) -> np.ndarray:
        """Suffixes of the strings low to high in order, by doubling the compared length."""
        a = int(self.first[low])
        b = int(self.first[high - 1] + self.lengths[high - 1] + 1)
        rank = self.symbols[a:b].astype(np.int64)
        room = (self.lengths[self.owner[a:b]] - self.at[a:b]).astype(np.int64)
        place = np.arange(b - a)
        width = self.step
        while True:
            later = np.where(room >= width, place + width, place)
            key = rank * (int(rank.max()) + 2) + np.where(room >= width, rank[later] + 1, 0)
            order = np.argsort(key, kind="stable")
            new = np.ones(b - a, bool)
            new[1:] = np.diff(key[order]) != 0
            rank = np.empty(b - a, np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all():
                return order + a
            width *= 2


def merge(strings: Strings, shard: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): all suffixes in merged order and the symbols each shares with the one before.

    ``common`` is -1 where the first ``rounds`` symbols are shared; the order is
    right for as many symbols.
    """
    cuts, size = [0], 0
    for i, n in enumerate(strings.lengths.tolist()):
        if size and size + n >= shard:
            cuts.append(i)
            size = 0
        size += n + 1
    cuts.append(len(strings.lengths))
    orders = [strings.sorted_suffixes(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
    suffixes = np.concatenate(orders)
    transform = strings.symbols[strings.before[suffixes]]
    kind = np.uint8 if len(orders) <= 256 else np.uint16 if len(orders) <= 1 << 16 else np.uint32
    source = np.repeat(np.arange(len(orders), dtype=kind), [len(o) for o in orders])
    common = np.full(len(source), -1, np.int64)
    common[0] = 0
    block = np.zeros(len(source), np.int64)
    read = np.empty_like(transform)
    for k in range(rounds):
        read[np.argsort(source, kind="stable")] = transform
        dealt = np.argsort(read, kind="stable")
        parted = np.zeros(len(source), bool)
        parted[1:] = (np.diff(read[dealt].astype(np.int64)) != 0) | (np.diff(block[dealt]) != 0)
        common[parted & (common < 0)] = k
        block = np.cumsum(parted)
        source = source[dealt]
    order = np.empty_like(suffixes)
    order[np.argsort(source, kind="stable")] = suffixes
    return order, common


def repeated_starts(
    data: np.ndarray, lengths: np.ndarray, weights: np.ndarray, length: int, shard: int = SHARD
) -> np.ndarray:
    """Whether the ``length`` bytes from each place of the strings occur at another place too.

    One flag per byte of ``data``.  A string of weight w counts as w equal strings.
    """
    step = step_for(length)
    strings = Strings(data, lengths, step)
    order, common = merge(strings, shard, length // step)
    interval = np.cumsum(common >= 0) - 1
    whole = strings.at[order] + length <= lengths[strings.owner[order]]
    heavy = np.bincount(interval[whole], weights[strings.owner[order[whole]]], len(order))
    hit = order[whole & (heavy[interval] >= 2)]
    out = np.zeros(len(data), bool)
    out[hit - strings.owner[hit]] = True
    return out
