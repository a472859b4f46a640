"""Byte-pair encoding with a segment tree over adjacent pair ranks, and decoding.

A text is normalised and cut into words as its tokenizer file says; equal words
have equal ids, so a task encodes each distinct word of a slice once and keeps a
bounded number of them for the next slices.  Words of like length are encoded
together as rows of numpy arrays: the leaves of a row's segment tree hold
(rank, position) of its adjacent pairs, the root is the leftmost pair of lowest
rank, and a merge changes three leaves and the paths above them.  A word of n
symbols takes O(n log n), also when it is a line of a million symbols.

Supported are files with NFC, white space folding, lower case, the splitting
pattern below, byte-level symbols, a word-end suffix and special tokens that are
matched in the raw text; anything else is refused.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from tidemark.llm.columnar import plain_text, ragged, sums_by_row
from tidemark.llm.rows import map_texts
from tidemark.llm.words import dictionary

# Fixed values of the supported file format.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SHORT_ENDINGS = "stmd"
_LONG_ENDINGS = ("re", "ve", "ll")

_LIBRARY_NORMAL = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_NEVER = np.int64(1 << 62)
_CACHED_WORDS = 300_000
_CELLS = 1 << 19  # leaves that are encoded together


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in names:
            names[b] = chr(spare)
            spare += 1
    return [names[b] for b in range(256)]


@dataclass(frozen=True)
class BpeTables:
    """A vocabulary in the form the encoder needs; small enough for every task."""

    inner: np.ndarray = field(repr=False)  # id of each byte inside a word
    final: np.ndarray = field(repr=False)  # id of each byte as a word's last
    pairs: np.ndarray = field(repr=False)  # left << 16 | right, ascending
    ranks: np.ndarray = field(repr=False)  # rank of each of them
    merged: np.ndarray = field(repr=False)  # id by rank
    tokens: list[bytes] = field(repr=False)  # id to string, for decoding
    special: dict[str, int] = field(default_factory=dict)
    kinds: tuple = field(default=(), repr=False)  # code point ranges of the splitting pattern
    digest: str = ""

    @staticmethod
    def load(path: str) -> BpeTables:
        with open(path, "rb") as file:
            raw = file.read()
        spec = json.loads(raw)
        model, added = spec["model"], spec["added_tokens"]
        normal = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        ends = model.get("end_of_word_suffix")
        if (
            model["type"] != "BPE" or normal != _NORMALIZERS or spec["decoder"] is not None or not ends
            or splits[0].get("pattern") != {"Regex": _PATTERN}
            or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        ):
            raise ValueError(f"{path}: not a word-end byte-pair file of the supported form")
        vocab = model["vocab"]
        if max(vocab.values()) >= 1 << 16:
            raise ValueError(f"{path}: more than 65,536 ids")
        symbols = byte_symbols()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = np.array([vocab[a] << 16 | vocab[b] for a, b in merges], np.uint32)
        order = np.argsort(pairs, kind="stable")
        names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in added}
        return BpeTables(
            np.array([vocab[s] for s in symbols], np.int32),
            np.array([vocab[s + ends] for s in symbols], np.int32),
            pairs[order],
            order.astype(np.int64),
            np.array([vocab[a + b] for a, b in merges], np.int32),
            [names.get(i, "").encode() for i in range(max(names) + 1)],
            {t["content"]: t["id"] for t in added},
            tuple(probe_kinds()),
            hashlib.sha256(raw).hexdigest(),
        )


# ---- words -------------------------------------------------------------------------------


@lru_cache(1)
def probe_kinds() -> list[tuple[int, int, int]]:
    """(first, end, kind) of the code points that the pattern's classes hold.

    Asked from the library's own pattern engine, whose Unicode version need not be Python's.
    """
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    out = []
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        for _, (a, b) in split.pre_tokenize_str(everything):
            out.append((points[a], points[b - 1] + 1, kind))
    return out


@lru_cache(1)
def _kind_table(ranges: tuple) -> np.ndarray:
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for a, b, kind in ranges:
        kinds[a:b] = kind
    return kinds


@lru_cache(1)
def _unassigned() -> np.ndarray:
    """Code points that Python does not know; the library may, so it normalises them."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def normalised(texts: list[str]) -> list[str]:
    """NFC and lower case, character by character (no final-sigma rule)."""
    whole = "".join(texts)
    if whole.isascii():
        return [t.lower() for t in texts]
    unknown = _unassigned()
    rare = unknown[np.frombuffer(whole.encode("utf-32-le"), np.uint32)].any()
    return [_normal(t, rare and unknown[[ord(c) for c in t]].any()) for t in texts]


def _normal(text: str, rare: bool) -> str:
    if rare:
        return _LIBRARY_NORMAL.normalize_str(text)
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def split_words(
    points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of normalised texts; no word crosses an offset."""
    kind = kinds[points]
    n = len(points)
    begin = np.ones(n, bool)
    begin[1:] = kind[1:] != kind[:-1]
    begin[offsets[:-1][offsets[:-1] < n]] = True
    begin[kind == _NUMBER] = True
    begin[kind == _SPACE] = False
    quotes = np.flatnonzero((points == 39) & begin)
    if len(quotes):
        limit = offsets[np.searchsorted(offsets, quotes, side="right")]
        padded = np.append(points, np.zeros(3, points.dtype))
        second, third = padded[quotes + 1], padded[quotes + 2]
        size = np.where(np.isin(second, [ord(c) for c in _SHORT_ENDINGS]), 2, 0)
        for a, b in _LONG_ENDINGS:
            size = np.where((second == ord(a)) & (third == ord(b)), 3, size)
        ok = (size > 0) & (quotes + size <= limit)
        quotes, size, limit = quotes[ok], size[ok], limit[ok]
        begin[quotes + 1] = False
        after = quotes + size
        go_on = after < limit
        go_on[go_on] = kind[after[go_on]] == _LETTER
        begin[after[go_on]] = True
    starts = np.flatnonzero(begin)
    stops = np.append(np.flatnonzero(begin | (kind == _SPACE)), n)
    return starts, stops[np.searchsorted(stops, starts, side="right")]


# ---- segment tree --------------------------------------------------------------------------


def encode_words(words: list[bytes], tables: BpeTables) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids per word) of words given as UTF-8 bytes, none of them empty."""
    lengths = np.array([len(w) for w in words], np.int64)
    out: list[np.ndarray | None] = [None] * len(words)
    counts = np.zeros(len(words), np.int64)
    width = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(lengths - 1, 1))).astype(np.int64))
    for size in np.unique(width):
        group = np.flatnonzero(width == size)
        step = max(1, _CELLS // int(size))
        for lo in range(0, len(group), step):
            own = group[lo : lo + step]
            for k, found in zip(own, _merge_group([words[i] for i in own], int(size), tables), strict=True):
                out[k] = found
                counts[k] = len(found)
    return (np.concatenate(out) if words else np.zeros(0, np.int32)), counts


def _pair_keys(left, right, at, tables: BpeTables) -> np.ndarray:
    """rank << 32 | position of pairs; _NEVER for pairs without a merge."""
    pair = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
    place = np.minimum(np.searchsorted(tables.pairs, pair), len(tables.pairs) - 1)
    return np.where(tables.pairs[place] == pair, tables.ranks[place] << 32 | at, _NEVER)


def _merge_group(words: list[bytes], leaves: int, tables: BpeTables) -> list[np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int64)
    rows = np.arange(len(words))
    raw = np.zeros((len(words), leaves + 1), np.uint8)
    raw[np.arange(leaves + 1) < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    ids = tables.inner[raw]
    ids[rows, lengths - 1] = tables.final[raw[rows, lengths - 1]]
    # Neighbours of every symbol; column ``leaves + 1`` takes writes beyond the word's end.
    after = np.tile(np.arange(1, leaves + 3), (len(words), 1))
    before = np.tile(np.arange(-1, leaves + 1), (len(words), 1))
    tree = np.full((len(words), 2 * leaves), _NEVER)
    at = np.arange(leaves)
    real = at < lengths[:, None] - 1
    first = _pair_keys(ids[:, :-1], ids[:, 1:], at, tables)
    tree[:, leaves:] = np.where(real, first, _NEVER)
    level = leaves
    while level > 1:
        pairs = tree[:, level : 2 * level].reshape(len(words), -1, 2)
        tree[:, level // 2 : level] = pairs.min(axis=2)
        level //= 2
    root = 1 if leaves > 1 else leaves
    alive = np.ones(raw.shape, bool)
    alive &= np.arange(leaves + 1) < lengths[:, None]
    flat = tree.ravel()

    def put(row, leaf, key):
        node = leaf + leaves
        base = row * (2 * leaves)
        flat[base + node] = key
        while node[0] > 1:
            node = node >> 1
            flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])

    open_ = rows[tree[:, root] < _NEVER]
    while len(open_):
        best = tree[open_, root]
        here = best & 0xFFFFFFFF
        gone = after[open_, here]
        behind = after[open_, gone]
        ids[open_, here] = tables.merged[best >> 32]
        alive[open_, gone] = False
        after[open_, here] = behind
        before[open_, np.minimum(behind, leaves + 1)] = here
        has = gone < leaves  # the swallowed symbol had a pair leaf of its own
        if has.any():
            put(open_[has], gone[has], _NEVER)
        last = behind >= lengths[open_]
        right = ids[open_, np.minimum(behind, leaves)]
        put(open_, here, np.where(last, _NEVER, _pair_keys(ids[open_, here], right, here, tables)))
        left = before[open_, here]
        some = left >= 0
        if some.any():
            row, left, own = open_[some], left[some], here[some]
            put(row, left, _pair_keys(ids[row, left], ids[row, own], left, tables))
        open_ = open_[tree[open_, root] < _NEVER]
    per_word = alive.sum(axis=1)
    return np.split(ids[alive], np.cumsum(per_word)[:-1])


# ---- texts -----------------------------------------------------------------------------------


class Encoder:
    """Encodes slices of texts, remembering a bounded number of words between them."""

    def __init__(self, tables: BpeTables, cached_words: int = _CACHED_WORDS):
        self._tables = tables
        self._limit = cached_words
        self._kinds = _kind_table(tables.kinds)
        names = "|".join(re.escape(s) for s in sorted(tables.special, key=len, reverse=True))
        self._special = re.compile(f"({names})") if names else None
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._held = 0  # letters of the remembered words
        self._ids, self._starts, self._counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text), the texts one after another."""
        if self._special is None or not any(self._special.search(t) for t in texts):
            return self._plain(texts)
        pieces = [self._special.split(t) for t in texts]
        ids, counts = self._plain([p for own in pieces for p in own[::2]])
        parts, at, k, totals = [], 0, 0, []
        for own in pieces:
            total = 0
            for i, piece in enumerate(own):
                if i % 2:
                    parts.append(np.array([self._tables.special[piece]], np.int32))
                    total += 1
                else:
                    parts.append(ids[at : at + counts[k]])
                    at, total, k = at + counts[k], total + counts[k], k + 1
            totals.append(total)
        return np.concatenate(parts), np.array(totals, np.int64)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = normalised(texts)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        starts, ends = split_words(points, offsets, self._kinds)
        # Words are told apart by their letters: hashes of chosen words can collide.
        lengths = ends - starts
        inverse = dictionary(points[ragged(starts, lengths)].view(np.uint8), 4 * lengths)
        first = np.empty(inverse.max(initial=-1) + 1, np.int64)
        first[inverse[::-1]] = np.arange(len(inverse))[::-1]
        spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
        distinct = [whole[a:b] for a, b in spans]
        letters = int(lengths[first].sum())
        if len(self._slots) + len(distinct) > self._limit or self._held + letters > 16 * self._limit:
            self._forget()
        slots = np.array([self._slots.get(w, -1) for w in distinct], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            ids, counts = encode_words([distinct[i].encode() for i in new], self._tables)
            known = len(self._counts)
            self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(counts) - counts])
            self._ids = np.concatenate([self._ids, ids])
            self._counts = np.concatenate([self._counts, counts])
            slots[new] = known + np.arange(len(new))
            self._slots.update(zip([distinct[i] for i in new], slots[new].tolist(), strict=True))
            self._held += int(lengths[first[new]].sum())
        used = slots[inverse]
        per_word = self._counts[used]
        found = self._ids[ragged(self._starts[used], per_word)]
        words = np.diff(np.searchsorted(starts, offsets))
        return found, sums_by_row(per_word, words).astype(np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(tables: BpeTables) -> Encoder:
    """The encoder of this Python worker, with the words it met in earlier tasks."""
    if tables.digest not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tables.digest] = Encoder(tables)
    return _ENCODERS[tables.digest]


def texts_of(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def decode(ids: np.ndarray, tables: BpeTables) -> bytes:
    """UTF-8 of the decoded ids: the token strings with blanks between them."""
    return b" ".join([tables.tokens[i] for i in ids.tolist()])


def encode_documents(
    docs: DataFrame, path: str, keep: list[str], text_col: str = "text",
    ids_col: str = "ids", decoded_col: str | None = None,
) -> DataFrame:
    """Columns ``keep``, the token ids of every whole text and, if asked for, their decoding.

    Null and empty texts have no ids and decode to the empty text.  Outputs
    replace input columns of their names.
    """
    tables = BpeTables.load(path)

    def work(part, data, offsets):
        ids, counts = encoder(tables).encode(texts_of(data, offsets))
        places = np.concatenate([[0], np.cumsum(counts)])
        lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids, pa.int32()))
        if decoded_col is None:
            return [lists]
        spans = zip(places[:-1], places[1:], strict=True)
        return [lists, pa.array([decode(ids[a:b], tables) for a, b in spans], pa.binary()).cast(pa.string())]

    out = f"`{ids_col}` array<int>" + (f", `{decoded_col}` string" if decoded_col else "")
    return map_texts(docs, keep, plain_text(text_col), out, work)


def token_digests(docs: DataFrame, path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep``, n_tokens and the SHA-256 of ids and decoded text, made where they arise."""
    tables = BpeTables.load(path)

    def work(part, data, offsets):
        ids, counts = encoder(tables).encode(texts_of(data, offsets))
        places = np.concatenate([[0], np.cumsum(counts)])
        runs = [ids[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
        return [
            pa.array(counts),
            pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in runs], pa.string()),
            pa.array([hashlib.sha256(decode(r, tables)).hexdigest() for r in runs], pa.string()),
        ]

    out = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, keep, plain_text(text_col), out, work)
