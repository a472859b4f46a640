"""Brute-force versions that the operators are held against, and awkward documents."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def simhash(text, words=4):
    tokens = WORD.findall(ascii_lower(text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, bits=4):
    """Smallest id reachable per row."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, i in enumerate(ids):
        r = find(k)
        least[r] = i if least.get(r) is None else (least[r] if i is None else min(i, least[r]))
    return [least[find(k)] for k in range(len(ids))]


def line_key(line):
    return ascii_lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))


def lines_kept(texts, min_docs=10):
    """(lines, dropped, text left) of every document."""
    cut = [(t or "").split("\n") for t in texts]
    held = Counter(k for lines in cut for k in {line_key(x) for x in lines} if k)
    out = []
    for lines in cut:
        stay = [x for x in lines if not line_key(x) or held[line_key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def repeats_removed(texts, length=200):
    """(bytes, removed, runs, bytes left) of every document."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def weighted_simhash(text):
    tokens = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    votes, total = [0] * 64, 0
    for i, first in enumerate(tokens):
        second = tokens[i + 1] if i + 1 < len(tokens) else None
        h = xxhash.xxh64_intdigest(first.encode(), 42)
        weight = len(first)
        if second is not None:
            h = xxhash.xxh64_intdigest(second.encode(), h)
            weight += len(second)
        weight = min(weight, 24)
        total += weight
        for b in range(64):
            votes[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


def pieces(ids, capacity=4096):
    ids = [*ids, 1]
    runs = [ids[i : i + capacity] for i in range(0, len(ids), capacity)]
    return [(p, p * capacity, len(r), zlib.crc32(np.array(r, "<u4").tobytes())) for p, r in enumerate(runs)]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


PASSAGE = "the harbour master wrote in the ledger that no vessel may leave before the tide has turned " * 3

AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b\x0c"),
    (4, "\n\n\n"),
    (5, "one"),
    (6, "Shared LINE here\nown line six\n shared line here \n"),
    (7, PASSAGE + "é ü 漢字 🙂 mixed end"),
    (8, "another start. " + PASSAGE),
    (9, PASSAGE + "é ü 漢字 🙂 mixed end"),
    (9, PASSAGE + "é ü 漢字 🙂 mixed end"),
    (10, "x" * 5000),
    (11, "%%%% $$$$ ####"),
    (12, " ".join(f"word{i % 97} of line {i}\n" for i in range(4000))),
    (13, "don't you're <|startoftext|> I'LL ΑΣΣΑΣ <|endoftext|>"),
    *((20 + i, f"Shared LINE here\nbut number {i} differs quite a lot from number {i * 7919 % 101}") for i in range(12)),
]

CLASHING = (
    "doc_id long, text string, k1 long, k2 string, body string, score string, shard int, slot long, line string, "
    "label string, ids string, length string, piece string, offset string, n_lines string, n_bytes string, root long"
)


def awkward(spark):
    """The awkward documents with columns that clash with the operators' own names."""
    rest = (5, "b", "c", "d", 1, 2, "e", "f", "g", "h", "i", "j", "k", "l", 3)
    return spark.createDataFrame([(i, t, *rest) for i, t in AWKWARD], CLASHING)


def periodic_runs(words, least=6, times=4):
    """(start, length, period) of all maximal runs, by start and period."""
    out = []
    for q in range(1, len(words) // times + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                span = words[i : i + length]
                if not any(span[p:] == span[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def with_periodic_tail(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def repetition(text, least=8):
    """Counts of one text, in the order of ``repetition.MEASURES``."""
    words = WORD.findall(text or "")
    n = len(words)
    spans = {}
    for i in range(n - least + 1):
        spans.setdefault(tuple(words[i : i + least]), []).append(i)
    held = {i + k for at in spans.values() if len(at) > 1 for i in at for k in range(least)}
    # Pairs of equal places that cannot be extended to either side give the maximal repeats.
    found = set()
    for at in spans.values():
        for x, i in enumerate(at):
            for j in at[x + 1 :]:
                if i and words[i - 1] == words[j - 1]:
                    continue
                length = least
                while j + length < n and words[i + length] == words[j + length]:
                    length += 1
                found.add(tuple(words[i : i + length]))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
        len(held), len(found), max(map(len, found), default=0),
    )


def hard_negatives(rows, positives=5, negatives=5, low=80, high=100, scale=256):
    """Rows of (id, vector, label, anchor) to (anchor, positive, rank, negative, scores)."""
    sound = [
        (i, [int(np.floor(float(x) * scale)) for x in v], lab, a, n) for n, (i, v, lab, a) in enumerate(rows)
        if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, v, lab, anchor, n in sound:
        if not anchor:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w, strict=True)), j is None, j or 0, m, other, j)
            for j, w, other, _, m in sound if len(v) == len(w)
        ]
        scored.sort(key=lambda s: s[:4])
        for p in [s for s in scored if s[4] == lab and s[3] != n][:positives]:
            window = [s for s in scored if s[4] != lab and low * -p[0] <= high * -s[0] <= high * -p[0]]
            out += [(i, p[5], r + 1, s[5], -p[0], -s[0]) for r, s in enumerate(window[:negatives])]
    return out
