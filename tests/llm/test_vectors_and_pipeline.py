"""The vector join, components and the pipeline against brute force."""

import sys
from pathlib import Path

import numpy as np
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
import reference_forms as ref

import corpus_pipeline
from tidemark.llm import bwt_merge, grid_join
from tidemark.llm.components import connected


def _vectors():
    random = np.random.default_rng(3)
    centres = random.normal(size=(40, 16))
    out = []
    for k in range(700):
        vector = centres[k % 40] + random.normal(size=16) * 0.12 * (k % 4)
        out.append((k, vector.astype(np.float32).tolist(), k % 3))
    out += [(1000 + k, out[0][1], 0) for k in range(30)]  # copies
    out += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [1.0, None] + [0.0] * 14, 0), (2003, [], 1)]
    out += [(2004, [float("nan")] * 16, 1), (2005, [float("inf")] * 16, 1), (2006, out[0][1], None), (2007, [1.0, 2.0], 0)]
    return out


def _brute(vectors, least):
    sound = [
        (i, np.array(v, float), lab) for i, v, lab in vectors
        if lab is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    ]
    links = {i: [] for i, _, _ in vectors}
    for a, (i, v, lab) in enumerate(sound):
        for j, w, other in sound[:a]:
            if lab == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                links[i].append(j)
                links[j].append(i)
    out = {}
    for i in links:
        reached, queue = {i}, [i]
        while queue:
            for j in links[queue.pop()]:
                if j not in reached:
                    reached.add(j)
                    queue.append(j)
        out[i] = (len(links[i]), min(reached))
    return out


@pytest.mark.parametrize("block", [7, 512])
def test_vectors_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(grid_join, "_BLOCK", block)
    monkeypatch.setattr(grid_join, "_LEAF", 3)
    vectors = _vectors()
    table = spark.createDataFrame([(i, v, lab, 1, 2) for i, v, lab in vectors], "vec_id long, embedding array<float>, label int, id long, links long")
    found = {r.vec_id: (r.n_links, r.component_id) for r in grid_join.near_vectors(table, 0.93).collect()}
    expected = _brute(vectors, 0.93)
    assert found == expected and max(n for n, _ in expected.values()) > 30
    assert grid_join.near_vectors(table.limit(0)).count() == 0


@pytest.mark.parametrize("least", [0.6, 0.99999, 1.0])
def test_links_are_counted_in_small_lots(spark, monkeypatch, least):
    """At any cosine, with links settled after every few and blocks cut by their bytes."""
    monkeypatch.setattr(grid_join, "_PAIRS", 5)
    monkeypatch.setattr(grid_join, "_LEAF", 8)
    monkeypatch.setattr(grid_join, "_BLOCK_BYTES", 40 * 8 * 16)
    vectors = _vectors()
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    # A cosine of equal vectors may round to less than one, so only copies are certain there.
    found = {r.vec_id: (r.n_links, r.component_id) for r in grid_join.near_vectors(table, least).collect()}
    if least < 1:
        assert found == _brute(vectors, least)
    else:
        assert found[1000][0] >= 30 and found[1000][1] == 0


def test_classes_joined_at_once():
    random = np.random.default_rng(5)
    for _ in range(50):
        n = int(random.integers(1, 40))
        i, j = random.integers(0, n, (2, int(random.integers(1, 50))))
        half = len(i) // 2
        roots = grid_join._joined_roots(np.arange(n), i[:half], j[:half])
        roots = grid_join._joined_roots(roots, i[half:], j[half:])
        expected = list(range(n))
        for _ in range(n):
            for a, b in zip(i, j, strict=True):
                expected[a] = expected[b] = min(expected[a], expected[b])
        assert roots.tolist() == expected


def test_distant_intervals_are_skipped():
    """Every pair within reach is compared, once, and far halves are not."""
    random = np.random.default_rng(6)
    points = np.sort(random.uniform(0, 50, 900)).reshape(-1, 1) * [1.0, 0.2]
    for same, others in ((True, points), (False, points[::-1] + 0.1)):
        seen = np.zeros((len(points), len(others)), int)

        def compare(a0, a1, b0, b1, seen=seen):
            seen[a0:a1, b0:b1] += 1

        grid_join._interval_join(points, others, 0.5, compare, same)
        near = np.linalg.norm(points[:, None] - others[None], axis=2) <= 0.5
        wanted = np.triu(near) if same else near
        assert seen.max() == 1 and seen[wanted].all() and seen.mean() < 0.5


def _with_repeated_ids():
    """Vectors of which some have no id, some share one, and some components have none at all."""
    vectors = [(None if k % 9 == 4 else k // 2 if k % 9 == 5 else k, v, lab) for k, v, lab in _vectors()]
    random = np.random.default_rng(8)
    for k in range(6):
        centre = random.normal(size=16)
        vectors += [(None, (centre + random.normal(size=16) * 0.02 * n).tolist(), 7 + k) for n in (0, 0, 1)]
    return [*vectors, (None, None, 0), (None, [1.0] * 16, None)]


@pytest.mark.parametrize("block", [7, 512])
def test_null_and_repeated_ids_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(grid_join, "_BLOCK", block)
    vectors = _with_repeated_ids()
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    stored = [r.embedding for r in table.collect()]
    by_row = _brute([(k, v, lab) for k, (v, (_, _, lab)) in enumerate(zip(stored, vectors, strict=True))], 0.93)
    members = {}
    for k, (_, root) in by_row.items():
        members.setdefault(root, []).append(k)
    least = {root: min((vectors[k][0] for k in of if vectors[k][0] is not None), default=None) for root, of in members.items()}
    found = grid_join.near_vectors(table, 0.93).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found) == sorted(
        (str(vectors[k][0]), links, str(least[root])) for k, (links, root) in by_row.items()
    )
    named = [r for r in found if r.component_id is not None]
    assert len(found) - len(named) > 18 and {r.kept for r in named if r.vec_id is None} == {False}
    assert all(r.kept == (r.vec_id == r.component_id) for r in named)
    # Of a component without any id one distinct vector stays, with its copies.
    linked = sorted(r.n_links for r in found if r.component_id is None and r.n_links and r.kept)
    assert 6 <= len(linked) <= 12 and all(r.kept for r in found if r.component_id is None and not r.n_links)


def test_components_of_chains_and_hubs(spark):
    chain = [(k, k + 1) for k in range(60)]
    hub = [(1000, k) for k in range(1001, 1300)]
    links = spark.createDataFrame([*chain, *hub, (5, 5), (1300, 1299), (1000, 1300)], "a long, b long")
    found = {r.node: r.root for r in connected(links).collect()}
    assert found == {k: 0 for k in range(1, 61)} | {k: 1000 for k in range(1001, 1301)} | {
        k: v for k, v in found.items() if k in (0, 1000) and v == k
    }
    assert connected(links.limit(0)).count() == 0


def test_merged_transforms_give_the_repeats():
    random = np.random.default_rng(0)
    for _ in range(80):
        length, many = int(random.choice([1, 2, 3, 6, 8, 20])), int(random.integers(1, 12))
        base = random.integers(97, 99, 60).astype(np.uint8)
        strings = []
        for _ in range(many):
            a = int(random.integers(0, 50))
            strings.append(base[a : a + int(random.integers(1, 61 - a))].copy())
            strings[-1][0] = random.integers(97, 101)
        flags = bwt_merge.repeated_starts(
            np.concatenate(strings), np.array([len(s) for s in strings]), np.ones(many, int), length, shard=int(random.integers(5, 80))
        )
        raw = [s.tobytes() for s in strings]
        seen = {}
        for r in raw:
            for p in range(len(r) - length + 1):
                seen[r[p : p + length]] = seen.get(r[p : p + length], 0) + 1
        assert flags.tolist() == [
            p + length <= len(r) and seen[r[p : p + length]] > 1 for r in raw for p in range(len(r))
        ]


def test_common_prefixes_of_merged_suffixes():
    """Places in merged order carry the number of symbols shared with the place before."""
    strings = [b"banana", b"bandana", b"ananas"]
    data = np.frombuffer(b"".join(strings), np.uint8)
    held = bwt_merge.Strings(data, np.array([len(s) for s in strings]), 1)
    order, common = bwt_merge.merge(held, 7, 4)
    suffixes = [strings[held.owner[x]][held.at[x] :] for x in order]
    for k in range(1, len(suffixes)):
        a, b = suffixes[k - 1], suffixes[k]
        shared = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert common[k] == (shared if shared < 4 else -1)


def test_pipeline_matches_brute_force(spark, tmp_path):
    """The stages after language identification, on the sample and awkward documents."""
    sample = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    docs = [(r.doc_id, r.text, r.lang) for r in sample[:120]]
    docs += [(10_000 + i, t, "en") for i, t in dict(ref.AWKWARD).items() if i != 12]
    frame = spark.createDataFrame([(i, t, lang, "src", len(t or "")) for i, t, lang in docs], "doc_id long, text string, lang string, source string, n_chars long")
    (tmp_path / "sf").mkdir()
    frame.coalesce(2).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, frame, str(tmp_path / "sf")).collect()}
    assert {i for i, t, _ in docs if not t or not any(c.isalpha() for c in t)}.isdisjoint(kept)
    assert {r.doc_id for r in sample[:120]} - kept == set()
    left = [(i, t) for i, t, _ in docs if i in kept]
    ids, texts = [i for i, _ in left], [x[2] for x in ref.lines_kept([t for _, t in left])]
    groups = ref.components([ref.simhash(t) for t in texts], ids)
    left = [(i, t) for i, t, g in zip(ids, texts, groups, strict=True) if i == g]
    texts = [x[3].decode(errors="ignore") for x in ref.repeats_removed([t for _, t in left])]
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    expected = sorted(
        (i, *p) for (i, _), t in zip(left, texts, strict=True) for p in ref.pieces(tokenizer.encode(t, add_special_tokens=False).ids)
    )
    found = corpus_pipeline.run(spark, str(tmp_path / "sf")).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    used = {}
    for r in found:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 4096


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, SMALL)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
