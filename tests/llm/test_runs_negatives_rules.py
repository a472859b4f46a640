"""Periodic runs, hard negatives and repetition rules against brute force."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import reference_forms as ref

from tidemark.llm import hard_negatives, periodic_runs, repetition, words
from tidemark.llm.catalog import QUERIES

# Names that the operators use inside, as columns of the input.
CLASHING = "runs string, collapsed long, n_words string, kept string, __body string, __c0 long, best long, id long"
REST = ("r", 1, "n", "k", "b", 2, 3, 4)


@pytest.fixture(scope="module")
def awkward(spark):
    texts = [*ref.AWKWARD, (None, "a b a b a b a b a b"), (50, " x　 y " * 9), (51, "a " * 3000 + "b"), (51, "a " * 3000 + "b")]
    return spark.createDataFrame([(i, t, *REST) for i, t in texts], f"doc_id long, text string, {CLASHING}")


def _slice(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    return words.split_words(np.frombuffer(b"".join(raw), np.uint8), offsets)


def _random_texts(seed, many=200):
    pick = random.Random(seed)
    for _ in range(many):
        texts = []
        for _ in range(pick.randint(1, 5)):
            letters, out = "ab" if pick.random() < 0.5 else "abc", []
            while pick.random() < 0.85:
                unit = [pick.choice(letters) for _ in range(pick.randint(1, 7))]
                out += unit * pick.choice([1, 1, 2, 3, 4, 5, 9]) + unit[: pick.randint(0, len(unit))]
            texts.append(pick.choice([" ", "\n", ""]) + pick.choice([" ", "\t\x0b"]).join(out))
        yield texts


# ---- op11


def test_runs_of_random_texts():
    for texts in _random_texts(5):
        w = _slice(texts)
        found = [[] for _ in texts]
        for start, length, period in zip(*(x.tolist() for x in periodic_runs.runs(w.ids, w.doc)), strict=True):
            doc = w.doc[start]
            found[doc].append((start - w.first[doc], length, period))
        assert found == [ref.periodic_runs(ref.WORD.findall(t)) for t in texts]


def test_words_are_joined_by_text():
    for texts in _random_texts(6, 30):
        w = _slice(texts)
        keep = np.random.default_rng(len(w.ids)).random(len(w.ids)) < 0.5
        expected = [
            " ".join(x for x, k in zip(ref.WORD.findall(t), keep[a:], strict=False) if k)
            for t, a in zip(texts, w.first, strict=True)
        ]
        assert w.joined(keep) == expected


def _runs_row(doc_id, words_):
    found = ref.periodic_runs(words_)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, ref.sha(listed), ref.sha(ref.collapsed(words_, found)))


def test_runs_query_matches_brute_force(spark):
    found = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(found) == len(docs)
    planted = 0
    for row in docs:
        own = ref.with_periodic_tail(row.doc_id, ref.WORD.findall(row.text or ""))
        if len(own) <= 1200:
            assert found[row.doc_id] == _runs_row(row.doc_id, own)
            planted += own != ref.WORD.findall(row.text or "")
    assert planted > 5


def test_runs_of_awkward_texts(spark, awkward):
    found = periodic_runs.find_runs(awkward)
    assert found.columns == [c for c in awkward.columns if c not in ("runs", "collapsed")] + ["runs", "collapsed"]
    for r in found.collect():
        own = ref.WORD.findall(r.text or "")
        expected = ref.periodic_runs(own) if len(own) < 1500 else [(0, 3000, 1)] if r.doc_id == 51 else None
        if expected is not None:
            assert [(x.start, x.length, x.period) for x in r.runs] == expected
            assert r.collapsed == ref.collapsed(own, expected)
        assert (r.kept, r.best) == ("k", 3)
    assert periodic_runs.find_runs(awkward.limit(0)).count() == 0
    renamed = periodic_runs.find_runs(awkward, keep=["runs"], added=("x", "y"))
    assert renamed.columns == ["runs", "x", "y"] and {r.runs for r in renamed.collect()} == {"r"}


def test_long_periodic_text():
    w = _slice(["a b " * 200_000, "c " + "a b " * 10])
    assert [x.tolist() for x in periodic_runs.runs(w.ids, w.doc)] == [[0, 400_001], [400_000, 20], [2, 2]]


# ---- op13


def test_maximal_repeats_of_random_texts():
    for texts in _random_texts(7):
        w = _slice(texts)
        doc, length, count, _ = repetition.maximal_repeats(w, 3)
        for k, text in enumerate(texts):
            own = ref.WORD.findall(text)
            places = {}
            for i in range(len(own)):
                for j in range(i + 3, len(own) + 1):
                    places.setdefault(tuple(own[i:j]), []).append(i)
            expected = []
            for part, at in places.items():
                left = {own[i - 1] if i else None for i in at}
                right = {own[i + len(part)] if i + len(part) < len(own) else None for i in at}
                if len(at) > 1 and len(left) > 1 and len(right) > 1:
                    expected.append((len(part), len(at)))
            assert sorted(zip(length[doc == k].tolist(), count[doc == k].tolist(), strict=True)) == sorted(expected)


@pytest.mark.parametrize("least", [1, 5, 8, 11])
def test_counts_match_brute_force(spark, awkward, least):
    sample = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").where("length(text) < 4000")
    for docs in (sample, awkward.where("doc_id < 10 or doc_id > 12 or doc_id is null").where("coalesce(doc_id, 0) <> 51")):
        rows = repetition.measure_repetition(docs.select("doc_id", "text"), least=least).collect()
        if least == 1:  # the brute force takes pairs of equal words
            rows = [r for r in rows if r.n_words < 60]
        assert rows and [tuple(r[2:]) for r in rows] == [ref.repetition(r.text, least) for r in rows]


def test_rules_query(spark):
    found = QUERIES["op13_quality_rules"](spark, SMALL).collect()
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [r for r in found if labels.get(r.doc_id) == 1 and r.n_words >= 20]
    assert good and all(r.kept for r in good)


def test_verdicts_and_awkward_texts(spark, awkward):
    once = " ".join(f"w{i}" for i in range(100))
    echo = " ".join(f"w{i % 25}" for i in range(25)) + " " + once  # the first 25 words come twice
    texts = [(1, once, True), (2, "few words only", False), (3, echo, False), (4, None, False), (5, once + " w1" * 9, True)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, expected boolean")
    rows = repetition.quality_rules(docs).collect()
    assert [r.kept for r in rows] == [r.expected for r in rows]
    # An overlapping repeat covers few words more than it is long.
    tight = " ".join([*(f"v{i}" for i in range(80)), *["a"] * 24])
    own = repetition.quality_rules(spark.createDataFrame([(1, tight)], "doc_id long, text string")).first()
    assert (own.n_repeat_words, own.longest_repeat, own.base_failed, own.kept) == (24, 23, False, False)
    found = repetition.quality_rules(awkward)
    assert found.columns == [*(c for c in awkward.columns if c not in ("n_words", "kept")), *repetition.MEASURES, "base_failed", "kept"]
    by_id = {r.doc_id: r for r in found.collect()}
    assert (by_id[1].n_words, by_id[2].word_chars, by_id[3].n_symbols, by_id[1].kept) == (0, 0, 0, False)
    assert by_id[51].longest_repeat == 2999 and by_id[51].n_repeat_words == 3000
    assert repetition.quality_rules(awkward.limit(0)).count() == 0
    assert "x_kept" in repetition.quality_rules(awkward, prefix="x_").columns


# ---- op12


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 7, 5), (33, 34, 35), (70, 64, 129), (64, 0, 40), (0, 4, 9)])
def test_strassen_is_exact(shape):
    m, d, n = shape
    values = np.random.default_rng(sum(shape))
    a, b = values.integers(-(1 << 28), 1 << 28, (m, d)), values.integers(-(1 << 28), 1 << 28, (n, d))
    for leaf in (1, 4, 32):
        assert (hard_negatives.strassen(a, b, leaf) == np.einsum("ik,jk->ij", a, b)).all()


def test_heaps_merge_with_ties():
    values = np.random.default_rng(1)
    scores, usable = values.integers(0, 4, (5, 60)), values.random((5, 60)) < 0.7
    ties = np.column_stack([np.zeros(60, int), np.arange(60) // 2, np.arange(60)])
    heap = hard_negatives.Heaps(6)
    for a in range(0, 60, 13):
        heap.push(scores[:, a : a + 13], usable[:, a : a + 13], np.arange(5), ties[a : a + 13])
    for slot in range(5):
        own = sorted((-scores[slot, j], *ties[j].tolist()) for j in range(60) if usable[slot, j])[:6]
        assert [(-r[1], *r[2:]) for r in heap.rows[heap.rows[:, 0] == slot].tolist()] == own


def _vectors():
    values = np.random.default_rng(2)
    centres = values.normal(size=(4, 9))
    rows = []
    for k in range(260):
        rows.append((k, (centres[k % 4] + 0.3 * values.normal(size=9)).tolist(), k % 5 if k % 3 else 0))
    rows += [(300 + k, rows[0][1], k % 2) for k in range(40)]  # copies under two labels
    rows += [(20, rows[20][1], 0), (None, rows[0][1], 1), (None, rows[20][1], 0), (40, rows[40][1], rows[40][2])]
    rows += [(500, None, 0), (520, rows[1][1], None), (540, [1.0, None] + [0.0] * 7, 1), (560, [float("nan")] * 9, 1)]
    rows += [(580, [float("-inf")] * 9, 1), (600, [], 0), (601, [], 1), (620, [0.5, 0.25], 3), (621, [0.5, 0.25], 2), (622, [0.5, 0.3], 3)]
    return rows


@pytest.mark.parametrize("sizes", [(2048, 1024, 512), (16, 7, 3)])
def test_negatives_match_brute_force(spark, monkeypatch, sizes):
    for name, size in zip(("_GROUP", "_ROWS", "_ANCHORS"), sizes, strict=True):
        monkeypatch.setattr(hard_negatives, name, size)
    rows = _vectors()
    schema = "vec_id long, embedding array<double>, label int, key long, number long, slot string, id string"
    table = spark.createDataFrame([(*r, 1, 2, "s", "i") for r in rows], schema)
    is_anchor = F.col("vec_id") % 20 == 0
    found = [tuple(r) for r in hard_negatives.mine_negatives(table, is_anchor, scale=64).collect()]
    brute = ref.hard_negatives([(i, v, lab, i is not None and i % 20 == 0) for i, v, lab in rows], scale=64)
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(found, key=order) == sorted(brute, key=order) and len(brute) > 50
    if sizes[0] > 1000:  # labels of any type
        named = table.withColumn("label", F.concat(F.lit("l"), "label"))
        again = [tuple(r) for r in hard_negatives.mine_negatives(named, is_anchor, scale=64).collect()]
        assert sorted(again, key=order) == sorted(brute, key=order)


def test_negatives_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([(0, None, None)], [(0, [1.0], 1), (1, [1.0], 2)]):
        table = spark.createDataFrame(rows, schema)
        assert hard_negatives.mine_negatives(table, F.col("vec_id") % 100 == 0).collect() == []
    lone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (2, [1.0], 2)], schema)
    got = hard_negatives.mine_negatives(lone, F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 65536, 65536)]


def test_negatives_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    changed = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.vec_id % 100 == 0) for r in rows
    ]
    found = sorted(tuple(r) for r in QUERIES["op12_hard_negatives"](spark, SMALL).collect())
    assert found == sorted(ref.hard_negatives(changed)) and found
