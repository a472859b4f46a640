"""Text operators against brute force, on awkward rows, empty tables and sample documents."""

import sys
from itertools import combinations
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
import reference_forms as ref

from tidemark.llm import bpe, golay_dedup, language_id, line_dedup, packing, quality, repeats, sharding, simhash_index
from tidemark.llm.catalog import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
IDS, TEXTS = zip(*ref.AWKWARD, strict=True)


@pytest.fixture(scope="module")
def awkward(spark):
    return ref.awkward(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return ref.awkward(spark).limit(0)


@pytest.fixture(scope="module")
def sample(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]


def by_id(df):
    return sorted(df.collect(), key=lambda r: (r[0], str(r)))


# ---- op1, op7


def test_language_of_held_out_documents(spark):
    found = QUERIES["op1_language_id"](spark, SMALL)
    langs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    held = found.where("held_out").join(langs, "doc_id").collect()
    assert np.mean([r.lang_pred == r.truth for r in held]) > 0.95
    assert found.where("rejected").count() <= 0.02 * found.count()
    assert found.where("score < 0 or score > 1").count() == 0


def test_language_of_awkward_texts(spark, awkward, empty):
    model = language_id.train_language_model(spark.read.parquet(f"{SMALL}/documents.parquet"))
    found = {r.doc_id: r for r in language_id.identify_language(awkward, model).collect()}
    for i in (1, 2, 3, 4, 11):
        assert (found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True)
    assert found[12].lang_pred in model.languages and found[12].body == "c"
    both = language_id.identify_language(awkward, model, prefix="x_")
    assert both.columns == [*awkward.columns, "x_lang_pred", "x_score", "x_rejected"]
    assert language_id.identify_language(empty, model).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id.train_language_model(nothing) is None
    assert {r.lang_pred for r in language_id.identify_language(awkward, None).collect()} == {"und"}


def test_language_carries_kept_columns_past_python(spark):
    """Texts go to Python once and do not come back: else a task holds each batch of them twice."""
    rows = [(i, f"the {i} words of a text and " * 400) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    label = F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")
    found = language_id.identify_language(docs, language_id.train_language_model(docs.withColumn("lang", label)))
    kept = found.where("rejected OR NOT rejected").select("doc_id", "text", "lang_pred")
    assert [(r.doc_id, r.text) for r in kept.collect()] == rows
    nodes, moved = [kept._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.metrics().contains("pythonDataSent"):
            moved.append([node.metrics().apply(f"pythonData{way}").value() for way in ("Sent", "Received")])
    (sent, received), texts = *moved, sum(len(t) for _, t in rows)
    assert texts <= sent < 1.5 * texts and received < 0.1 * texts


def test_every_language_is_learnt(spark):
    """Ninety labels, of which the rarest have one row and no id."""
    random = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = [["".join(random.choice(letters, 7)) for _ in range(12)] for _ in range(90)]
    docs, asked = [], []
    for k in range(90):
        for n in range(1 if k >= 85 else 3 if k >= 70 else 12):
            docs.append((None if k >= 85 else len(docs), " ".join(random.choice(words[k], 30)), f"l{k:02d}"))
        asked.append((k, " ".join(random.choice(words[k], 30))))
    labelled = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.train_language_model(labelled)
    assert model.languages == [f"l{k:02d}" for k in range(90)]
    found = language_id.identify_language(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    wrong = [r.doc_id for r in found if r.lang_pred != f"l{r.doc_id:02d}"]
    assert len(wrong) <= 2, wrong
    chosen, labels = language_id.sample_of_every_label(labelled, "lang", "doc_id", 2, 1)
    assert len(labels) == 90 and sorted(r.lang for r in chosen.collect()) == labels
    assert language_id.sample_of_every_label(labelled, "lang", "doc_id", 2, 180)[0].count() == 85 * 2 + 5


def test_language_table_ignores_position_in_batch():
    texts = [" alpha beta ", " gamma ", "  ", " delta epsilon zeta "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together, counts = language_id.subword_buckets(data, offsets, 16)
    alone = [
        language_id.subword_buckets(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), 16)[0] for t in texts
    ]
    assert counts.tolist() == [len(a) for a in alone]
    assert together.tolist() == [x for a in alone for x in a]


def test_quality_separates_the_labels(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    held = QUERIES["op7_quality"](spark, SMALL).where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert np.mean(pairs) > 0.95


def test_quality_of_awkward_texts(spark, awkward, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = quality.train_quality_model(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    found = {r.doc_id: r for r in quality.score_quality(awkward, model).collect()}
    assert found[1].score == found[2].score == found[3].score and 0 <= found[10].score <= 1
    assert found[7].score == found[9].score  # equal texts
    assert quality.score_quality(empty, model).count() == 0
    untrained = quality.train_quality_model(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score_quality(awkward, untrained).collect()} == {0.5}


# ---- op2


def _edited(texts):
    texts = [t or "" for t in texts]
    return [t[: len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][: len(t) // 2] for k, t in enumerate(texts)]


def _check_fingerprints(found, ids, texts):
    prints = [ref.weighted_simhash(t) for t in texts]
    for k, (row, text) in enumerate(zip(found, _edited(texts), strict=True)):
        assert row.n_chars == len(texts[k] or "") and row.edited_sha256 == ref.sha(text)
        assert row.fingerprint % (1 << 64) == prints[k]
        assert row.edited_fingerprint % (1 << 64) == ref.weighted_simhash(text)
        assert row.near_next == 1 - (prints[k] ^ prints[(k + 1) % len(ids)]).bit_count() / 64


def test_fingerprints_match_brute_force(spark, sample, empty):
    ids, texts = zip(*sample[:60], strict=True)
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    _check_fingerprints(by_id(simhash_index.fingerprint_with_edits(docs)), ids, texts)
    assert simhash_index.fingerprint_with_edits(empty).count() == 0


def test_fingerprints_of_awkward_texts(awkward):
    found = by_id(simhash_index.fingerprint_with_edits(awkward))
    assert len(found) == len(IDS)
    once = [k for k in range(len(IDS)) if k == 0 or IDS[k] != IDS[k - 1]]
    _check_fingerprints([found[k] for k in once], [IDS[k] for k in once], [TEXTS[k] for k in once])
    assert found[8] == found[9]


def test_block_tables_find_every_neighbour(spark):
    random = np.random.default_rng(2)
    base = random.integers(-(1 << 63), 1 << 63, 40)
    values = [int(b) ^ sum(1 << int(i) for i in random.choice(63, n, replace=False)) for b in base for n in range(7)]
    values += values[:5]
    prints = spark.createDataFrame([(v,) for v in values], "print long")
    for radius in (0, 1, 3):
        found = {r.print: r.near for r in simhash_index.count_neighbours(prints, prints, radius).collect()}
        for v in set(values):
            assert found[v] == sum(((v ^ w) % (1 << 64)).bit_count() <= radius for w in values)


def test_crowded_keys_are_kept_in_chunks(spark, monkeypatch):
    """However many prints share their leading blocks, no array holds many more than a chunk."""
    monkeypatch.setattr(simhash_index, "_CHUNK", 16)
    values = [*range(600), *range(0, 600, 7), 1 << 40, -1, -2]  # all but three share the upper blocks
    prints = spark.createDataFrame([(v,) for v in values], "print long")
    queries = spark.createDataFrame([(v,) for v in [0, 5, 5, 300, -1, 1 << 41]], "print long")
    sizes = [r.n for r in simhash_index._chunks(prints, 3).select(F.size("members").alias("n")).collect()]
    assert 16 <= max(sizes) < 48
    times = {v: values.count(v) for v in values}
    for radius in (1, 3):
        expected = {
            (q, v, n) for q in (0, 5, 300, -1, 1 << 41) for v, n in times.items()
            if ((q ^ v) & ((1 << 64) - 1)).bit_count() <= radius
        }
        found = [tuple(r) for r in simhash_index.neighbours(prints, queries, radius).collect()]
        assert len(found) == len(set(found)) and set(found) == expected


def test_search_names_the_neighbours(spark):
    random = np.random.default_rng(6)
    base = random.integers(-(1 << 63), 1 << 63, 12)
    values = [int(b) ^ sum(1 << int(i) for i in random.choice(63, n, replace=False)) for b in base for n in range(6)]
    held = [(k, v) for k, v in enumerate(values + values[:9])]
    prints = spark.createDataFrame(held, "doc_id long, print long")
    queries = prints.where("doc_id % 4 = 0 or doc_id >= 72")
    asked = {v for k, v in held if k % 4 == 0 or k >= 72}
    for radius in (0, 3):
        near = {(q, k, v) for q in asked for k, v in held if ((q ^ v) % (1 << 64)).bit_count() <= radius}
        pairs = [tuple(r) for r in simhash_index.neighbours(prints, queries, radius).collect()]
        assert sorted(pairs) == sorted((q, v, values.count(v) + values[:9].count(v)) for q, v in {(q, v) for q, _, v in near})
        members = [tuple(r) for r in simhash_index.neighbour_rows(prints, queries, radius).collect()]
        assert sorted(members) == sorted(near)
        counts = {r.print: r.near for r in simhash_index.count_neighbours(prints, queries, radius).collect()}
        assert counts == {q: sum(x[0] == q for x in near) for q in asked}


# ---- op3


def test_plan_is_complete_and_tight():
    random = np.random.default_rng(0)
    for _ in range(40):
        counts = {int(n): int(c) for n, c in zip(random.integers(1, 65, 12), random.integers(1, 40, 12), strict=True)}
        fill, ranks = {}, {}
        for length, a, b, first, per, at in packing.plan_best_fit(counts, 64):
            assert a == ranks.get(length, 0) and b > a
            ranks[length] = b
            for r in range(b - a):
                fill.setdefault(first + r // per, []).append((at + r % per * length, length))
        assert ranks == counts
        for places in fill.values():
            end = 0
            for at, length in sorted(places):
                assert at == end
                end += length
            assert end <= 64
        assert sorted(fill) == list(range(len(fill)))
        # As many sequences as best fit takes that places one piece after the other.
        rooms = []
        for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 64) - length)
        assert len(fill) == len(rooms)
    with pytest.raises(ValueError):
        packing.plan_best_fit({65: 1}, 64)
    assert packing.plan_best_fit({}, 64) == []


def test_packing_awkward_texts(awkward, empty):
    tokenizer = Tokenizer.from_file(PATH)
    found = packing.pack_documents(awkward, PATH, capacity=64, with_ids=True).collect()
    expected = sorted(
        (i, *p) for i, t in ref.AWKWARD for p in ref.pieces(tokenizer.encode(t or "", add_special_tokens=False).ids, 64)
    )
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    assert all(len(r.ids) == r.length for r in found)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        ends = np.cumsum([0] + [n for _, n in sorted(own)])
        assert [at for at, _ in sorted(own)] == ends[:-1].tolist() and ends[-1] <= 64
    assert packing.pack_documents(empty, PATH).count() == 0


def test_ranks_split_a_hot_length(spark):
    frame = spark.range(5000).select(F.lit(7).alias("length"), "id")
    frame.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/hot-length")
    ranked = packing.rank_within(spark.read.parquet(path), "length", ["id"], "r")
    assert sorted(r.r for r in ranked.collect()) == list(range(5000))


# ---- op4


def test_repeats_match_brute_force(spark, awkward, sample, empty):
    for docs, texts in ((awkward, TEXTS), (None, [t for _, t in sample[:80]])):
        if docs is None:
            docs = spark.createDataFrame(sample[:80], "doc_id long, text string")
        found = by_id(repeats.remove_repeats(docs))
        expected = sorted(
            zip(IDS if len(texts) == len(IDS) else [i for i, _ in sample[:80]], ref.repeats_removed(texts), strict=True),
            key=lambda x: x[0],
        )
        assert [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found] == [
            (i, n, gone, runs, ref.sha(left)) for i, (n, gone, runs, left) in expected
        ]
    assert repeats.remove_repeats(empty).count() == 0


def test_doubled_words_are_no_repeats(spark):
    texts = [t for n in (1024, 4096) for t in _doubled(n)] + ["start " + _doubled(2048)[0] + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs).collect()}
    expected = [(n, gone, runs, ref.sha(left)) for n, gone, runs, left in ref.repeats_removed(texts)]
    assert found == dict(enumerate(expected))


@pytest.mark.parametrize("unit", ["-", "ab", "abcdefghijklmnopqrstuvwxyz0123456789"])
def test_long_periodic_texts(spark, unit):
    """Periodic stretches give a handful of segments, however long they are."""
    long = unit * (3_000_000 // len(unit))
    data = np.frombuffer(long.encode(), np.uint8)
    folded = repeats._folded(repeats._all_segments(data, np.array([0, len(data)]), 200))
    assert len(folded["doc"]) <= 8 and int(folded["reach"].sum()) == len(data) - 199
    pick = np.random.default_rng(1).integers(97, 123, 400, dtype=np.uint8).tobytes().decode()
    texts = [long, pick + unit * 300 + pick[::-1], unit * 250 + "!", "x" * 199, unit]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs).collect()}
    small = [unit * 1000, *texts[1:]]  # the same repeats, within reach of brute force
    expected = [(n, gone, runs, ref.sha(left)) for n, gone, runs, left in ref.repeats_removed(small)]
    expected[0] = (len(long), len(long), 1, ref.sha(""))
    assert found == dict(enumerate(expected))


def test_repeats_of_crowded_anchors(spark, monkeypatch):
    """Groups are split by window offset before they are merged, with the same result."""
    monkeypatch.setattr(repeats, "_CROWD", 2)
    random = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + c) for c in random.integers(0, 26, 5))
    edges = [" ".join(word() for _ in range(30)) for _ in range(12)]
    texts = [edges[k % 12][: 20 * (k % 5)] + ref.PASSAGE + edges[(k * 5) % 12] for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(repeats.remove_repeats(docs, length=60))
    assert [(r.n_removed, r.n_spans, r.kept_sha256) for r in found] == [
        (gone, runs, ref.sha(left)) for _, gone, runs, left in ref.repeats_removed(texts, 60)
    ]


def test_long_texts_are_read_in_parts(monkeypatch):
    random = np.random.default_rng(5)
    data = random.integers(97, 100, 3000).astype(np.uint8)
    offsets = np.array([0, 1200, 1250, 3000])

    def windows(found):
        return sorted(
            (int(d), int(s) + i, int(a)) for d, s, n, a in zip(found["doc"], found["start"], found["windows"], found["anchor"], strict=True)
            for i in range(n)
        )

    whole = windows(repeats.segments(data, offsets, 100))
    monkeypatch.setattr(repeats, "_LONGEST", 500)
    assert windows(repeats._all_segments(data, offsets, 100)) == whole
    assert len(whole) == 1101 + 1651


# ---- op5


def test_golay_keys_cover_the_radius():
    lead = golay_dedup._ERRORS[:, 0]
    keys = golay_dedup.fuzzy_keys(lead)
    errors = [0, *(1 << i for i in range(23)), *(1 << i | 1 << j for i, j in combinations(range(23), 2))]
    for error in errors:
        other = golay_dedup.fuzzy_keys(lead ^ error)
        shared = (keys[:, :, None] == other[:, None, :]) & (keys[:, :, None] >= 0)
        assert shared.any((1, 2)).all()
        if error.bit_count() <= 1:  # at home with one, among the fuzzy keys of the other
            assert (other == keys[:, :1]).any(1).all()


@pytest.mark.parametrize("small_run", [0, 24])
def test_near_prints_meet(spark, monkeypatch, small_run):
    monkeypatch.setattr(golay_dedup, "_SMALL_RUN", small_run)
    random = np.random.default_rng(6)
    base = random.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = {int(b) ^ sum(1 << int(i) for i in random.choice(64, n, replace=False)) for b in base for n in (0, 1, 2, 4, 4, 5, 6)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "print long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in golay_dedup.near_links(prints).collect()]
    assert all((a ^ b).bit_count() <= 4 or small_run == 0 for a, b in links)
    expected = ref.components(values, values)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    least = {}
    for v in values:
        least[find(v)] = min(v, least.get(find(v), v))
    assert [least[find(v)] for v in values] == expected


def test_crowded_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(golay_dedup, "_HOT_SHARE", 1)
    monkeypatch.setattr(golay_dedup, "_PART", 3)
    values = [1 << i for i in range(20)] + [3 << 40 | 1 << i for i in range(10)]
    links = golay_dedup.near_links(spark.createDataFrame([(v,) for v in values], "print long"))
    found = {r.node: r.root for r in golay_dedup.connected(links).collect()}
    expected = ref.components(values, values)
    assert [found.get(v, v) for v in values] == expected


def test_near_duplicates_match_brute_force(spark, awkward, sample, empty):
    docs = spark.createDataFrame(sample, "doc_id long, text string")
    for frame, ids, texts in ((awkward, IDS, TEXTS), (docs, *zip(*sample, strict=True))):
        prints = [ref.simhash(t) for t in texts]
        expected = sorted(zip(ids, prints, ref.components(prints, ids), strict=True))
        found = [(r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in by_id(golay_dedup.near_duplicates(frame))]
        assert sorted(found) == expected
    assert golay_dedup.near_duplicates(empty).count() == 0
    kept = golay_dedup.keep_one(awkward)
    groups = {c for _, _, c in sorted(zip(IDS, TEXTS, ref.components([ref.simhash(t) for t in TEXTS], IDS), strict=True), key=str)}
    assert kept.columns == awkward.columns and sorted(r.doc_id for r in kept.collect()) == sorted(groups)


# ---- op6


def test_choose_cuts_prefers_whole_groups():
    assert sharding.choose_cuts([10, 10, 10, 10], [True] * 4, 2) == [2]
    assert sharding.choose_cuts([1000, 3, 997, 1000], [True, False, True, True], 2) == [2]
    assert sharding.choose_cuts([500, 500, 500, 500], [True, False, False, False], 2) == [2]
    assert sharding.choose_cuts([], [], 3) == [0, 0]


def test_shards_are_near_equal(spark, awkward, empty):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        # A third of all rows have one text.
        F.when(F.col("id") % 3 == 0, "same text for many rows").otherwise(
            F.repeat(F.concat(F.lit("t"), F.col("id").cast("string")), (F.col("id") % 9).cast("int") + 1)
        ).alias("text"),
    )
    found = sharding.assign_shards(docs).collect()
    assert sorted(r.doc_id for r in found) == list(range(4000))
    held, slots = {}, {}
    for r in found:
        held[r.shard] = held.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(held) == list(range(8)) and max(held.values()) - min(held.values()) < 0.02 * sum(held.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    homes = {}
    for r in found:
        homes.setdefault(r.text_hash, set()).add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 7  # the hot text and what lies at a cut
    small = sharding.assign_shards(awkward).collect()
    assert len(small) == len(IDS) and {r["size"] for r in small if r.doc_id in (1, 2)} == {1}
    assert sharding.assign_shards(empty).count() == 0


def test_shards_hold_every_row_once(spark):
    """Nulls in either column, repeated rows and ties against the plain definition."""
    rows_ = [(i % 500 if i % 3 else None, [None, "", "a", "b" * 400, f"t{i}"][i % 5]) for i in range(1500)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    found = sharding.assign_shards(docs, 4).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    import zlib

    expected = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_]
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in found), key=order) == sorted(expected, key=order)
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append((r.slot, r["size"]))
    sums = [sum(n for _, n in own) for own in slots.values()]
    assert all(sorted(k for k, _ in own) == list(range(len(own))) for own in slots.values())
    assert max(sums) - min(sums) < 0.2 * sum(sums) / 4


def test_overfull_ranges_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_SAMPLES_PER_RANGE", 1)
    monkeypatch.setattr(sharding, "_RANGES_PER_SHARD", 64)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), F.col("id").cast("string")).alias("text"))
    sizes = [r[1] for r in sharding.assign_shards(docs, 4).groupBy("shard").agg(F.sum("size")).collect()]
    assert max(sizes) - min(sizes) < 0.1 * sum(sizes) / 4


def test_written_shards(spark, awkward, lake):
    sharding.write_shards(awkward.select("doc_id", "text"), f"{lake}/shards", 3)
    back = spark.read.parquet(f"{lake}/shards")
    assert sorted((r.doc_id, r.text or "") for r in back.collect()) == sorted((i, t or "") for i, t in ref.AWKWARD)


# ---- op9


def test_lines_match_brute_force(awkward, empty):
    kept = line_dedup.drop_shared_lines(awkward)
    assert kept.columns == [c for c in awkward.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    expected = sorted((i, *x) for i, x in zip(IDS, ref.lines_kept(TEXTS), strict=True))
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in kept.collect()) == expected
    assert line_dedup.drop_shared_lines(empty).count() == 0


def test_perfect_hash_is_minimal():
    random = np.random.default_rng(8)
    for n in (0, 1, 2, 1000):
        keys = random.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
        packed = line_dedup._pack_shard(keys, np.arange(n))
        shard = line_dedup.Shard(**packed)
        assert shard.counts(keys).tolist() == list(range(n))
        assert shard.counts(random.integers(0, 1 << 63, (50, 2), dtype=np.uint64)).sum() == 0


def test_hot_lines_spread_over_copies(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("a very common line\nrare line "), F.col("id").cast("string")).alias("text")
    )
    settings = line_dedup.LineSettings(lines_per_shard=200)
    kept = line_dedup.drop_shared_lines(docs, settings=settings)
    assert {(r.n_lines, r.n_dropped) for r in kept.collect()} == {(2, 1)}
    assert kept.where("text != concat('rare line ', doc_id)").count() == 0


def test_few_documents_with_very_many_lines(spark):
    """Shards follow the lines, not the documents; every line of all but one text is shared."""
    many = 20_000
    docs = spark.range(12).select(
        F.col("id").alias("doc_id"),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(many)), lambda i: F.concat(
            F.lit("line "), F.when(F.col("id") == 11, -i).otherwise(i).cast("string"))), "\n").alias("text"),
    )
    kept = {r.doc_id: r for r in line_dedup.drop_shared_lines(docs).collect()}
    assert all((kept[i].n_dropped, kept[i].text) == (many, "") for i in range(11))
    assert (kept[11].n_lines, kept[11].n_dropped) == (many, 0)
    counts = line_dedup.line_counts(docs, "text", line_dedup.LineSettings())
    sizes = [sum(r.sizes) for r in line_dedup.build_index(counts, 20).collect()]
    assert len(sizes) == 20 and counts.count() == 2 * many


# ---- op10


def _doubled(n):
    """A Thue-Morse word of n letters and its complement: they collide modulo 2^64 for every base."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_collide_modulo_powers_of_two(spark):
    tokenizer = Tokenizer.from_file(PATH)
    texts = [t for n in (512, 1024, 2048, 8192) for t in _doubled(n)]
    texts += [" ".join(_doubled(1024)), "before " + _doubled(4096)[1] + " " + _doubled(4096)[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r.doc_id: list(r.ids) for r in bpe.encode_documents(docs, PATH, ["doc_id"]).collect()}
    assert found == {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    for text in texts:
        alone = bpe.Encoder(bpe.BpeTables.load(PATH)).encode([text])[0].tolist()
        assert alone == tokenizer.encode(text, add_special_tokens=False).ids


def test_encoding_and_decoding_match_the_library(spark, awkward, sample, empty):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.createDataFrame(sample[:80], "doc_id long, text string")
    for frame, data in ((awkward, ref.AWKWARD), (docs, sample[:80])):
        found = by_id(bpe.encode_documents(frame, PATH, ["doc_id", "text"], decoded_col="decoded"))
        for row, (i, text) in zip(found, sorted(data, key=lambda x: (x[0], str(x[1]))), strict=True):
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids
            assert (row.doc_id, row.ids) == (i, ids)
            assert row.decoded == tokenizer.decode(ids, skip_special_tokens=False)
    assert bpe.encode_documents(empty, PATH, ["doc_id"]).count() == 0


def test_code_points_and_endings_match_the_library():
    tokenizer, encoder = Tokenizer.from_file(PATH), bpe.Encoder(bpe.BpeTables.load(PATH), cached_words=500)
    points = [c for c in range(1, 0x110000, 41) if not 0xD800 <= c < 0xE000]
    random = np.random.default_rng(1)
    letters = list("abcdest'rvlm  !?.1²Σσé́İ<|>\nẞŉ")
    texts = [f"a{chr(c)}b{chr(c)}" for c in points] + ["".join(random.choice(letters, n)) for n in random.integers(0, 40, 4000)]
    texts += ["a" * 3000, "ab" * 700 + "'s", "%" * 2000]
    ids, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    for text, b, n in zip(texts, ends, counts, strict=True):
        assert ids[b - n : b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        bpe.BpeTables.load(public_tokenizers.path("byte_bpe_50k.json"))


# ---- op1 and op7 by their definitions, one text at a time


def test_quality_scores_follow_the_definition(spark, sample):
    """Tokens, pairs and the dot product in plain Python, with the hashes of one token alone."""
    import re as plain_re

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = quality.train_quality_model(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    mask, gold = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def spread(h):
        for _ in range(2):
            h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & mask
        return h ^ (h >> 32)

    def token_hash(token):
        data = np.frombuffer(token.encode(), np.uint8)
        with np.errstate(over="ignore"):
            low = quality._LOWER[data]
            return int(quality._HASH.ranges(quality._HASH.sums(low), np.array([0]), np.array([len(low)]))[0])

    def score(text):
        blank, digit = "\x09-\x0d\x20", "0-9"
        symbol = "\x00-\x08\x0e-\x1f!-/:-@\\[-`{-\x7f"
        tokens = plain_re.findall(f"[{digit}]+|[{symbol}]+|[^{blank}{digit}{symbol}]+", text or "")
        total, before = 0.0, int(quality._START)
        for token in tokens:
            h = token_hash(token)
            marked = int(quality._REPEATED) if h == before else h
            pair = marked if h == before else spread((before * gold + marked) & mask)
            for x in (spread(marked), spread(pair)):
                total += float(model.weights[x >> (64 - model.bucket_bits)])
            before = h
        logit = model.bias + model.scale * total / max(2 * len(tokens), 1)
        return 1 / (1 + np.exp(-logit))

    chosen = [(i, t) for i, t in sample if len(t or "") < 3000][:60] + [(1000, None), (1001, "a a a 1 1 ### b")]
    frame = spark.createDataFrame(chosen, "doc_id long, text string")
    found = {r.doc_id: r.score for r in quality.score_quality(frame, model).collect()}
    for i, text in chosen:
        assert found[i] == pytest.approx(score(text), abs=1e-5)


def test_language_scores_follow_the_definition(spark, sample):
    """Subwords, their mean and the softmax in plain Python, one text at a time."""
    model = language_id.train_language_model(spark.read.parquet(f"{SMALL}/documents.parquet"))

    def expected(text):
        body = (" " + (text or "").lower() + " ").encode()
        folded = [int(language_id._FOLD[b]) for b in body]
        edge, total, count = int(language_id._EDGE), np.zeros(model.scores.shape[1]), 0
        for n in language_id._LENGTHS:
            for at in range(len(folded) - n + 1):
                run = folded[at : at + n]
                if edge in run[1:-1]:
                    continue
                key = sum(b << (8 * k) for k, b in enumerate(run)) + n
                bucket = (key * int(language_id._MULTIPLIER) & ((1 << 64) - 1)) >> (64 - model.bucket_bits)
                total, count = total + model.scores[bucket], count + 1
        mean = total / max(count, 1)
        logits = ((mean if model.softmax is None else mean @ model.softmax.T) + model.bias) / model.temperature
        weights = np.exp(logits - logits.max())
        best = int(np.argmax(weights))
        return model.languages[best], float(weights[best] / weights.sum())

    chosen = [(i, t) for i, t in sample if t and 20 < len(t) < 1200][:25]
    frame = spark.createDataFrame(chosen, "doc_id long, text string")
    found = {r.doc_id: r for r in language_id.identify_language(frame, model).collect()}
    for i, text in chosen:
        language, score = expected(text)
        assert found[i].lang_pred == language and found[i].score == pytest.approx(score, abs=1e-4)


# ---- all


def test_columns_named_like_internals(spark):
    """The stages of the pipeline return every input column unchanged, whatever its name."""
    import corpus_pipeline

    names = ("__k1", "__k2", "k1", "k2", "__spans", "spans", "__gone", "gone", "row", "__rank", "__print", "__root",
             "__id", "__text", "__body", "__c0", "__o0", "print", "root", "node", "component_id", "start", "end",
             "line", "shard", "a.b", "_rank")
    texts = [(i, t) for i, t in ref.AWKWARD if i != 12] + [(60 + k, f"a text of its own, number {k} of a few") for k in range(4)]
    data = [(i, t, "en", "s", 0, *(f"{n}-{i}" for n in names)) for i, t in texts]
    fields = ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {fields}")
    for stage_ in (corpus_pipeline.line_dedup, corpus_pipeline.near_dedup, corpus_pipeline.suffix_dedup):
        kept = stage_(spark, docs, SMALL)
        assert kept.columns == docs.columns
        for r in kept.collect():
            assert [r[n] for n in names] == [f"{n}-{r.doc_id}" for n in names]




@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_hard_negatives"}))
def test_queries_return_a_row_per_document(spark, name):
    table, key = ("embeddings", "vec_id") if name.startswith("op8") else ("documents", "doc_id")
    found = QUERIES[name](spark, SMALL)
    expected = spark.read.parquet(f"{SMALL}/{table}.parquet").select(key)
    assert [r[0] for r in rows_of(found, key)] == [r[0] for r in rows_of(expected, key)]


def rows_of(df, key):
    return df.select(key).distinct().orderBy(key).collect()


def test_registered_sql_matches(spark):
    from oracle_check import connect, differences

    from tidemark.llm.catalog import ORACLES

    con = connect(SMALL)
    for name, sql in ORACLES.items():
        assert differences(QUERIES[name](spark, SMALL).toPandas(), con.execute(sql).df()) == ""
        assert rows(QUERIES[name](spark, SMALL))
