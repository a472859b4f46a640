"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

DataFrame functions only.  A text's terms are its neighbouring word pairs (and
its last word), hashed to 64 bits; a term votes for or against every bit with
its length as weight, as longer pairs say more about a text; pairs of over 24
letters (long compounds, clauses in scripts without blanks) all weigh 24.  Votes are
summed two bits to a number, which keeps the whole count in generated code.

The search cuts fingerprints into ``radius + 3`` blocks.  Within the radius at
most ``radius`` blocks differ, so at least three agree: for every choice of three
blocks one table is keyed by them, which is about 32 bits for radius 3, and a
query looks up its own key in each table.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.columnar import plain_text
from tidemark.session import stage

_LANES = 0x100000001  # the two bits that one sum counts
_HEAVIEST = 24
_IDS_PER_SLICE = 50_000
_CHUNK = 1024  # distinct prints of a crowded key that are kept together


def terms(text: Column) -> Column:
    """Word pairs of a text in order: arrays of struct(first, second); the last has no second."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(0)))
    return F.arrays_zip(words.alias("first"), rest.alias("second"))


def fingerprint_rows(rows: DataFrame, keys: list[str], text_col: str, out: str) -> DataFrame:
    """Columns ``keys`` and the fingerprint of the text, a long; one row per distinct keys.

    A bit is set if the weight of the terms that have it is over half of all.
    Texts without a word get 0.  Rows with equal keys must have equal texts.
    """
    exploded = rows.select(*keys, F.explode_outer(terms(F.col(text_col))).alias("__term"))
    first, second = F.col("__term")["first"], F.col("__term")["second"]
    letters = F.length(first) + F.coalesce(F.length(second), F.lit(0))
    # A text without words comes as one null term, which has no vote.
    weight = F.when(first.isNotNull(), F.least(letters, F.lit(_HEAVIEST)))
    voted = exploded.select(
        *keys, F.xxhash64(first, second).alias("__hash"), weight.cast("long").alias("__weight")
    )
    sums = [
        F.sum(F.col("__weight") * F.shiftright("__hash", i).bitwiseAND(F.lit(_LANES))).alias(f"__{i}")
        for i in range(32)
    ]
    counted = voted.groupBy(*keys).agg(F.sum("__weight").alias("__all"), *sums)

    def bit(b: int) -> Column:
        lane = F.col(f"__{b % 32}")
        votes = F.shiftrightunsigned(lane, 32) if b >= 32 else lane.bitwiseAND(F.lit(0xFFFFFFFF))
        value = 1 << b if b < 63 else -(1 << 63)
        return F.when(votes * 2 > F.col("__all"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long"))

    print_ = reduce(lambda a, b: a.bitwiseOR(b), [bit(b) for b in range(64)])
    return counted.select(*keys, print_.alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def as_text(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


# ---- order of documents ----------------------------------------------------------------------


def next_documents(ids: DataFrame, id_col: str, carried: list[str]) -> DataFrame:
    """``ids`` (distinct ids) with next_<column> of the following id, the first after the last.

    Ids are range-partitioned and stored with their partition's number; only the
    first row of every partition meets in one place.  Null sorts first.
    """
    slices = max(8, ids.count() // _IDS_PER_SLICE)
    cut = stage(
        ids.repartitionByRange(slices, id_col).withColumn("__slice", F.spark_partition_id()), "ordered-ids"
    )
    row = F.struct(id_col, *carried)
    inside = Window.partitionBy("__slice").orderBy(id_col)
    heads = cut.groupBy("__slice").agg(F.min(row).alias("__head"))
    everyone = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        "__slice",
        F.coalesce(
            F.lead("__head").over(Window.orderBy("__slice")), F.first("__head").over(everyone)
        ).alias("__after"),
    )
    linked = cut.withColumn("__next", F.lead(row).over(inside)).join(after, "__slice")
    linked = linked.withColumn("__next", F.coalesce("__next", "__after"))
    return linked.select(
        id_col, *carried, *(F.col("__next")[c].alias(f"next_{c}") for c in (id_col, *carried))
    )


def fingerprint_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how alike they are.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document in ascending id.  Null texts are
    empty.  Rows that share an id all follow on to the next id, and of several
    texts under that id the one with the least hash counts; a repeated row gives
    a repeated result.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("k")
    body = plain_text(text_col)
    base = docs.select(key, F.xxhash64(body).alias("h"), body.alias("body"))
    ids = docs.select(F.col(id_col).alias("id"), key, F.xxhash64(body).alias("h"), F.length(body).alias("n"))
    ids = ids.groupBy("id", "k").agg(F.min("h").alias("h"), F.floor(F.max("n") / 2).alias("half"))
    order = stage(next_documents(ids, "id", ["k", "h", "half"]), "next-documents")
    # Joined by k alone (the hash only picks among texts under one id), so that both uses
    # of the texts are dealt alike and shuffled once; only needed heads travel again.
    heads = (
        base.join(
            order.select(F.col("k").alias("of"), "half", F.col("next_k").alias("k"), "next_h"), "k"
        )
        .where(F.col("h").bitwiseXOR(F.col("next_h")) == 0)
        .select(F.col("of").alias("k"), F.expr("substring(body, 1, cast(half as int))").alias("head"))
    )
    half = "cast(floor(n / 2) as int)"
    edited = (
        base.join(heads, "k")
        # Counted after the join: before it, the two shuffles of the texts would differ.
        .withColumn("n", F.length("body").cast("long"))
        .withColumn("edited", F.expr(f"concat(substring(body, 1, cast(n as int) - {half}), substring(head, 1, {half}))"))
        .select(
            "k", "h", "n", F.sha2("edited", 256).alias("sha"),
            F.explode(
                F.array(
                    F.struct(F.lit(False).alias("new"), F.col("body").alias("text")),
                    F.struct(F.lit(True).alias("new"), F.col("edited").alias("text")),
                )
            ).alias("t"),
        )
        .select("k", "h", "n", "sha", "t.new", "t.text")
    )
    found = fingerprint_rows(edited, ["k", "h", "n", "sha", "new"], "text", "print")
    both = found.groupBy("k", "h", "n", "sha").agg(
        F.max(F.when(~F.col("new"), F.col("print"))).alias("print"),
        F.max(F.when(F.col("new"), F.col("print"))).alias("edited"),
    )
    prints = stage(both, "fingerprints")
    following = order.select("k", F.col("next_k"), F.col("next_h")).join(
        prints.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("print").alias("following")).distinct(),
        ["next_k", "next_h"],
    )
    rows = docs.select(F.col(id_col), key, F.xxhash64(body).alias("h"))
    return (
        rows.join(prints, ["k", "h"])
        .join(following.select("k", "following"), "k")
        .select(
            id_col,
            F.col("n").alias("n_chars"),
            F.col("sha").alias("edited_sha256"),
            F.col("print").alias("fingerprint"),
            F.col("edited").alias("edited_fingerprint"),
            likeness(F.col("print"), F.col("edited")).alias("near_edited"),
            likeness(F.col("print"), F.col("following")).alias("near_next"),
        )
    )


# ---- search ---------------------------------------------------------------------------------------


def _tables(radius: int) -> list[tuple[int, list[int]]]:
    """(mask of three blocks, masks of the blocks before the third that are not among them)."""
    blocks = radius + 3
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [
        (sum(masks[i] for i in chosen), [masks[i] for i in range(chosen[-1]) if i not in chosen])
        for chosen in combinations(range(blocks), 3)
    ]


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def _keys(radius: int) -> Column:
    """The keys of column ``print`` in all tables, with the earlier blocks that must differ (``rest``)."""
    tables = _tables(radius)
    spare = max(len(rest) for _, rest in tables)
    return F.explode(F.array(*(
        F.struct(
            F.lit(t).alias("t"),
            F.col("print").bitwiseAND(_signed(mask)).alias("key"),
            F.array(*(_signed(m) for m in rest), *(F.lit(-1).cast("long") for _ in range(spare - len(rest)))).alias("rest"),
        )
        for t, (mask, rest) in enumerate(tables)
    )))


def _chunks(prints: DataFrame, radius: int) -> DataFrame:
    """(t, key, chunk, members): the distinct prints under every key, about ``_CHUNK`` to a row."""
    members = prints.groupBy("print").agg(F.count("*").alias("n"))
    filed = members.select("print", "n", _keys(radius).alias("f")).select("f.t", "f.key", "print", "n")
    crowds = filed.groupBy("t", "key").agg(F.ceil(F.count("*") / _CHUNK).alias("chunks")).where("chunks > 1")
    # Stored, so that its bytes decide whether it is broadcast; it has a row for _CHUNK filings at most.
    filed = filed.join(stage(crowds, "crowded-keys"), ["t", "key"], "left").withColumn(
        "chunk", F.pmod(F.xxhash64("print"), F.coalesce("chunks", F.lit(1)))
    )
    return filed.groupBy("t", "key", "chunk").agg(F.collect_list(F.struct("print", "n")).alias("members"))


def _found(prints: DataFrame, queries: DataFrame, radius: int) -> DataFrame:
    """(query, found): arrays of struct(print, n) within ``radius`` bits, n the rows of that print.

    Both take a long column ``print`` and are reduced to distinct values.  A crowded
    key is stored in chunks, more of them the more prints it has, and a query meets
    whole chunks, so a query has several arrays, some empty.  A pair is found in the
    table of its first three agreeing blocks only.
    """
    chunks = _chunks(prints, radius)
    asked = queries.select(F.col("print").alias("query")).distinct()
    asked = asked.select(F.col("query").alias("print")).select(
        F.col("print").alias("query"), _keys(radius).alias("f")
    ).select("query", "f.t", "f.key", "f.rest")

    def near(member: Column) -> Column:
        apart = member["print"].bitwiseXOR(F.col("query"))
        # Spare entries of ``rest`` are -1: they hold unless the prints are equal.
        first = F.forall(
            F.col("rest"), lambda m: (m == -1) | (apart.bitwiseAND(m) != 0)
        )
        return (F.bit_count(apart) <= radius) & first

    return asked.join(chunks, ["t", "key"]).select("query", F.filter("members", near).alias("found"))


def neighbours(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """(query, print, n): every fingerprint of ``prints`` within ``radius`` bits of each query.

    Both take a long column ``print``.  Pairs are between distinct values, each once,
    equal values included; n counts the rows of ``prints`` that have the value.
    """
    return _found(prints, queries, radius).select("query", F.inline("found"))


def neighbour_rows(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """``query`` and the columns of ``prints``: the rows within ``radius`` bits of each distinct query."""
    pairs = neighbours(prints.select("print"), queries, radius)
    return pairs.select("query", "print").join(prints, "print").select("query", *(f"`{c}`" for c in prints.columns))


def count_neighbours(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """(print, near): how many rows of ``prints`` lie within ``radius`` bits of each query.

    The sum of n over ``neighbours``, taken from its arrays, so a count makes no list
    of pairs.
    """
    of = F.aggregate("found", F.lit(0).cast("long"), lambda total, m: total + m["n"])
    met = _found(prints, queries, radius).select("query", of.alias("near"))
    return met.groupBy(F.col("query").alias("print")).agg(F.sum("near").alias("near"))
