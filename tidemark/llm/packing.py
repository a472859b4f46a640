"""Best-fit packing planned on the histogram of lengths.

Only the number of pieces of each length decides a best-fit packing, so it is
planned over counts: at most ``capacity`` lengths reach the driver, the longest
placed first, each into the open sequences of least sufficient room, whole
groups of equal sequences at a time.  The plan is a list of slots (length, rank
range, sequences, offset).  Pieces are then numbered within their length and
take the slot that holds their rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import BpeTables, encoder, texts_of
from tidemark.llm.columnar import plain_text
from tidemark.llm.rows import emit
from tidemark.session import stage

_ROWS_PER_SLICE = 20_000


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, end rank, first sequence, pieces per sequence, offset).

    The piece of rank r in [first, end) goes to sequence ``first sequence + (r - first) //
    per``, at ``offset + (r - first) % per * length``.  Every step uses up a length or a
    group of sequences with equal room, so the plan has at most about three slots a length.
    """
    rooms: list[int] = []  # ascending, those that some open sequence has
    groups: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, how many)
    slots, fresh = [], 0

    def open_group(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in groups:
                insort(rooms, room)
                groups[room] = []
            groups[room].append((first, many))

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit into 1 to {capacity}")
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first, many = capacity, fresh, -(-left // (capacity // length))
                fresh += many
            per = room // length  # best fit returns to a sequence while the length still fits
            full = min(many, left // per)
            if full:
                slots.append((length, rank, rank + full * per, first, per, capacity - room))
                open_group(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if left and full < many:
                slots.append((length, rank, rank + left, first + full, left, capacity - room))
                open_group(room - left * length, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            open_group(room, first + full, many - full)
    return slots


def rank_within(rows: DataFrame, key: str, order: list[str], rank_col: str) -> DataFrame:
    """Number the rows of each key from 0 without putting a key into one task.

    Rows are ranked in slices by a hash of ``order``; the sizes of the slices
    before give the rest.  ``rows`` must be stored: it is read three times.
    """
    slices = max(16, rows.count() // _ROWS_PER_SLICE)
    cut = rows.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    sizes = cut.groupBy(key, "__slice").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(key, "__slice", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(key, "__slice").orderBy(*order)) - 1
    ranked = cut.withColumn("__inside", inside).join(offsets, [key, "__slice"])
    return ranked.withColumn(rank_col, F.col("__before") + F.col("__inside")).drop(
        "__slice", "__inside", "__before"
    )


def pack(
    pieces: DataFrame, order: list[str], length_col: str = "length", capacity: int = 4096
) -> DataFrame:
    """``pieces`` (stored) with sequence_id and offset: few sequences of at most ``capacity``.

    ``order`` numbers pieces of equal length; rows that are equal in it are
    interchangeable.  Sequences are filled from 0 without gaps.  Lengths must lie
    between 1 and ``capacity``.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy(length_col).count().collect()}
    schema = "__length long, __from long, __to long, __first long, __per long, __at long"
    plan = spark.createDataFrame(plan_best_fit(counts, capacity), schema)
    ranked = rank_within(pieces, length_col, order, "__rank")
    step = F.col("__rank") - F.col("__from")
    # The plan is bounded by the capacity, not by the data, so every task may hold it.
    return (
        ranked.join(
            F.broadcast(plan),
            (F.col(length_col) == F.col("__length"))
            & (F.col("__rank") >= F.col("__from"))
            & (F.col("__rank") < F.col("__to")),
        )
        .withColumn("sequence_id", F.col("__first") + F.floor(step / F.col("__per")))
        .withColumn("offset", F.col("__at") + step % F.col("__per") * F.col("__length"))
        .drop("__length", "__from", "__to", "__first", "__per", "__at", "__rank")
    )


def token_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = 4096, end_id: int = 1, with_ids: bool = True,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): every document's ids and the end id, cut.

    Documents of at most ``capacity`` ids are one piece; longer ones are cut into
    pieces of ``capacity``, the last one shorter.  Null and empty texts are one
    piece that holds the end id alone.
    """
    tables = BpeTables.load(path)

    def work(part, data, offsets):
        ids, counts = encoder(tables).encode(texts_of(data, offsets))
        closed = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
        sizes = counts + 1
        pieces = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * capacity
        length = np.minimum(capacity, sizes[doc] - start)
        begin = (np.cumsum(sizes) - sizes)[doc] + start
        runs = [closed[a : a + n] for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
        out = [
            part.column(part.schema.get_field_index("__id")).take(pa.array(doc)),
            piece.astype(np.int32),
            start,
            length,
            [zlib.crc32(r.tobytes()) for r in runs],
        ]
        return [*out, [r.astype(np.int32) for r in runs]] if with_ids else out

    kind = docs.schema[id_col].dataType.simpleString()
    out = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    out += ", ids array<int>" if with_ids else ""
    return emit(docs, plain_text(text_col), out, work, {"__id": F.col(id_col)})


def pack_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = 4096, end_id: int = 1, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their sequence and place; the ids too if asked for."""
    pieces = stage(token_pieces(docs, path, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return pack(pieces, [id_col, "piece", "ids_crc32"], "length", capacity)
