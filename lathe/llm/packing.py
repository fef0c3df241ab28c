"""Operator 10: packing documents into fixed-length sequences.

Documents are tokenised and cut at multiples of the sequence length.  The
histogram of piece lengths (at most ``capacity`` counts, whatever the corpus)
goes to the driver, where shortest-pack-first places lengths, longest first:
each length joins the least filled packs that have room, a whole group of
equal packs (a pattern with a count) at a time.  Every run of equal lengths in
a pattern then owns a range of ranks of its length, and pieces find their
sequence by joining their rank within the length to those ranges.
"""

from __future__ import annotations

import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import stage_table, table
from lathe.llm.tokens import default_tokenizer, worker_tokenizer

CAPACITY = 4096
END_ID = 2


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(count, lengths) of the packing patterns of a length histogram.

    Item by item, longest first, each goes to the open pack with the most room
    (the shortest pack); equal items and equal packs are handled as counts."""
    room: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(capacity + 1)]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        space = capacity
        while left > 0:
            while space >= length and not room[space]:
                space -= 1
            if space < length:  # no pack has room: fill new ones with this length alone
                fit = capacity // length
                full, rest = divmod(left, fit)
                if full:
                    room[capacity - fit * length].append((full, (length,) * fit))
                if rest:
                    room[capacity - rest * length].append((1, (length,) * rest))
                break
            count, lengths = room[space].pop()
            taken = min(count, left)
            if count > taken:
                room[space].append((count - taken, lengths))
            room[space - length].append((taken, (*lengths, length)))
            left -= taken
    return [(count, list(lengths)) for group in room for count, lengths in group]


def slot_ranges(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset, repeats) of every
    run of equal lengths in a pattern.

    Placing a length adds at most two patterns, and the different lengths of a
    pattern sum to the capacity at most, so there are no more than
    2 * capacity * sqrt(2 * capacity) runs, whatever the corpus."""
    seen: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length, run in groupby(lengths):
            repeats, rank = len(list(run)), seen.get(length, 0)
            seen[length] = rank + count * repeats
            rows.append((length, rank, seen[length], sequence, offset, repeats))
            offset += length * repeats
        sequence += count
    return rows


def _cut_pieces(path: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        tokenizer = worker_tokenizer(path)
        for batch in batches:
            keys, rows, ids_out = [], [], []
            for i, ids in enumerate(tokenizer.encode_all(t.as_py() for t in batch.column(1))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for a in range(0, len(ids), capacity):
                    part = ids[a:a + capacity]
                    keys.append(i)
                    rows.append((a, len(part), zlib.crc32(part.tobytes()), len(ids), pid, met[len(part)]))
                    met[len(part)] += 1
                    if with_ids:
                        ids_out.append(part.astype(np.int32))
                if len(rows) >= 20_000:
                    yield _piece_rows(batch, keys, rows, ids_out, with_ids)
                    keys, rows, ids_out = [], [], []
            if rows:
                yield _piece_rows(batch, keys, rows, ids_out, with_ids)
    return run


def _piece_rows(batch, keys, rows, ids_out, with_ids):
    columns = [batch.column(0).take(pa.array(keys))]
    columns += [pa.array(x) for x in np.array(rows, np.int64).T]
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "pid", "nth"]
    if with_ids:
        columns.append(pa.array([x.tolist() for x in ids_out], pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and the ids themselves with ``with_ids``).

    A null or empty text is a piece of one token, the end id; a text longer
    than the capacity is cut into several pieces; every row is packed, also
    repeated rows and rows with a null id; pieces of equal length are
    interchangeable, so their order is that of the staged input partitions;
    an empty table gives no pieces; other columns are ignored.
    """
    path = tokenizer or default_tokenizer("word_bpe_49k.json")
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    schema = (f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, pid long, nth long"
              + (", ids array<int>" if with_ids else ""))
    # written once, so that partition numbers and ranks stay what they are
    pieces = stage_table(source.mapInArrow(_cut_pieces(path, end_id, capacity, with_ids), schema), "pack-pieces")
    counts = stage_table(pieces.groupBy("length", "pid").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges = slot_ranges(shortest_pack_first(histogram, capacity))
    slots = docs.sparkSession.createDataFrame(
        ranges, "length long, rank_from long, rank_to long, first_sequence long, first_offset long, repeats long")
    before = counts.select(
        "length", "pid", F.coalesce(F.sum("n").over(
            Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("before"))
    ranked = pieces.join(before, ["length", "pid"]).withColumn("rank", F.col("before") + F.col("nth"))
    # proven bound: see slot_ranges (741,455 rows of six longs for 4,096 tokens, far fewer in practice)
    placed = ranked.join(F.broadcast(slots), "length").where("rank >= rank_from and rank < rank_to")
    nth = F.col("rank") - F.col("rank_from")
    return placed.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.expr("(rank - rank_from) div repeats")).alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("repeats") * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
