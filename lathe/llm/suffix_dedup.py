"""Operator 1: removal of repeated byte spans by a depth-limited radix sort.

Suffixes are compared only as far as the threshold (``window`` bytes), in
most-significant-digit passes that group suffixes by successively longer
fingerprinted digits; a suffix alone in its group drops out of the next pass,
and the groups left after the last pass are exactly the repeated windows:

1. *Digit one*: a ``gram``-byte minimiser.  Every window owns the leftmost
   smallest gram inside it, so equal windows own equal grams at equal offsets
   and one suffix in about ``window / 2`` has to be grouped.
2. *Digit two*: the windows that one minimiser owns are taken in runs of
   ``STEP`` offsets.  All windows of a run contain its core and lie in its
   envelope: a core met once settles that none repeats, a repeated envelope
   that all do.
3. *Digit three*: the few runs still open (at the borders of repeated regions)
   are grouped window by window on the whole threshold.

Groups are formed by Spark aggregates (partial sums before the shuffle) and
joined back by key; a key of more than ``HOT`` rows has its rows dealt over
salts, so that they never meet in one task.
Envelopes and windows use two 64-bit fingerprints together.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import WindowHash, buffers, mix64, signed, stage_table, table

STEP = 42            # offsets settled together by one core and one envelope
HOT = 10_000         # rows of one key that may meet in a task; so at most one key in HOT rows is sent to all tasks
BLOCK = 1 << 20      # window starts handled at once; texts of any length go block by block
_POS = np.uint64((1 << 22) - 1)  # a block and its margins fit


def _owners(v: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the sliding windows of ``width`` packed (rank, position) values:
    position of each minimum and the first and last window that it owns."""
    least, span = v, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    n = len(v) - width + 1
    if span < width:
        least = np.minimum(least[:n], least[width - span:width - span + n])
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change - 1, [n - 1]])
    return (least[first] & _POS).astype(np.int64), first, last


def _pieces(n: int, window: int):
    """(first start, end start, buffer begin, buffer end) of the blocks of a text."""
    for a in range(0, n - window + 1, BLOCK):
        b = min(a + BLOCK, n - window + 1)
        yield a, b, max(0, a - 2 * window), min(n, b + 3 * window)


def _minimisers(buf, a, b, lo, window, gram, hasher):
    """Minimisers of the windows starting in [a, b): fingerprint, position,
    first and last owned window, and the prefix sums of buf[lo:...]."""
    prefix = hasher.prefix(buf)
    grams = hasher.all_windows(prefix, gram)
    width = window - gram + 1
    part = grams[a - lo:b - lo + width - 1]
    v = (mix64(part) & ~_POS) | np.arange(len(part), dtype=np.uint64)
    at, first, last = _owners(v, width)
    return part[at], at + a, first + a, last + a, prefix


def _digit_one(window: int, gram: int):
    def run(batches):
        hasher = WindowHash(1)
        for batch in batches:
            k1, k2 = batch.column(0), batch.column(1)
            out, size = [], 0
            for i, buf in enumerate(buffers(batch.column(2))):
                for a, b, lo, hi in _pieces(len(buf), window):
                    h, at, _, _, _ = _minimisers(buf[lo:hi], a, b, lo, window, gram, hasher)
                    out.append((i, h, at))
                    size += len(h)
                if size >= 200_000:
                    yield _anchor_rows(out, k1, k2)
                    out, size = [], 0
            if out:
                yield _anchor_rows(out, k1, k2)
    return run


def _anchor_rows(out, k1, k2):
    row = pa.array(np.repeat([i for i, _, _ in out], [len(h) for _, h, _ in out]))
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(np.concatenate([h for _, h, _ in out]))), k1.take(row), k2.take(row),
         pa.array(np.concatenate([at for _, _, at in out]))], names=["h", "k1", "k2", "at"])


def _digit_two(window: int, gram: int):
    core_len, env_len = window - STEP + 1, window + STEP - 1

    def run(batches):
        one, two = WindowHash(1), WindowHash(2)
        for batch in batches:
            cids = batch.column(0)
            for cid, buf, keep in zip(cids.to_pylist(), buffers(batch.column(1)), batch.column(2)):
                keep = keep.values.to_numpy(zero_copy_only=False)
                for a, b, lo, hi in _pieces(len(buf), window):
                    text = buf[lo:hi]
                    _, at, first, last, p1 = _minimisers(text, a, b, lo, window, gram, one)
                    mine = np.isin(at, keep)
                    at, first, last = at[mine], first[mine], last[mine]
                    if not len(at):
                        continue
                    p2 = two.prefix(text)
                    j0, j1 = (at - last) // STEP, (at - first) // STEP
                    count = j1 - j0 + 1
                    r = np.repeat(np.arange(len(at)), count)
                    j = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count) + j0[r]
                    core = at[r] - j * STEP
                    env = core - STEP + 1
                    s_lo = np.maximum(first[r], env)
                    s_hi = np.minimum(last[r], core)
                    inside = (env >= 0) & (env + env_len <= len(buf))
                    safe = np.where(inside, env - lo, 0)
                    length = np.where(inside, env_len, 0)
                    e1, e2 = one.windows(p1, safe, length), two.windows(p2, safe, length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(r), cid)), pa.array(core), pa.array(s_lo), pa.array(s_hi),
                         pa.array(signed(one.windows(p1, core - lo, core_len))),
                         pa.array(signed(e1), mask=~inside), pa.array(signed(e2), mask=~inside)],
                        names=["cid", "core", "s_lo", "s_hi", "c1", "e1", "e2"])
    return run


def _digit_three(window: int):
    def run(batches):
        one, two = WindowHash(1), WindowHash(2)
        for batch in batches:
            for cid, buf, runs in zip(batch.column(0).to_pylist(), buffers(batch.column(1)), batch.column(2)):
                lo_s, hi_s = _ranges(runs)
                for a, b, lo, hi in _pieces(len(buf), window):
                    first, last = np.maximum(lo_s, a), np.minimum(hi_s, b - 1)
                    count = np.maximum(last - first + 1, 0)
                    if not count.sum():
                        continue
                    s = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    p1, p2 = one.prefix(buf[lo:hi]), two.prefix(buf[lo:hi])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), cid)), pa.array(s), pa.array(signed(one.windows(p1, s - lo, window))),
                         pa.array(signed(two.windows(p2, s - lo, window)))], names=["cid", "s", "w1", "w2"])
    return run


def _ranges(runs) -> tuple[np.ndarray, np.ndarray]:
    lo = runs.values.field("s_lo").to_numpy(zero_copy_only=False)
    return lo, runs.values.field("s_hi").to_numpy(zero_copy_only=False)


def _cut(window: int):
    def run(batches):
        for batch in batches:
            out = []
            for k1, k2, buf, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         buffers(batch.column(2)), batch.column(3)):
                lo, hi = _ranges(runs)
                edge = np.zeros(len(buf) + 1, np.int64)
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                step = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                out.append({"k1": k1, "k2": k2, "n_removed": int(gone.sum()), "n_spans": len(begin),
                            "kept_sha256": hashlib.sha256(buf[~gone].tobytes()).hexdigest(),
                            "spans": [{"start": int(x), "end": int(y)} for x, y in zip(begin, end)]})
            yield pa.RecordBatch.from_pylist(out, schema=_CUT)
    return run


_CUT = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _repeated(df: DataFrame, keys: list[str], place) -> DataFrame:
    """Keys met at two or more different places, and how many rows have them."""
    return (df.groupBy(*keys).agg(F.min(place).alias("_a"), F.max(place).alias("_b"), F.count("*").alias("_n"))
            .where("_a <> _b").select(*keys, "_n"))


def _join_repeated(df: DataFrame, found: DataFrame, keys: list[str], place, how: str = "inner") -> DataFrame:
    """``df`` joined with the staged (keys, _n, ...) of ``found``: rows of a hot key
    are dealt by ``place`` over as many salts as it needs, rows of a null key over many."""
    found = found.withColumn("_parts", F.ceil(F.col("_n") / HOT)).drop("_n")
    hot = F.broadcast(found.where("_parts > 1").select(*keys, "_parts"))
    salted = df.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col(keys[0]).isNull(), place).otherwise(F.coalesce(F.pmod(place, "_parts"), F.lit(0)))).drop("_parts")
    found = found.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    return salted.join(found, [*keys, "_salt"], how).drop("_salt")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 400, gram: int = 64) -> DataFrame:
    """Bytes covered by a ``window``-byte string that starts at two places.

    Returns one row per input row: id, n_bytes, n_removed, n_spans,
    kept_sha256 and ``spans`` (the maximal removed byte runs).

    Null texts count as empty; texts shorter than the window lose nothing; a
    text that occurs in several rows is removed whole (even under one id or a
    null id); a string that repeats only inside one text is removed at every
    place, overlaps included; empty tables give empty results; other columns
    are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    keyed = base.select("_id", "_t", F.xxhash64("_t").alias("k1"), F.xxhash64(F.lit(17), "_t").alias("k2"))
    long_texts = keyed.where(F.octet_length("_t") >= window).select("k1", "k2", F.col("_t").cast("binary").alias("t"))

    anchors = stage_table(long_texts.mapInArrow(_digit_one(window, gram), "h long, k1 long, k2 long, at long"),
                          "suffix-anchors")
    met = stage_table(_repeated(anchors, ["h"], F.xxhash64("k1", "k2", "at")), "suffix-grams")
    # copies of a text have the same places; rows of a staged file keep their number when a task runs again
    open_texts = _join_repeated(anchors, met, ["h"], F.monotonically_increasing_id()).groupBy("k1", "k2").agg(F.collect_set("at").alias("at"))
    # partial aggregation leaves one copy of a text per map task before the shuffle
    texts = long_texts.groupBy("k1", "k2").agg(F.first("t").alias("t"))
    cand = stage_table(texts.join(open_texts, ["k1", "k2"])
                       .withColumn("cid", F.monotonically_increasing_id()), "suffix-texts")

    runs = stage_table(cand.select("cid", "t", "at").mapInArrow(
        _digit_two(window, gram), "cid long, core long, s_lo long, s_hi long, c1 long, e1 long, e2 long"),
        "suffix-runs")
    place = F.xxhash64("cid", "core")
    cores = stage_table(_repeated(runs, ["c1"], place), "suffix-cores")
    envelopes = stage_table(_repeated(runs.where("e1 is not null"), ["e1", "e2"], place)
                            .withColumn("whole", F.lit(True)), "suffix-envelopes")
    settled = stage_table(_join_repeated(_join_repeated(runs, cores, ["c1"], place), envelopes, ["e1", "e2"], place, "left"),
                          "suffix-settled")
    undecided = settled.where("whole is null")
    # a window still open may repeat inside a settled run: one run for each envelope answers for its equals
    asked = stage_table(cores.join(undecided.select("c1").distinct(), "c1", "left_semi"), "suffix-asked")
    answers = (_join_repeated(settled.where("whole"), asked, ["c1"], place)
               .groupBy("c1", "e1", "e2", F.col("s_lo") - F.col("core"), F.col("s_hi") - F.col("core"))
               .agg(F.min(F.struct("cid", "s_lo", "s_hi")).alias("r")).select("r.*"))
    undecided = (undecided.select("cid", "s_lo", "s_hi").unionByName(answers).groupBy("cid")
                 .agg(F.collect_list(F.struct("s_lo", "s_hi")).alias("runs")))
    starts = stage_table(cand.select("cid", "t").join(undecided, "cid").select("cid", "t", "runs")
                         .mapInArrow(_digit_three(window), "cid long, s long, w1 long, w2 long"), "suffix-windows")
    same = stage_table(starts.groupBy("w1", "w2").agg(F.count("*").alias("_n")).where("_n > 1"), "suffix-same")
    hits = (_join_repeated(starts, same, ["w1", "w2"], F.xxhash64("cid", "s"))
            .select("cid", F.col("s").alias("s_lo"), F.col("s").alias("s_hi")))
    covered = (settled.where("whole").select("cid", "s_lo", "s_hi").unionByName(hits).groupBy("cid")
               .agg(F.collect_list(F.struct("s_lo", "s_hi")).alias("runs")))
    cut = (cand.select("cid", "k1", "k2", "t").join(covered, "cid").select("k1", "k2", "t", "runs")
           .mapInArrow(_cut(window), "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, "
                                     "spans array<struct<start: long, end: long>>"))

    narrow = keyed.select("_id", "k1", "k2", F.octet_length("_t").cast("long").alias("n_bytes"),
                          F.sha2(F.col("_t"), 256).alias("_sha"))
    copies = (narrow.groupBy("k1", "k2").agg(F.count("*").alias("_n")).where("_n > 1")
              .select("k1", "k2", F.lit(True).alias("_copied")))
    all_gone = F.col("_copied") & (F.col("n_bytes") >= window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start: long, end: long>>")
    return (narrow.join(copies, ["k1", "k2"], "left").join(cut, ["k1", "k2"], "left")
            .select(F.col("_id").alias(id_col), "n_bytes",
                    F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(all_gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
                    F.when(all_gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "_sha"))
                    .alias("kept_sha256"),
                    F.when(all_gone, whole).otherwise(F.coalesce("spans", none)).alias("spans")))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).drop("spans")
