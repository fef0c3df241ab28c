"""Operator 2: deletion of repeated runs of lines.

Units are lines that hold a word, with outer blanks left out.  A run counts as
repeated from ``min_lines`` consecutive lines on, or as fewer lines that have
``min_words`` words together (``joint``; without it only as one such line).  Every
such run is a window, and windows are grouped whole by a 128-bit hash of their
lines; those whose text was met at an earlier position are deleted, and unions
of such windows are the runs.  Nothing is selected or extended as in
winnowing: the least hash of a ``gram`` of lines in a window is only a filter
before the grouping, which would give the same rows without it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from lathe.llm.common import BLANKS, mix64, signed, stage_table, table

MIN_LINES = 3
GRAM = 2
MIN_WORDS = 50
#: rows whose windows or texts are held in Python at once; a worker keeps the memory
#: of its largest batch
BATCH_ROWS = 500


def _small(batches):
    """The batches in slices of at most ``BATCH_ROWS`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _line_hash(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def _fingerprints(min_lines: int, gram: int, min_words: int, joint: bool):
    width = min_lines - gram + 1

    def run(batches):
        for batch in _small(batches):
            rows, out = [], []
            for i, text in enumerate(batch.column(2)):
                lines = [s for s in (x.strip(BLANKS) for x in (text.as_py() or b"").split(b"\n")) if s]
                both = b"".join(map(_line_hash, lines))
                half = np.frombuffer(both, "<u8").reshape(-1, 2)
                for k, line in enumerate(lines):
                    if len(line) >= 2 * min_words - 1 and len(line.split()) >= min_words:
                        fp, key = half[k, 0], half[k]
                        rows.append(i)
                        out.append((np.array([fp]), key[:1], key[1:], np.array([k]), np.array([1])))
                total = np.cumsum([0] + [len(x.split()) for x in lines]) if joint else None
                for size in range(2, min(min_lines, len(lines) + 1)) if joint else ():
                    at = np.flatnonzero(total[size:] - total[:-size] >= min_words)
                    one, two = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
                    for j in range(size):
                        one, two = mix64(one ^ half[at + j, 0]), mix64(two ^ half[at + j, 1])
                    rows.append(i)
                    out.append((one, one, two, at, np.full(len(at), size)))
                n = len(lines) - min_lines + 1
                if n <= 0:
                    continue
                grams = np.zeros(len(lines) - gram + 1, np.uint64)
                one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                for j in range(gram):
                    grams = mix64(grams ^ half[j:j + len(grams), 0])
                for j in range(min_lines):
                    one, two = mix64(one ^ half[j:j + n, 0]), mix64(two ^ half[j:j + n, 1])
                least = np.lib.stride_tricks.sliding_window_view(grams, width).min(axis=1)
                rows.append(i)
                out.append((least, one, two, np.arange(n), np.full(n, min_lines)))
            if rows:
                at = pa.array(np.repeat(rows, [len(x[0]) for x in out]))
                parts = [np.concatenate(x) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(signed(x)) for x in parts[:3]],
                     *[pa.array(x.astype(np.int64)) for x in parts[3:]]],
                    names=["id", "th", "fp", "w1", "w2", "at", "size"])
    return run


def _without(batches):
    """Texts without the lines of their spans; lines without a word stay."""
    for batch in _small(batches):
        texts, counts, gone = [], [], []
        for text, spans in zip(batch.column("_t"), batch.column("_spans")):
            value = text.as_py()
            lines = (value or "").split("\n")
            real = [k for k, x in enumerate(lines) if x.encode().strip(BLANKS)]
            drop = set()
            for span in spans.as_py() or ():
                drop.update(real[span["at"]:span["at"] + span["size"]])
            texts.append(value if not drop else "\n".join(x for k, x in enumerate(lines) if k not in drop))
            counts.append(len(real))
            gone.append(len(drop))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
             pa.array(gone, pa.int64())], names=["_row", "_text", "n_lines", "n_removed"])


def repeated_line_windows(docs: DataFrame, id_col: str, text_col: str, min_lines: int = MIN_LINES, gram: int = GRAM,
                          min_words: int = MIN_WORDS, joint: bool = True) -> DataFrame:
    """(id, th, at, size) of the windows of lines that stand at an earlier
    position, ordered by id, text hash and line number."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("th"),
                         F.col(f"`{text_col}`").cast("binary").alias("t"))
    id_type = docs.schema[id_col].dataType.simpleString()
    marks = stage_table(source.mapInArrow(
        _fingerprints(min_lines, gram, min_words, joint),
        f"id {id_type}, th long, fp long, w1 long, w2 long, at long, size long"), "line-marks")
    met = marks.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "th", "at")
    matched = marks.join(met, "fp").select("id", "th", "at", "size", "w1", "w2", place.alias("place"))
    first = (matched.groupBy("w1", "w2", "size").agg(F.min("place").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("w1", "w2", "size", "first"))
    return (matched.join(first, ["w1", "w2", "size"]).where("place > first").select("id", "th", "at", "size"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from the text, and
    the columns n_lines (lines with a word) and n_removed.

    The first position of a run, by id (null last), text and line, keeps it; a
    text without deletions comes back unchanged, null as null; blank lines stay
    and don't part a run; rows that share id and text are one position, so
    copies under one id are not deleted from each other; a document may end up
    empty; long texts are read whole; an empty table gives no rows.  Columns
    named n_lines or n_removed are replaced.
    """
    windows = repeated_line_windows(docs, id_col, text_col, **limits)
    spans = (windows.groupBy("id", "th").agg(F.collect_set(F.struct("at", "size")).alias("_spans"))
             .select(F.col("id").alias("_id"), F.col("th").alias("_th"), "_spans"))
    others = [c for c in docs.columns if c != text_col]
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"), F.col(f"`{text_col}`").alias("_t"),
                        F.col(f"`{id_col}`").alias("_key"), F.xxhash64(f"`{text_col}`").alias("_h"))
    joined = boxed.join(spans, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th")), "left")
    schema = (StructType().add("_row", boxed.schema["_row"].dataType).add("_text", StringType())
              .add("n_lines", LongType()).add("n_removed", LongType()))
    out = joined.select("_row", "_t", "_spans").mapInArrow(_without, schema)
    kept = [F.col("_text").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c)
            for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*kept, "n_lines", "n_removed")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(2 * BATCH_ROWS))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))
