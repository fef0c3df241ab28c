"""Operator 3: token counts of documents in flat token files without an index.

A file is nothing but little-endian 16-bit ids, documents one after another,
each closed by the end-of-document id.  Tasks read blocks of a file and search
them for the separator with one vectorised comparison; a block knows how many
separators it has, where they are, and nothing of its neighbours.  A prefix
scan over the blocks' summaries (separators so far, place of the last one)
gives every block the number of its first document and that document's start,
which stitches documents that cross blocks.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import open_folder, shared_folder, table
from lathe.llm.tokens import default_tokenizer, worker_tokenizer

END_ID = 49407       # <|endoftext|> of the default vocabulary
BLOCK_IDS = 1 << 20
DTYPE = np.dtype("<u2")


def _write(folder: str, path: str, end_id: int):
    def run(batches):
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        name = f"part-{uuid.uuid4().hex}.ids"  # one of its own for every attempt
        tokenizer = worker_tokenizer(path, special_as_text=True)
        nth = 0
        with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in batches:
                for ids in tokenizer.encode_all(t.as_py() for t in batch.column(1)):
                    ids = np.append(ids, np.uint32(end_id))
                    if ids.max() > np.iinfo(DTYPE).max:
                        raise ValueError("the vocabulary does not fit 16-bit ids")
                    out.write(ids.astype(DTYPE).tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(np.arange(nth, nth + n)), batch.column(0)],
                    names=["file", "nth", "id"])
                nth += n
    return run


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the files; returns their documents as (file, nth, id) rows, which
    name the files of successful tasks only."""
    path = tokenizer or default_tokenizer("word_bpe_49k.json")
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(f"`{id_col}`").alias("id"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))
    return source.mapInArrow(_write(folder, path, end_id), f"file string, nth long, id {id_type}")


def _sizes(folder: str):
    def run(batches):
        fs, base = open_folder(folder)
        for batch in batches:
            names = batch.column(0).to_pylist()
            sizes = [x.size // DTYPE.itemsize for x in fs.get_file_info([f"{base}/{n}" for n in names])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["file", "n_ids"])
    return run


def _scan(folder: str, end_id: int):
    def run(batches):
        fs, base = open_folder(folder)
        for batch in batches:
            for file, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(f"{base}/{file}") as stream:
                    ids = np.frombuffer(stream.read_at((end - start) * DTYPE.itemsize, start * DTYPE.itemsize), DTYPE)
                at = np.flatnonzero(ids == end_id) + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([start]), pa.array([end]), pa.array([len(at)]),
                     pa.array([int(at[-1]) if len(at) else None], pa.int64()), pa.array([at], pa.list_(pa.int64()))],
                    names=["file", "start", "end", "n", "last", "at"])
    return run


def count_tokens(files: DataFrame, folder: str, end_id: int = END_ID, block: int = BLOCK_IDS) -> DataFrame:
    """(file, nth, n_tokens) of every document in the files of a ``file``
    column, separators not counted.  Ids after the last separator are a
    document if there are any; empty files have none."""
    sized = files.select("file").distinct().mapInArrow(_sizes(folder), "file string, n_ids long").where("n_ids > 0")
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    blocks = (sized.withColumn("start", F.explode(F.expr(f"sequence(0L, n_ids - 1, {block}L)")))
              .select("file", "start", F.least(F.col("start") + block, "n_ids").alias("end")))
    found = blocks.repartition(tasks, "file", "start").mapInArrow(
        _scan(folder, end_id), "file string, start long, end long, n long, last long, at array<long>")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    following = Window.partitionBy("file").orderBy("start").rowsBetween(1, Window.unboundedFollowing)
    scanned = found.withColumns({
        "first": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        "open": F.coalesce(F.max("last").over(earlier) + 1, F.lit(0)),
        "is_last": F.count("*").over(following) == 0})
    tail = F.when(F.col("is_last") & (F.coalesce(F.col("last") + 1, F.col("open")) < F.col("end")),
                  F.array("end")).otherwise(F.array().cast("array<long>"))
    ends = scanned.select("file", "first", F.concat(F.array(F.col("open") - 1), "at", tail).alias("at"))
    pairs = F.transform(F.slice("at", F.lit(2), F.size("at") - 1), lambda x, i: x - F.element_at("at", i + 1) - 1)
    return ends.select("file", "first", F.posexplode(pairs).alias("k", "n_tokens")).select(
        "file", (F.col("first") + F.col("k")).alias("nth"), "n_tokens")


def document_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per input row: id and n_tokens.

    A null or empty text has 0 tokens; null ids and repeated rows are counted
    row by row; the separator's own text inside a document is ordinary text;
    texts of any length cross blocks freely; an empty table gives no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    folder, listing = shared_folder(spark, "tokens"), shared_folder(spark, "tokens-list")
    write_tokens(docs, folder, id_col, text_col, tokenizer, end_id).write.parquet(listing)
    named = spark.read.parquet(listing)
    return (named.join(count_tokens(named, folder, end_id), ["file", "nth"])
            .select(F.col("id").alias(id_col), "n_tokens"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_token_counts(table(spark, sf_dir, "documents"))
