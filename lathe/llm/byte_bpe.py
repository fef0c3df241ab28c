"""Operator 12: byte-level BPE encoding and decoding with the tiktoken library
and a local rank file.

A text is encoded inside a task by the library's own splitting pattern and
merges.  Long texts are handed to it in parts.  A part ends only where a
character that is not white space stands before one that is: no match of the
pattern crosses that place, and none looks beyond it, so the ids of the parts
one after another are the ids of the whole text.  The library's pattern
engine gives up on very long runs of white space; such a run is one match by
the pattern's rules (but for its last character, if other text follows) and goes
to the merges without the pattern.  Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import table

PART = 65_536       # characters after which a long text is cut at the next safe place
LONG_RUN = 4_096    # white space characters in a row that are encoded without the pattern
BATCH_BYTES = 8 << 20

# fixed values: the code points with the Unicode property White_Space
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SAFE_CUT = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")
_LONG_RUN = re.compile(f"[{_SPACE}]{{{LONG_RUN},}}")


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class Codec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken
        with open(ranks, "rb") as f:
            table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("split", pat_str=pattern, mergeable_ranks=table_, special_tokens={})
        self.merges = tiktoken.Encoding("whole", pat_str="(?s:.+)", mergeable_ranks=table_, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text of any length."""
        if len(text) <= PART and len(text) < LONG_RUN:
            return np.asarray(self.encoding.encode_ordinary(text), "<u4")
        out = []
        for part, is_match in parts(text):
            out.append(np.asarray((self.merges if is_match else self.encoding).encode_ordinary(part), "<u4"))
        return np.concatenate(out) if out else np.zeros(0, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for, whether or not they are UTF-8."""
        return self.encoding.decode_bytes(ids.tolist())


def parts(text: str, size: int = PART):
    """(part, whether it is one match of the pattern) in the text's order."""
    at = 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((p, False) for p in _cut(text, at, run.start(), size))
        yield text[run.start():end], True
        at = end
    yield from ((p, False) for p in _cut(text, at, len(text), size))


def _cut(text: str, at: int, end: int, size: int):
    while end - at > size:
        cut = _SAFE_CUT.search(text, at + size, end)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    if at < end:
        yield text[at:end]


@lru_cache(maxsize=2)
def _codec(ranks: str, pattern: str) -> Codec:
    """One codec for all tasks of a Python worker."""
    return Codec(ranks, pattern)


def _encode_batches(ranks: str, pattern: str, as_bytes: bool):
    def rows(keys, ids):
        raw = pa.array([x.tobytes() for x in ids], pa.binary())
        if not as_bytes:
            start = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            raw = pa.ListArray.from_arrays(pa.array(start), pa.array(flat))
        return pa.RecordBatch.from_arrays(
            [keys, pa.array([len(x) for x in ids], pa.int64()), raw], names=["id", "n", "ids"])

    def run(batches):
        codec = _codec(ranks, pattern)
        for batch in batches:
            ids, first, held = [], 0, 0
            for i, value in enumerate(batch.column(1)):
                ids.append(codec.encode(value.as_buffer().to_pybytes().decode("utf-8", "replace")))
                held += ids[-1].nbytes
                if held > BATCH_BYTES:
                    yield rows(batch.column(0).slice(first, len(ids)), ids)
                    ids, first, held = [], i + 1, 0
            if ids:
                yield rows(batch.column(0).slice(first, len(ids)), ids)
    return run


def _decode_batches(ranks: str, pattern: str, column: int):
    def run(batches):
        codec = _codec(ranks, pattern)
        for batch in batches:
            out = []
            for value in batch.column(column):
                if not value.is_valid:
                    out.append(None)
                elif pa.types.is_binary(value.type) or pa.types.is_large_binary(value.type):
                    out.append(codec.decode(np.frombuffer(value.as_buffer(), "<u4")))
                else:
                    out.append(codec.decode(np.asarray(value.as_py(), "<u4")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])
    return run


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
                     pattern: str | None = None, as_bytes: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens and ``ids`` (array of int, or with
    ``as_bytes`` the little-endian unsigned 32-bit numbers as binary).

    A null or empty text has no ids; bytes that are not UTF-8 are read as
    U+FFFD; a text of any length is encoded whole; repeated rows and null ids
    stay rows of their own; other columns are ignored, whatever their names; an
    empty table gives no rows.  ``ranks`` is the path of a rank file that every
    executor can open.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(f"`{id_col}`").alias("id"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))
    run = _encode_batches(ranks or default_ranks(), pattern or default_pattern(), as_bytes)
    coded = source.mapInArrow(run, f"id {kind}, n long, ids {'binary' if as_bytes else 'array<int>'}")
    return coded.select(F.col("id").alias(id_col), F.col("n").alias("n_tokens"), "ids")


def decode_documents(coded: DataFrame, ids_col: str = "ids", ranks: str | None = None,
                     pattern: str | None = None) -> DataFrame:
    """``coded`` with a column ``decoded``: the bytes of its ids (array of int,
    or binary as above), null for null ids.  An id that the rank file does not
    have fails the task.  Other columns, which may have any name but
    ``decoded``, stay."""
    held = coded.drop("decoded")
    at = held.columns.index(ids_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema] + ["decoded binary"])
    return held.mapInArrow(_decode_batches(ranks or default_ranks(), pattern or default_pattern(), at), schema)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"), as_bytes=True)
    return decode_documents(coded).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
