"""Helpers shared by the operators of this subpackage: polynomial window
fingerprints over byte buffers, vectorised word splitting, shared-folder file
access and connected components by label propagation."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.session import checkpoint_dir, stage_table

#: words are maximal runs of bytes other than these (blank, tab to carriage return)
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
_IS_WORD_BYTE = np.ones(256, bool)
_IS_WORD_BYTE[list(BLANKS)] = False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WindowHash:
    """Fingerprints of arbitrary byte windows in O(1) each after one prefix
    pass: sum of table[byte] * base**i modulo 2**64, shifted back to i = 0."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
        self.base = int(rng.integers(0, 2**62)) * 4 + 3
        self.inverse = pow(self.base, -1, 2**64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, m, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, m, 2**64))])

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        self._grow(len(buf) + 1)
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.table[buf] * self.up[:len(buf)], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        return (prefix[start + length] - prefix[start]) * self.down[start]

    def all_windows(self, prefix: np.ndarray, length: int) -> np.ndarray:
        n = len(prefix) - length
        return (prefix[length:] - prefix[:n]) * self.down[:n]


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a byte buffer."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = _IS_WORD_BYTE[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


_WORD_HASH: dict[str, WindowHash] = {}


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, 64-bit fingerprint) of every word."""
    hasher = _WORD_HASH.setdefault("w", WindowHash(11))
    start, end = word_bounds(buf)
    value = hasher.windows(hasher.prefix(buf), start, end - start)
    return start, end, mix64(value ^ ((end - start).astype(np.uint64) << np.uint64(48)))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of ``n`` consecutive word fingerprints."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k:k + m]
    return mix64(out)


def buffers(column):
    """The values of an Arrow binary column as numpy byte arrays, one by one."""
    for value in column:
        raw = value.as_buffer() if value.is_valid else None
        yield np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` as a URI that pyarrow's file
    systems open from any executor."""
    base = checkpoint_dir(spark)
    if "://" not in base and not base.startswith("file:"):
        base = f"file://{base}"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def open_folder(uri: str):
    """(pyarrow file system, path) of a folder URI."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Connected components of an undirected edge list: (id, label), label the
    smallest id of the component, for every id that has an edge.

    Each round takes the least label among an id's neighbours and then jumps to
    that label's own label, so the number of rounds grows with the logarithm of
    the longest path.  Rounds are staged in the shared folder."""
    both = stage_table(edges.select(F.col(u).alias("a"), F.col(v).alias("b"))
                       .unionByName(edges.select(F.col(v).alias("a"), F.col(u).alias("b")))
                       .where("a is not null and b is not null").distinct(), "edges")
    labels = stage_table(both.groupBy(F.col("a").alias("id"))
                         .agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.id).groupBy("a")
                .agg(F.min("label").alias("near")))
        moved = (labels.join(near, labels.id == near.a, "left")
                 .select("id", F.col("label").alias("old"),
                         F.least("label", F.coalesce("near", "label")).alias("label")))
        moved = stage_table(moved, "moved")
        jump = moved.select(F.col("id").alias("root"), F.col("label").alias("root_label"))
        after = stage_table(
            moved.join(jump, moved.label == jump.root, "left")
            .select("id", "old", F.least("label", F.coalesce("root_label", "label")).alias("label")), "labels")
        labels = after.select("id", "label")
        if after.where("old <> label").isEmpty():
            return labels
