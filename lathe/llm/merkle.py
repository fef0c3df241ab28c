"""Operator 11: a Merkle manifest of a dataset, with a proof for every row.

A row's digest is a leaf.  Within its group (a language, say) a leaf's rank in
the group's order is its place.  Every node of the group's tree carries the
interval [lo, hi) of leaf ranks that it covers, so the intervals of a tree are
nested and a node of level k lies in bucket lo / fanout**k of its level.  From
the top level down, nodes join their parent by (group, bucket of the parent's
level) and containment of the interval, and so every node gets the path of its
parent; its siblings are the nodes of the parent's interval outside its own: to
the left those that end before it starts, to the right those that start after.
The groups' subroots are the leaves of one more tree of the same kind.

Leaves are ranked by a range partition, so that a group of any size is spread
over tasks; every later key is (group, bucket), which has ``fanout`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import stage_table, table
from lathe.operators.ordering import rank_within

FANOUT = 8


def record_digest(columns: list[Column]) -> Column:
    """SHA-256 (binary) of a row's values, each ``-`` if null, else its UTF-8
    byte count, a colon and the value as text."""
    written = [c.cast("string") for c in columns]
    return _sha(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
                           for c in written]))


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    """The hex texts of an array of nodes, one after another."""
    return F.concat_ws("", F.transform(digests, lambda d: _hex(d["digest"])))


@dataclass
class Manifest:
    """``levels[k]``: the nodes of level k over all groups (group key g, size n
    of the group in leaves, lo, hi, digest, and kids above level 0: the node's
    children); ``fanout``: children a node.  Level 0 also has the carried columns."""
    levels: list[DataFrame]
    fanout: int

    def nodes(self) -> DataFrame:
        """All nodes as one table: g, level, lo, hi, digest."""
        out = None
        for k, level in enumerate(self.levels):
            rows = level.select("g", F.lit(k).alias("level"), "lo", "hi", _hex(F.col("digest")).alias("digest"))
            out = rows if out is None else out.unionByName(rows)
        return out

    def roots(self) -> DataFrame:
        """(g, digest) of every group's top node."""
        out = None
        for k, level in enumerate(self.levels):
            rows = level.where(F.col("n") <= self.fanout**k).select("g", "digest")
            out = rows if out is None else out.unionByName(rows)
        return out


def build_levels(leaves: DataFrame, order: list, fanout: int = FANOUT) -> Manifest:
    """The nodes of the trees over ``leaves`` (g, digest and any more columns),
    which ascend by ``order`` within g."""
    ranked = rank_within(leaves, ["g"], order, rank_col="hi", count_col="n")
    levels = [stage_table(ranked.withColumn("lo", F.col("hi") - 1), "merkle-0")]
    largest = levels[0].agg(F.max("n")).first()[0] or 0
    k = 0
    while fanout**k < largest:
        k += 1
        below = levels[-1].where(F.col("n") > fanout**(k - 1))
        runs = (below.groupBy("g", F.expr(f"lo div {fanout**k}").alias("bucket"))
                .agg(F.first("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                     F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids")))
        levels.append(stage_table(
            runs.select("g", "n", "lo", "hi", _sha(_joined(F.col("kids"))).alias("digest"), "kids"), f"merkle-{k}"))
    return Manifest(levels, fanout)


def attach_paths(manifest: Manifest, tops: DataFrame) -> DataFrame:
    """The leaves of ``manifest`` with ``path``: the texts (left, right) of
    their siblings' digests, level by level up to the top node, then the path
    that ``tops`` (g, path and any more columns, which also go down) has there."""
    more = [c for c in tops.columns if c not in ("g", "path")]
    above = None
    for k in range(len(manifest.levels) - 1, -1, -1):
        level, width = manifest.levels[k], manifest.fanout
        here = level.where(F.col("n") <= width**k).join(tops, "g")  # one top node a group
        if above is not None:
            up = above.select("g", F.expr(f"lo div {width**(k + 1)}").alias("up_bucket"), F.col("lo").alias("up_lo"),
                              F.col("hi").alias("up_hi"), F.col("kids").alias("run"), F.col("path").alias("up_path"), *more)
            down = (level.where(F.col("n") > width**k)
                    .withColumn("up_bucket", F.expr(f"lo div {width**(k + 1)}"))
                    .join(up, ["g", "up_bucket"]).where("lo >= up_lo and hi <= up_hi"))
            left = _joined(F.filter("run", lambda s: s["hi"] <= F.col("lo")))
            right = _joined(F.filter("run", lambda s: s["lo"] >= F.col("hi")))
            step = F.array(F.struct(left.alias("left"), right.alias("right")))
            here = here.unionByName(down.withColumn("path", F.concat(step, "up_path")).select(*here.columns))
        above = here
    return above


def merkle_proofs(docs: DataFrame, fields: list[str], group_col: str, order_col: str, fanout: int = FANOUT,
                  carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``order_col``, the carried columns (expressions over
    ``docs``), leaf, subroot and root digests (hex) and ``path`` (see above).

    Nulls in fields are told apart from empty texts; a null group comes first,
    groups then by the bytes of their text; within a group rows ascend by
    ``order_col`` (null first), rows that share it by digest, and rows that are
    equal in all fields are interchangeable; texts of any length are hashed
    whole; one row alone is its own root; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    carry = carry or {}
    group = F.col(f"`{group_col}`").cast("string")
    leaves = stage_table(docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("g"), F.col(f"`{order_col}`").alias("key"),
        record_digest([F.col(f"`{c}`") for c in fields]).alias("digest"),
        *[c.alias(f"c_{name}") for name, c in carry.items()],
        F.monotonically_increasing_id().alias("copy")), "merkle-leaves")
    groups = build_levels(leaves, ["key", "digest", "copy"], fanout)
    top = build_levels(groups.roots().select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), ["name"], fanout)
    no_path = F.expr("filter(array(named_struct('left', '', 'right', '')), s -> false)")
    ends = top.roots().select("g", no_path.alias("path"), F.col("digest").alias("root"))
    tops = attach_paths(top, ends).select(F.col("name").alias("g"), "path", "root", F.col("digest").alias("subroot"))
    found = attach_paths(groups, tops)
    return found.select(F.col("key").alias(order_col), *[F.col(f"c_{name}").alias(name) for name in carry],
                        _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                        _hex(F.col("root")).alias("root"), "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and the digests of a path give."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all sibling digests of a path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    upper = "".join(map(chr, range(65, 91)))
    lowered = F.translate("text", upper, upper.lower())
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    other = record_digest([F.col(c) for c in fields[:-1]] + [F.when(picked, lowered).otherwise(F.col("text"))])
    proofs = merkle_proofs(docs, fields, "lang", "doc_id", carry={"tampered": other})
    folded = proofs.withColumn("folded_root", fold(_hex(F.col("tampered")), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
