"""Operator 13: exact ranked lexical search by a sparse ball tree.

A document is a sparse vector with one component per term: the term's weight
times its saturated frequency, all integers.  An item's score is the inner
product of that vector with the item's 0/1 vector of terms.

1. Items are taken in blocks of at most ``BLOCK_ITEMS`` items and
   ``BLOCK_TERMS`` terms (an item with more is a block of its own), so what a
   block sends to the tasks is bounded.  Vectors keep the block's terms; others
   add nothing to any of its scores.
2. Documents are ordered by their two nearest of at most ``PIVOTS`` pivot
   vectors and range-partitioned by that order, equal ones by a hash of the id,
   so that a group of copies of any size is spread evenly.  Runs of ``SUBTREE``
   documents in that order become subtrees: balls are halved between two far
   documents until they hold at most ``LEAF``.
3. A ball has a centroid c, a radius (the largest distance of its documents) and
   a radius for each term (how far a document exceeds c there).  With T terms, a
   score in it is at most q.c + sqrt(T) * radius, and at most q.c plus the radii
   of the item's terms; both are rounded up, and the lesser counts.
4. The search first scores, for every item, the most promising leaf of each
   subtree.  The best scores found are a floor, and subtrees are then searched
   best ball first, as long as a bound reaches the floor or the subtree's own
   k-th score.  Leaves are scored exactly in 64-bit integers.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import WindowHash, mix64, signed, stage_table, table

BLOCK_ITEMS, BLOCK_TERMS = 1_000, 200_000
PIVOTS, SUBTREE, LEAF = 64, 2_048, 8
SLICE = 1 << 20  # bytes of text split into terms at once

_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_HASH: dict[str, WindowHash] = {}


def term_hashes(buf: np.ndarray, offsets: np.ndarray):
    """Yields (document, 64-bit term hash) arrays over the texts
    buf[offsets[i]:offsets[i + 1]]; slices end between terms."""
    hasher = _HASH.setdefault("h", WindowHash(13))
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + SLICE, end)
        while to < end:  # on to the end of the last term
            more = np.flatnonzero(~_TERM_BYTE[buf[to:to + SLICE]])
            border = offsets[np.searchsorted(offsets, to)]
            reach = to + int(more[0]) if len(more) else min(to + SLICE, end)
            if border <= reach:
                to = int(border)
                break
            to = reach
            if len(more):
                break
        part = buf[at:to]
        inside = _TERM_BYTE[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        borders = offsets[(offsets > at) & (offsets < to)] - at
        first[borders] |= inside[borders]
        last[borders - 1] |= inside[borders - 1]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(start):
            value = hasher.windows(hasher.prefix(_LOWER[part]), start, stop - start)
            yield (np.searchsorted(offsets, start + at, side="right") - 1,
                   mix64(value ^ ((stop - start).astype(np.uint64) << np.uint64(40))))
        at = to


def _texts(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow binary column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def _lists(values: np.ndarray, counts: np.ndarray, kind):
    start = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(start), pa.array(values, kind))


def _item_terms(batches):
    for batch in batches:
        buf, offsets = _texts(batch.column(1))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64)), *term_hashes(buf, offsets)]
        doc, value = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((value, doc))
        doc, value = doc[order], signed(value[order])
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (np.diff(doc) != 0) | (np.diff(value) != 0)
        counts = np.bincount(doc[fresh], minlength=len(batch))
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(value[fresh], counts, pa.int64())],
                                         names=["item", "terms"])


def _count_terms(vocabulary: np.ndarray):
    """Length, and frequencies of the vocabulary's terms, of every document."""
    def run(batches):
        for batch in batches:
            buf, offsets = _texts(batch.column(1))
            n, keys = np.zeros(len(batch), np.int64), [np.zeros(0, np.int64)]
            for doc, value in term_hashes(buf, offsets):
                n += np.bincount(doc, minlength=len(batch))
                value = signed(value)
                code = np.minimum(np.searchsorted(vocabulary, value), len(vocabulary) - 1)
                met = vocabulary[code] == value
                keys.append(doc[met] * len(vocabulary) + code[met])
            key, tf = np.unique(np.concatenate(keys), return_counts=True)
            counts = np.bincount(key // len(vocabulary), minlength=len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), _lists((key % len(vocabulary)).astype(np.int32), counts, pa.int32()),
                 _lists(tf.astype(np.int64), counts, pa.int64())], names=["id", "n", "codes", "tf"])
    return run


class Rows:
    """Sparse rows, none without an entry: row i has codes[start[i]:start[i + 1]]
    and the values there."""

    def __init__(self, start, codes, values):
        self.start, self.codes, self.values = start, codes, values

    def __len__(self):
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> "Rows":
        size = np.diff(self.start)[rows]
        start = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[rows] - start[:-1], size) + np.arange(start[-1])
        return Rows(start, self.codes[at], self.values[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner products with a dense vector, in its type."""
        return np.add.reduceat(self.values * dense[self.codes], self.start[:-1])

    def squares(self) -> np.ndarray:
        return np.add.reduceat(self.values.astype(float) ** 2, self.start[:-1])

    def dense(self, i: int, width: int) -> np.ndarray:
        out = np.zeros(width)
        part = slice(self.start[i], self.start[i + 1])
        out[self.codes[part]] = self.values[part]
        return out


def _list_rows(codes, values) -> Rows:
    start = codes.offsets.to_numpy().astype(np.int64)
    held = slice(start[0], start[-1])
    return Rows(start - start[0], codes.values.to_numpy()[held], values.values.to_numpy()[held])


def _vectors(batch, weights: np.ndarray, documents: int, total: int) -> Rows:
    """Weighted saturated frequencies, 64-bit integers."""
    rows = _list_rows(batch.column("codes"), batch.column("tf"))
    m = np.array([10 + 90 * n * documents // total for n in batch.column("n").to_pylist()], np.int64)
    tf = rows.values
    share = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(rows.start)))
    return Rows(rows.start, rows.codes, share * weights[rows.codes])


def _nearest_pivots(weights, documents, total, pivots: np.ndarray):
    """Every document with its vector and its two nearest pivots by cosine."""
    def run(batches):
        for batch in batches:
            x = _vectors(batch, weights, documents, total)
            score = np.zeros((len(batch), max(2, len(pivots))))
            for k, pivot in enumerate(pivots):
                score[:, k] = x.dot(pivot)
            near = np.argsort(-score, axis=1, kind="stable")[:, :2].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(near[:, 0]), pa.array(near[:, 1]), batch.column("codes"),
                 pa.ListArray.from_arrays(batch.column("codes").offsets, pa.array(_spread(batch, x)))],
                names=["id", "p1", "p2", "codes", "y"])
    return run


def _spread(batch, x: Rows) -> np.ndarray:
    """The values of ``x`` at the places of the batch's own list buffer."""
    offsets = batch.column("codes").offsets.to_numpy()
    out = np.zeros(int(offsets[-1]), np.int64)
    out[offsets[0]:] = x.values
    return out


class Tree:
    """Balls over sparse rows, put into an order in which each ball is a run of
    rows; ball 0 is the root, and a ball comes after its parent."""

    def __init__(self, x: Rows, leaf: int = LEAF):
        self.vocabulary, local = np.unique(x.codes, return_inverse=True)
        self.width = len(self.vocabulary)
        order, self.lo, self.hi, self.parent, self.radius = np.arange(len(x)), [], [], [], []
        codes, centre, top = [], [], []
        todo = [(0, np.arange(len(x)), -1)]
        whole = Rows(x.start, local.astype(np.int64), x.values)
        while todo:
            lo, rows, parent = todo.pop()
            part = whole.take(rows)
            order[lo:lo + len(rows)] = rows
            c = np.bincount(part.codes, weights=part.values, minlength=self.width) / len(rows)
            most = np.zeros(self.width, np.int64)
            np.maximum.at(most, part.codes, part.values)
            square = part.squares()
            norm = float(c @ c)
            away = np.maximum(square - 2 * part.dot(c) + norm, 0)
            self.lo.append(lo)
            self.hi.append(lo + len(rows))
            self.parent.append(parent)
            # rounding errors of the subtraction stay far below this margin
            self.radius.append(math.sqrt(float(away.max()) + 1e-9 * (float(square.max()) + norm)) * (1 + 1e-9))
            held = np.flatnonzero(most)
            codes.append(held)
            centre.append(c[held])
            top.append(most[held])
            if len(rows) > leaf:
                p = part.dense(int(away.argmax()), self.width)
                from_p = square - 2 * part.dot(p)
                q = part.dense(int(from_p.argmax()), self.width)
                side = np.argsort(part.dot(q) - part.dot(p), kind="stable")
                half = len(rows) // 2
                me = len(self.lo) - 1
                todo += [(lo + half, rows[side[half:]], me), (lo, rows[side[:half]], me)]
        self.order, self.rows = order, whole.take(order)
        self.balls = Rows(np.concatenate([[0], np.cumsum([len(h) for h in codes])]), np.concatenate(codes),
                          np.concatenate(centre))
        self.top = np.concatenate(top)
        self.children = [[] for _ in self.lo]
        for node, parent in enumerate(self.parent):
            if parent >= 0:
                self.children[parent].append(node)

    def bounds(self, items: "Items", chosen: np.ndarray) -> np.ndarray:
        """Upper bounds (ball, chosen item) of the scores, rounded up; a ball's
        is never above its parent's."""
        n = len(chosen)
        place = np.full(items.count, -1)
        place[chosen] = np.arange(n)
        code = self.vocabulary[self.balls.codes]
        many = items.by_term_start[code + 1] - items.by_term_start[code]
        ball = np.repeat(np.arange(len(self.lo)), np.diff(self.balls.start))
        entry = np.repeat(np.arange(len(code)), many)
        before = np.cumsum(many) - many
        item = place[items.by_term[np.repeat(items.by_term_start[code] - before, many) + np.arange(many.sum())]]
        met = item >= 0
        cell = ball[entry[met]] * n + item[met]
        size = len(self.lo) * n
        centre = np.bincount(cell, self.balls.values[entry[met]], size).reshape(-1, n)
        tops = np.bincount(cell, self.top[entry[met]].astype(float), size).reshape(-1, n)
        ball_bound = centre + np.sqrt(items.size[chosen])[None, :] * np.array(self.radius)[:, None]
        bound = np.minimum(ball_bound, tops) * (1 + 1e-9) + 1
        bound[tops == 0] = 0
        for node, parent in enumerate(self.parent):
            if parent >= 0:
                np.minimum(bound[node], bound[parent], out=bound[node])
        return bound


class Items:
    """The items of a block: a 0/1 vector over the block's vocabulary each."""

    def __init__(self, terms: list[np.ndarray], vocabulary: np.ndarray):
        self.count = len(terms)
        self.codes = [np.searchsorted(vocabulary, t) for t in terms]
        self.size = np.array([len(t) for t in terms], float)
        code = np.concatenate(self.codes)
        owner = np.repeat(np.arange(self.count), [len(c) for c in self.codes])
        self.by_term = owner[np.argsort(code, kind="stable")]
        self.by_term_start = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(vocabulary)))])
        self.vocabulary_size = len(vocabulary)


def _leaf_scores(tree: Tree, node: int, wanted: np.ndarray) -> np.ndarray:
    lo, hi = tree.lo[node], tree.hi[node]
    a, b = tree.rows.start[lo], tree.rows.start[hi]
    part = Rows(tree.rows.start[lo:hi + 1] - a, tree.rows.codes[a:b], tree.rows.values[a:b])
    return part.dot(wanted)


def search_subtree(tree: Tree, items: Items, ids: list, floor: np.ndarray, k: int, first_leaf: bool, visited: list):
    """(item, score, row) of the k best documents of each item whose score is at
    least its floor (and above 0), fewer if there are fewer.  With
    ``first_leaf`` only the most promising leaf of each item is scored."""
    place = [(i is None, i) if i is not None else (True, 0) for i in ids]
    chosen = np.arange(items.count)
    root = Tree.__new__(Tree)  # the root alone tells which items need the others
    root.vocabulary, root.lo, root.parent, root.radius = tree.vocabulary, [0], [-1], tree.radius[:1]
    one = tree.balls.start[1]
    root.balls, root.top = Rows(tree.balls.start[:2], tree.balls.codes[:one], tree.balls.values[:one]), tree.top[:one]
    reach = root.bounds(items, chosen)[0]
    chosen = chosen[(reach >= floor) & (reach > 0)]
    if not len(chosen):
        return
    bound = tree.bounds(items, chosen)
    local = np.full(items.vocabulary_size, -1)
    local[tree.vocabulary] = np.arange(tree.width)
    for column, item in enumerate(chosen):
        codes = local[items.codes[item]]
        wanted = np.zeros(tree.width, np.int64)
        wanted[codes[codes >= 0]] = 1
        best: list[tuple] = []  # (score, place reversed, row), the worst first
        open_balls = [(-bound[0, column], 0)]
        while open_balls:
            reach, node = heapq.heappop(open_balls)
            if -reach < max(floor[item], best[0][0] if len(best) == k else 1):
                break
            if tree.children[node]:
                for child in tree.children[node]:
                    heapq.heappush(open_balls, (-bound[child, column], child))
                continue
            visited[0] += tree.hi[node] - tree.lo[node]
            score = _leaf_scores(tree, node, wanted)
            least = max(1, floor[item])
            for j in np.flatnonzero(score >= least):
                row = int(tree.order[tree.lo[node] + j])
                entry = (int(score[j]), _Last(place[row]), row)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if first_leaf:
                break
        for score, _, row in best:
            yield int(item), score, row


class _Last:
    """Orders places the other way round, so that the worst entry has the
    largest id of an equal score."""
    __slots__ = ("place",)

    def __init__(self, place):
        self.place = place

    def __lt__(self, other):
        return self.place > other.place

    def __eq__(self, other):
        return self.place == other.place


def _search(items: Items, floor: np.ndarray, k: int, first_leaf: bool, id_type):
    def run(batches):
        for batch, tree in _subtrees(batches):
            ids = batch.column("id")
            visited = [0]
            found = list(search_subtree(tree, items, ids.to_pylist(), floor, k, first_leaf, visited))
            item, score, row = (np.array(x, np.int64) for x in (zip(*found) if found else ([], [], [])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(score), ids.take(pa.array(row)), pa.nulls(len(item), pa.int64())],
                names=["item", "score", "id", "scored"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, ids.type), pa.array([visited[0]])],
                names=["item", "score", "id", "scored"])
    return run


def _subtrees(batches):
    """(rows, their tree) for runs of at most ``SUBTREE`` rows of a partition."""
    held, count = [], 0
    for batch in batches:
        while len(batch):
            part = batch.slice(0, SUBTREE - count)
            batch = batch.slice(len(part))
            held.append(part)
            count += len(part)
            if count == SUBTREE:
                yield _tree(held)
                held, count = [], 0
    if held:
        yield _tree(held)


def _tree(held):
    whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return whole, Tree(_list_rows(whole.column("codes"), whole.column("y")))


def _blocks(items: DataFrame):
    """The staged items, in blocks of bounded size: lists of (item, terms)."""
    block, terms = [], 0
    for row in items.select("item", "terms").toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or terms + len(row["terms"]) > BLOCK_TERMS):
            yield block
            block, terms = [], 0
        block.append((row["item"], np.array(row["terms"], np.int64)))
        terms += len(row["terms"])
    if block:
        yield block


def _search_block(texts: DataFrame, block, k: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(item number in the block, score, id) candidates and the scored counts."""
    vocabulary = np.unique(np.concatenate([t for _, t in block]))
    id_type = texts.schema["id"].dataType.simpleString()
    if not len(vocabulary):
        return None, None
    counted = stage_table(texts.mapInArrow(
        _count_terms(vocabulary), f"id {id_type}, n long, codes array<int>, tf array<long>"), "search-terms")
    documents, total = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not documents:
        return None, None
    held = counted.select(F.explode("codes").alias("code")).groupBy("code").count().collect()  # one row a term of the block
    weights = np.zeros(len(vocabulary), np.int64)
    for row in held:
        weights[row["code"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["count"] + 1)))
    with_terms = counted.where(F.size("codes") > 0)
    # pivots only give the order that subtrees follow; copies in the sample count once
    sample = with_terms.orderBy(F.xxhash64("id", "codes"), "id").limit(4 * PIVOTS)
    drawn = sample.select("n", "codes", "tf").toArrow().combine_chunks().to_batches()
    pivots = np.zeros((0, len(vocabulary)))
    if drawn:
        x = _vectors(drawn[0], weights, documents, total)
        pivots = np.unique(np.stack([x.dense(i, len(vocabulary)) for i in range(len(x))]), axis=0)
        pivots = pivots[np.argsort(pivots.sum(axis=1), kind="stable")][::max(1, len(pivots) // PIVOTS)][:PIVOTS]
        pivots /= np.maximum(np.linalg.norm(pivots, axis=1), 1)[:, None]
    order = ["p1", "p2", "mix"]
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    placed = stage_table(
        with_terms.mapInArrow(_nearest_pivots(weights, documents, total, pivots),
                              f"id {id_type}, p1 int, p2 int, codes array<int>, y array<long>")
        .withColumn("mix", F.xxhash64("codes", "y", "id")).repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order).select("id", "codes", "y"), "search-vectors")
    items = Items([t for _, t in block], vocabulary)
    schema = f"item long, score long, id {id_type}, scored long"

    def visit(floor, first_leaf):
        run = _search(items, floor, k, first_leaf, id_type)
        return stage_table(placed.mapInArrow(run, schema), "search-found")
    nth = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").isNull(), "id")
    started = visit(np.zeros(items.count, np.int64), True)
    floor = np.zeros(items.count, np.int64)
    for row in (started.where("item is not null").withColumn("rank", F.row_number().over(nth)).where(F.col("rank") == k)
                .select("item", "score").collect()):  # one row an item of the block
        floor[row["item"]] = row["score"]
    found = visit(floor, False)
    return found.where("item is not null").select("item", "score", "id"), started.unionByName(found).select("scored")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", report: dict | None = None) -> DataFrame:
    """The ``k`` documents with the highest score above 0 of every item: item
    id, rank (from 1), document id, score.  Equal scores rank by document id, null
    last.

    A null or empty text has no terms: as a document it is not counted, as an
    item it finds nothing.  Item rows are searched one by one, also those that
    share an id or a text; repeated documents rank one after another.  Texts of
    any length are read whole; empty tables give no rows; other columns are
    ignored, whatever their names.  Document ids are of an orderable type.
    ``report`` receives "scored" and "pairs": documents scored over all items,
    and what scoring all would be.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").alias("id"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))
    name_type = items.schema[item_col].dataType.simpleString()
    asked = stage_table(
        items.select(F.col(f"`{item_col}`").alias("item"),
                     F.coalesce(F.col(f"`{item_text_col}`"), F.lit("")).cast("binary").alias("t"))
        .mapInArrow(_item_terms, f"item {name_type}, terms array<long>"), "search-items")
    out = None
    for block in _blocks(asked):
        found, scored = _search_block(texts, block, k)
        if found is None:
            continue
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)],
                                      f"item long, name {name_type}")  # at most BLOCK_ITEMS rows
        nth = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").isNull(), "id")
        best = found.withColumn("rank", F.row_number().over(nth)).where(F.col("rank") <= k).join(F.broadcast(names), "item")
        out = best if out is None else out.unionByName(best)
        if report is not None:
            report["scored"] = report.get("scored", 0) + (scored.agg(F.sum("scored")).first()[0] or 0)
            report["pairs"] = report.get("pairs", 0) + len(block) * texts.count()
    if out is None:
        id_type = docs.schema[id_col].dataType.simpleString()
        out = spark.createDataFrame([], f"name {name_type}, rank int, id {id_type}, score long")
    return out.select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
