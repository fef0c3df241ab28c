"""Merkle manifest, byte-level BPE and ranked lexical search against
brute-force versions, on nulls, empty and long texts, ties, repeated rows,
empty tables and clashing names."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def parquet_dir(tmp_path, **tables):
    for name, df in tables.items():
        df.coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# -- Merkle manifest --------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(leaves):
    """(root, sibling texts (left, right) per level of every leaf)."""
    paths, level, own = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, at in enumerate(own):
            run = level[at // 8 * 8:at // 8 * 8 + 8]
            paths[i].append(("".join(run[:at % 8]), "".join(run[at % 8 + 1:])))
        level = [sha("".join(level[a:a + 8])) for a in range(0, len(level), 8)]
        own = [at // 8 for at in own]
    return level[0], paths


def brute_merkle(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang),
                      key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf_of(r, r[1]))))
        trees[lang] = (mine, *tree([leaf_of(r, r[1]) for r in mine]))
    root, tops = tree([trees[x][1] for x in langs])
    out = Counter()
    for lang, top in zip(langs, tops):
        mine, subroot, paths = trees[lang]
        for r, path in zip(mine, paths):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            at = leaf_of(r, text)
            for left, right in path + top:
                at = sha(left + at + right)
            proof = sha("".join(a + b for a, b in path + top))
            out[(r[0], leaf_of(r, r[1]), subroot, root, proof, at, at == root)] += 1
    return out


def merkle_rows():
    rng = random.Random(7)
    rows = [(i, f"Text {i} É {rng.random()}", rng.choice(["en", "en", "en", "de", None, ""]), f"s{i % 3}", i)
            for i in range(300)]
    rows += [(400 + i, f"Alone {i}", f"l{i}", None, None) for i in range(9)]  # more than eight groups
    rows += [(None, "No id", "en", None, 3), (None, "no id either", "en", None, 3), (None, None, "en", None, None),
             (7, "Other", "en", None, 1), (7, "Same", "fr", "s", 1), (7, "Same", "fr", "s", 1), (500, "", "fr", "", 0),
             (501, "Ab " * 60_000, "fr", None, 1)]
    return rows


def test_merkle(spark, tmp_path):
    from lathe.llm.merkle import op11_merkle
    docs = spark.createDataFrame(merkle_rows(), DOCS).repartition(5)
    clash = docs.selectExpr("*", "1 AS g", "2 AS lo", "3 AS hi", "4 AS path", "5 AS digest", "6 AS copy", "7 AS key")
    got = Counter(tuple(r) for r in op11_merkle(spark, parquet_dir(tmp_path, documents=clash)).collect())
    want = brute_merkle(merkle_rows())
    assert got == want
    assert {k[6] for k in want} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65])
def test_merkle_sizes(spark, tmp_path, n):
    from lathe.llm.merkle import op11_merkle
    rows = [(i, f"T{i}", "en", "s", i) for i in range(n)]
    got = Counter(tuple(r) for r in op11_merkle(spark, parquet_dir(tmp_path, documents=spark.createDataFrame(rows, DOCS)))
                  .collect())
    assert got == (brute_merkle(rows) if n else Counter())


# -- byte-level BPE ---------------------------------------------------------

def bpe_texts():
    rng = random.Random(3)
    mixed = "".join(rng.choice(["word", "Ünï", " ", "  ", "\n", "\t\n ", "'s", "'", "12", "!?", "日本", " ", " ", "x'll "])
                    for _ in range(60_000))
    return [None, "", " ", "hello world", "it's  3 o'clock\n\n", mixed, " " * 9_000, " " * 9_000 + "end", "a" + "\n" * 8_000 + " b",
            "a" * 200_000, "ab " * 50_000, "　" * 5_000 + "x", "hello world", "<|endoftext|>", "é\u0000 \U0001f600"]


def test_byte_bpe(spark, tmp_path):
    import tiktoken
    from lathe.llm.byte_bpe import default_pattern, default_ranks, op12_byte_bpe
    with open(default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=default_pattern(), mergeable_ranks=ranks, special_tokens={})
    rows = [(i if i % 5 else None, t, None, None, None) for i, t in enumerate(bpe_texts())]
    want = Counter()
    for r in rows:
        ids = np.array(plain.encode_ordinary(r[1] or ""), "<u4").tobytes()
        want[(r[0], len(ids) // 4, hashlib.sha256(ids).hexdigest(), sha(r[1] or ""))] += 1
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS id", "2 AS n", "3 AS ids", "4 AS decoded", "5 AS t")
    got = Counter(tuple(r) for r in op12_byte_bpe(spark, parquet_dir(tmp_path, documents=docs)).collect())
    assert got == want


def test_byte_bpe_long_runs(spark):
    """A run of white space that the library alone refuses, and ids as an array."""
    from lathe.llm.byte_bpe import decode_documents, encode_documents, parts
    text = "a " + " " * 3_000_000 + "b" + "\n" * 2_000_000
    assert "".join(p for p, _ in parts(text)) == text
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    back = decode_documents(encode_documents(docs)).first()
    assert bytes(back["decoded"]) == text.encode() and len(back["ids"]) == back["n_tokens"]
    none = decode_documents(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first()
    assert none["decoded"] is None
    assert encode_documents(empty(spark)).count() == 0


def test_byte_bpe_cuts():
    """Every cut of a long text is safe: parts give the ids of the whole."""
    from lathe.llm import byte_bpe
    codec = byte_bpe._codec(byte_bpe.default_ranks(), byte_bpe.default_pattern())
    text = bpe_texts()[5]
    whole = codec.encoding.encode_ordinary(text)
    for size in (1, 7, 300):
        ids = [i for p, _ in byte_bpe.parts(text, size) for i in codec.encoding.encode_ordinary(p)]
        assert ids == whole


# -- ranked lexical search --------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute_search(docs, items, k=10):
    bags = [(r[0], Counter(terms_of(r[1]))) for r in docs]
    bags = [b for b in bags if b[1]]
    n_docs, total = len(bags), sum(sum(b[1].values()) for b in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = Counter()
    for item_id, text in items:
        found = []
        for doc_id, bag in bags:
            m = 100 - 90 + 90 * sum(bag.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in set(terms_of(text)) if t in bag)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(found)[:k], 1):
            out[(item_id, rank, None if none else doc_id, -score)] += 1
    return out


def search_tables():
    rng = random.Random(9)
    vocabulary = [f"t{i}" for i in range(300)] + ["Éa", "naïve", "日本", "B2"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 5, 40]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "zzz yyy"), (3, items[3][1]), (None, "t1 T1 t2"), (103, "  t4!t4 ")]
    docs = [(i, text(rng.choice([1, 4, 60, 300])), "en", "s", 0) for i in range(400)]
    docs += [(500 + i, text(3) + items[i % 20][1] + text(30), "en", "s", 0) for i in range(60)]
    docs += [(700 + i, docs[5][1], "en", "s", 0) for i in range(300)]  # copies: ties
    docs += [(9, docs[9][1], "en", "s", 0), (None, docs[9][1], "en", "s", 0), (None, items[1][1], None, None, None),
             (800, None, None, None, None), (801, "", "en", "s", 0), (802, " .!\n", "en", "s", 0),
             (803, text(60_000), "en", "s", 0), (804, "x" * 3_000_000 + " t1", "en", "s", 0)]
    rng.shuffle(docs)
    return docs, items


def test_lexical_search(spark, tmp_path, monkeypatch):
    from lathe.llm import lexical_search
    monkeypatch.setattr(lexical_search, "SUBTREE", 128)
    docs, items = search_tables()
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS id", "2 AS n", "3 AS codes", "4 AS tf", "5 AS rank", "6 AS t")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS terms", "3 AS doc_id")
    sf = parquet_dir(tmp_path, documents=d, benchmark=b)
    want = brute_search(docs, items)
    assert Counter(tuple(r) for r in lexical_search.op13_lexical_search(spark, sf).collect()) == want
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 4)  # many blocks of items, small ones by terms
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 30)
    few = [i for i in items if i[0] is None or i[0] > 18]
    report = {}
    found = lexical_search.ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(
        few, "item_id long, text string").coalesce(1), report=report)
    assert Counter(tuple(r) for r in found.collect()) == brute_search(docs, few)
    assert 0 < report["scored"] < report["pairs"]


def test_lexical_search_empty(spark):
    from lathe.llm.lexical_search import ranked_search
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search(empty(spark), items).collect() == []
    docs = spark.createDataFrame([(1, "a", None, None, 1)], DOCS)
    assert ranked_search(docs, items.limit(0)).collect() == []
    assert [r["doc_id"] for r in ranked_search(docs, items).collect()] == [1]


def test_ball_bounds():
    """No ball's bound lies below the score of a document in it."""
    from lathe.llm.lexical_search import Items, Rows, Tree, _leaf_scores
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(200, rng.integers(1, 40), replace=False)) for _ in range(300)]
    start = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    x = Rows(start, np.concatenate(rows), rng.integers(1, 10**11, start[-1]))
    tree = Tree(x)
    vocabulary = np.arange(200)
    items = Items([np.sort(rng.choice(200, n, replace=False)) for n in (1, 5, 40, 200)], vocabulary)
    bound = tree.bounds(items, np.arange(4))
    for i, codes in enumerate(items.codes):
        wanted = np.isin(tree.vocabulary, codes).astype(np.int64)
        for node in range(len(tree.lo)):
            assert _leaf_scores(tree, node, wanted).max() <= bound[node, i]
