"""The manifest against plain hashlib: many shapes of trees, odd rows, and the hash itself."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import DOCS, words
from pyspark.sql import functions as F

from shelfmark.llm import manifest
from shelfmark.llm.manifest import leaf_digest, tampered_text

H = lambda *texts: hashlib.sha256("".join(texts).encode()).hexdigest()
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(row):
    return H(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(nodes, at, leaf):
    """(root, siblings, root with the node at ``at`` replaced by ``leaf``)."""
    siblings = []
    while len(nodes) > 1:
        start = at - at % 8
        run = nodes[start : start + 8]
        siblings += run[: at - start] + run[at - start + 1 :]
        leaf = H(*run[: at - start], leaf, *run[at - start + 1 :])
        nodes, at = [H(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)], at // 8
    return nodes[0], siblings, leaf


def brute(rows):
    trees = {}
    for r in rows:
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        leaf = leaf_of(r)
        trees.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, leaf_of(r | {"text": lowered(r["text"])}) if tampered else leaf, r["doc_id"]))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        trees[x].sort(key=lambda t: t[:4])
    tops = [climb([t[2] for t in trees[x]], 0, "")[0] for x in langs]
    out = []
    for k, x in enumerate(langs):
        leaves = [t[2] for t in trees[x]]
        for i, t in enumerate(trees[x]):
            subroot, below, top = climb(leaves, i, t[3])
            root, above, top = climb(tops, k, top)
            out.append((t[4], t[2], subroot, root, H(*below, *above), top, top == root))
    return sorted(out, key=str)


def made(df):
    fields = [F.col(c) for c in FIELDS]
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf_digest([*fields[:4], tampered_text(F.col("text"))]))
    out = manifest.manifest(df, "doc_id", "lang", leaf_digest(fields), changed)
    return sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def as_dicts(df):
    return [r.asDict() for r in df.select(*FIELDS).collect()]


def test_hash_states():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 8, 9, 64, 65):
        own = manifest.words_of([rng.bytes(32) for _ in range(n)])
        text = manifest.texts_of(own)
        above, before = manifest.parents(own)
        assert manifest.texts_of(above) == [H(*text[i : i + 8]) for i in range(0, n, 8)]
        at, new = np.arange(n), manifest.words_of([rng.bytes(32) for _ in range(n)])
        run = np.minimum(8, n - (at - at % 8))
        got = manifest.texts_of(manifest.folded(new, before, at % 8, manifest.hex_blocks(own), at, run))
        start = [i - i % 8 for i in range(n)]
        assert got == [H(*text[s:i], x, *text[i + 1 : s + 8]) for i, s, x in zip(range(n), start, manifest.texts_of(new))]


@pytest.mark.parametrize("levels", [4, 1])
def test_trees_of_many_shapes(spark, monkeypatch, levels):
    """Languages of 1 to 600 rows, one of them hot; with one level a stage, many stages."""
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "SUBTREE", 8**levels)
    rng = random.Random(2)
    rows, i = [], 0
    for lang, n in (("en", 600), (None, 9), ("de", 64), ("zz", 1), ("é", 65), ("A", 8), ("", 3), ("a", 2), ("fr", 17), ("b", 7)):
        for _ in range(n):
            i += rng.randrange(1, 4)
            rows.append((i, " ".join(words(rng, 5)).title(), lang, rng.choice("ab"), i))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert made(df) == brute(as_dicts(df))


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumns({c: F.lit("x") for c in ("pos", "tree", "leaf", "root", "digest", "total")})
    assert made(docs) == brute(as_dicts(docs))
    assert made(no_docs) == []
    one = docs.where("doc_id = 7")
    assert made(one) == brute(as_dicts(one))
