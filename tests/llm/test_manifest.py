"""The manifest against a plain tree, over odd rows and over trees of several levels."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gablework.llm import manifest
from tests.llm.test_edges import DOCS, SCHEMA


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    fields = [None if x is None else str(x) for x in (row.doc_id, row.source, row.lang, row.n_chars, text)]
    return sha(*("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each node its siblings' texts, left and right, level by level."""
    paths, under = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        new, groups = [], []
        for a in range(0, len(nodes), 16):
            run = nodes[a : a + 16]
            for k in range(len(run)):
                for i in under[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            new.append(sha(*run))
            groups.append([i for k in range(len(run)) for i in under[a + k]])
        nodes, under = new, groups
    return nodes[0], paths


def plain(rows) -> list[tuple]:
    by = {}
    for r in rows:
        by.setdefault((r.source is not None, (r.source or "").encode()), []).append(r)
    keys, roots, inner, order = sorted(by), [], [], []
    for k in keys:
        own = sorted(by[k], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        root, paths = tree([leaf(r, r.text) for r in own])
        roots.append(root)
        inner.append(paths)
        order.append(own)
    top, above = tree(roots)
    out = []
    for own, paths, root, more in zip(order, inner, roots, above, strict=True):
        for r, path in zip(own, paths, strict=True):
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = leaf(r, text)
            for a, b in path + more:
                h = sha(a, h, b)
            out.append((r.doc_id, leaf(r, r.text), root, top, sha(*(a + b for a, b in path + more)), h, h == top))
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    got = df.collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got), key=repr)


@pytest.mark.parametrize("spread", [1, 256])
def test_trees_of_several_levels(spark, monkeypatch, spread):
    monkeypatch.setattr(manifest, "SPREAD", spread)
    rows = [(i * 7919 % 5003, f"Text {i} with CAPITALS and Äpfel", "en", "hot" if i % 3 else f"s{i % 40}", i) for i in range(1200)]
    rows += [(10_000 + k, "Alone", None, f"only{k}", None) for k in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("pos", "tree", "n", "key", "path", "node", "to", "weight", "run")})
    assert found(manifest.manifest(docs)) == plain(docs.collect())


@pytest.mark.parametrize("rows", [DOCS, DOCS[:1], [(i, "A", "en", None, 1) for i in range(5)], [(i, f"A{i}", "en", "z", 1) for i in range(300)], [(i, "B", "en", f"s{i}", 1) for i in range(40)]])
def test_small_and_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(manifest.manifest(docs)) == plain(docs.collect())


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert manifest.manifest(empty).collect() == []
    assert manifest.manifest(empty).columns == manifest.manifest(spark.createDataFrame(DOCS, SCHEMA)).columns
