from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from indexpanel.llm import merkle_manifest as m


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def grow(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append("n" if other >= len(nodes) else "lr"[other > at] + nodes[other])
        at //= 2
    return out


def plain(rows: list[tuple]) -> list[tuple]:
    """rows: (id, group, leaf); returns (id, group, rank, leaf, subroot, root, proof)."""
    groups: dict = {}
    for i, g, leaf in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: grow([x[2] for x in sorted(groups[g])]) for g in names}
    top = grow([trees[g][-1][0] for g in names])
    return sorted([(x[1] if x[0] else None, g, k, x[2], trees[g][-1][0], top[-1][0], siblings(trees[g], k) + siblings(top, names.index(g)))
                   for g in names for k, x in enumerate(sorted(groups[g]))], key=str)


def check(spark, rows: list[tuple]) -> None:
    docs = spark.createDataFrame(rows, "doc_id long, lang string, leaf string")
    got = m.manifest(docs, F.col("leaf"))
    assert got.columns == ["id", "group", "rank", "leaf", "claim", "subroot", "root", "proof"]
    assert got.where(m.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert sorted([(r.id, r.group, r.rank, r.leaf, r.subroot, r.root, r.proof) for r in got.collect()], key=str) == plain(rows)


def test_awkward_ids_against_a_plain_tree(spark, monkeypatch):
    monkeypatch.setattr(m, "RUN", 3)
    rng = random.Random(5)
    big = [2**63 - 1, -2**63, 0, -1, 63, 64, 65_535, 65_536, 2**32, 2**48 - 1, -64, -65]
    rows = [(i, "a", h(str(i))) for i in big]
    rows += [(i, "a", h("x")) for i in (7, 7, 7, 7, 7, 7, 7, 7)] + [(7, "a", h(f"y{k}")) for k in range(9)] + [(8, "a", h("z"))]
    rows += [(None, "a", h(f"n{k}")) for k in range(5)] + [(None, "a", h("n1"))] * 2 + [(None, None, h("q"))]
    rows += [(3, "", h("e")), (3, "ü", h("u")), (4, "ü", h("u")), (3, "z", h("v")), (5, None, h("w"))]
    rng.shuffle(rows)
    check(spark, rows)


def test_two_rounds(spark):
    rng = random.Random(6)
    ids = rng.sample(range(-10_000, 90_000), 2_100) + rng.sample(range(2**62), 6)
    rows = [(i, "a", h(str(i))) for i in ids] + [(i, "b", h(f"b{i}")) for i in range(1_024)] + [(i, "c", h(f"c{i}")) for i in range(1_025)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[(1, "a", h("1"))], [(1, "a", h("1")), (1, "b", h("1"))], [(None, None, h("1"))] * 3])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_odd_documents_and_tampering(spark, odd_docs, no_docs):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    claim = F.when(F.col("doc_id") % 2 == 0, m.leaf_hash(*fields[:3], F.col("n_chars") + 1, F.col("text")))
    got = m.manifest(odd_docs, m.leaf_hash(*fields), claim=claim).withColumn(
        "folded", m.folded(F.coalesce("claim", "leaf"), F.col("proof"))).collect()

    def field(v) -> str:
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    rows = odd_docs.collect()
    leaves = [h(*[field(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")]) for r in rows]
    want = plain([(r.doc_id, r.lang, leaf) for r, leaf in zip(rows, leaves, strict=True)])
    assert sorted([(r.id, r.group, r.rank, r.leaf, r.subroot, r.root, r.proof) for r in got], key=str) == want
    chars = {(r.doc_id, r.text): r.n_chars for r in rows}
    whole = {leaf: r for leaf, r in zip(leaves, rows, strict=True)}
    for r in got:
        changed = r.id is not None and r.id % 2 == 0 and chars[r.id, whole[r.leaf].text] is not None
        assert (r.folded != r.root) == changed
    assert m.manifest(no_docs, m.leaf_hash(*fields)).count() == 0
