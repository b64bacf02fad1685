import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerprofile.llm import manifest as mf
from ledgerprofile.llm import queries

FANOUTS = [mf.Shape(), mf.Shape(fanout=2, stride=2), mf.Shape(fanout=3, stride=1)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(nodes, fanout):
    """All levels, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k: k + fanout])) for k in range(0, len(levels[-1]), fanout)])
    return levels


def siblings(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        run = at // fanout * fanout
        out += [d for k, d in enumerate(level[run: run + fanout], run) if k != at]
        at //= fanout
    return out


def plain(rows, fanout):
    """[(id, leaf, subroot, root, sibling digests)] of (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: tree([leaf(r) for r in ordered[g]], fanout) for g in names}
    top = tree([trees[g][-1][0] for g in names], fanout)
    out = []
    for place, g in enumerate(names):
        above = siblings(top, place, fanout)
        out += [(r[0], leaf(r), trees[g][-1][0], top[-1][0], "".join(siblings(trees[g], k, fanout) + above))
                for k, r in enumerate(ordered[g])]
    return out


def got(built):
    rows = built.proofs().select("id", "leaf", "subroot", "root", mf.proof_text(F.col("siblings")),
                                 mf.folded(F.unhex("leaf"), F.col("siblings"), F.col("places")).alias("folded")).collect()
    assert all(r["folded"] == r["root"] == built.root for r in rows)
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("shape", FANOUTS, ids=str)
def test_proofs_against_whole_trees(spark, shape):
    """Groups of 1 to 70 rows, so that tops fall on, between and above the stored levels."""
    rows = [(n * 1000 + k * 3, "s", f"g{n}" if n else None, k, f"text {k}")
            for n in (0, 1, 2, 7, 8, 9, 16, 27, 64, 65, 70) for k in range(max(n, 4 * (not n)))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    built = mf.build(docs, shape=shape)
    assert got(built) == sorted(plain(rows, shape.fanout), key=repr)
    tallest = len(tree(list("x" * 70), shape.fanout)) - 1
    assert len(built.levels) == 1 + -(-tallest // shape.stride)          # only these are stored
    built.drop()


def test_query_against_whole_trees(spark, sf001):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf001}/documents.parquet")
            .select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = {r[0]: r for r in plain(rows, 8)}
    texts = {r[0]: r[4] for r in rows}
    found = queries.op11_merkle_manifest(spark, sf001).collect()
    assert len(found) == len(rows)
    import zlib
    for r in found:
        _, digest, subroot, root, proof = want[r["doc_id"]]
        assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) == (digest, subroot, root, sha(proof))
        tampered = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in texts[r["doc_id"]] or "")
        assert r["verified"] == (r["folded_root"] == root) == (not tampered)


def test_odd_and_empty(spark, odd, odd_rows):
    built = mf.build(odd)
    assert got(built) == sorted(plain([(i, s, g, n, t) for i, t, g, s, n in odd_rows], 8), key=repr)
    assert built.subroots().count() == 3
    empty = mf.build(odd.limit(0))
    assert empty.root is None and empty.proofs().collect() == []
    one = mf.build(odd.where("doc_id = 2"))
    row = one.proofs().first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["siblings"] == []


def test_a_hot_group_is_spread(spark):
    """One language with most rows: every task holds one aligned subtree."""
    docs = spark.range(5000).selectExpr("id AS doc_id", "'s' AS source", "if(id % 50 = 0, 'a', 'b') AS lang", "1L AS n_chars",
                                        "concat('t', id) AS text")
    built = mf.build(docs, shape=mf.Shape(fanout=4, stride=2))
    rows = [tuple(r) for r in docs.collect()]
    assert got(built) == sorted(plain(rows, 4), key=repr)
    sizes = built.levels[0].groupBy("grp", F.expr("pos div 16")).count().agg(F.max("count")).first()[0]
    assert sizes == 16
