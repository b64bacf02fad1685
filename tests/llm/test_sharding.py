import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerprofile.llm import queries, sharding


def test_matches_plain_interleaving(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    keys = docs.select("doc_id", "source", "text", F.xxhash64(
        F.lit(sharding.SEED), "doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).alias("h")).collect()
    by_source = defaultdict(list)
    for r in keys:
        by_source[r["source"]].append((r["h"], r["doc_id"]))
    stream = []
    for source, rows in by_source.items():
        stream += [((2 * k + 1) / (2 * len(rows)), "=" + source, k, i) for k, (_, i) in enumerate(sorted(rows))]
    want = {i: place for place, (_, _, _, i) in enumerate(sorted(stream))}
    got = {r["doc_id"]: r for r in sharding.interleave(docs, 24).collect()}
    assert {i: r["position"] for i, r in got.items()} == want
    n = len(want)
    begin = [min(p for p in range(n) if p * 24 // n == s) for s in range(24)]
    for r in got.values():
        assert r["shard"] == r["position"] * 24 // n and r["slot"] == r["position"] - begin[r["shard"]]
    for r in keys:
        raw = (r["text"] or "").encode()
        assert got[r["doc_id"]]["size"] == len(raw) + 8
        assert got[r["doc_id"]]["text_crc32"] == zlib.crc32(raw)


def test_shards_match_the_mixture(spark, sf01):
    rows = queries.op1_interleaved_shards(spark, sf01).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    total = Counter(r["stratum"] for r in rows)
    for (stratum, _), n in Counter((r["stratum"], r["shard"]) for r in rows).items():
        assert abs(n - total[stratum] / 24) <= 2
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_odd_and_empty(odd):
    rows = sharding.interleave(odd, 4).collect()
    assert len(rows) == odd.count()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    assert {r["stratum"] for r in rows} == {"null", "=a", "=b", "=c"}
    assert sharding.interleave(odd.limit(0), 4).collect() == []


def test_more_shards_than_rows(odd):
    rows = sharding.interleave(odd.where("doc_id = 6"), 24).collect()
    assert len(rows) == 2 and len({r["shard"] for r in rows}) == 2 and {r["slot"] for r in rows} == {0}
