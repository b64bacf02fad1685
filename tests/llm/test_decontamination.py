import duckdb
import numpy as np
import pyarrow as pa

from ledgerprofile.llm import decontamination, queries
from ledgerprofile.llm.decontamination import Matcher, choose_prefixes, find_passages, is_contaminated, make_block, words_of
from tests.llm import brute

COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256")


def _rows(found):
    return [(r["row"]["doc_id"], tuple(r[c] for c in COLUMNS) + (r["contaminated"],))
            for r in found.withColumn("contaminated", is_contaminated()).collect()]


def test_query_matches_sql_and_plain_version(spark, sf01):
    got = {r["doc_id"]: tuple(r[c] for c in (*COLUMNS, "contaminated"))
           for r in queries.op6_prefix_filtered_decontamination(spark, sf01).collect()}
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf01}/{t}.parquet')")
    assert got == {r[0]: r[1:] for r in con.sql(queries.OP6_SQL).fetchall()}
    docs = con.sql("SELECT doc_id, text FROM documents").fetchall()
    items = con.sql("SELECT item_id, text FROM benchmark").fetchall()
    assert got == brute.passages(docs, items) and any(r[-1] for r in got.values())


def test_windows_bounds_and_blocks(spark):
    words = [f"w{k}" for k in range(40)]
    items = [(1, " ".join(words)), (2, "Short, item!"), (2, "short item"), (3, None), (4, "--- ..."), (None, "solo"),
             (5, " ".join(["rep"] * 20)), (6, "été 9 Ω"), (7, " ".join(words[5:25]))]
    texts = [" ".join(words), " ".join(words[:13]), " ".join(words[:12]), "x " * 300 + " ".join(words[10:23]),
             "a SHORT-item b", "short", "item short", "solo" * 2, "solo", "rep " * 13, "rep " * 12, "rep " * 50,
             None, "", "é été 9 ω Ω", "Été 9 Ω", " ".join(words[20:] + words[:20]), "w1 w2 " + " ".join(words[27:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.passages(list(enumerate(texts)), items)
    assert dict(_rows(find_passages(docs, bench))) == want
    assert dict(_rows(find_passages(docs, bench, block_bytes=200))) == want
    assert all(r[1] == (r[1][0], 0, 0, *want[12][3:]) for r in _rows(find_passages(docs, bench.limit(0))))


def test_a_shared_passage_is_one_window():
    """A passage of many items is compared once, and each item is found."""
    text = " ".join(f"w{k}" for k in range(15))
    block = make_block([str(k) for k in range(500)] + ["other"], [text] * 500 + ["w1 w2"], 13)
    assert len(block.sizes) == 4 and len(block.items) == 1501
    block = choose_prefixes(block, np.zeros(len(block.shingles), np.int64))
    (words, first), = words_of(pa.array(["x " + text, "w1 w2 w3"]))
    spans = Matcher(block).spans(words, first)
    assert [len(s) for s in spans] == [501, 1]
    assert {(s["start"], s["end"]) for s in spans[0] if s["item"] != "other"} == {(1, 16)}
    assert spans[1] == [{"item": "other", "start": 0, "end": 2}]


def test_a_large_benchmark_goes_block_by_block(spark, monkeypatch):
    """A plan never holds more than one block, and a block is bounded whatever the benchmark's size."""
    items = [(k, " ".join(f"v{(k * 31 + j * j) % 4000}" for j in range(40))) for k in range(400)]
    docs = spark.createDataFrame([(k, f"own {k} " + items[k][1] + " end") for k in range(0, 400, 7)] * 2, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    largest = []
    monkeypatch.setattr(decontamination, "make_block", lambda *a: largest.append(make_block(*a)) or largest[-1])
    found = find_passages(docs, bench, block_bytes=8_000)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert len(largest) > 8 and max(len(b.sizes) for b in largest) < 28 * 400 / 5
    want = brute.passages([tuple(r) for r in docs.collect()], items)
    rows = _rows(found)
    assert len(rows) == docs.count() and all(want[i] == r for i, r in rows)


def test_odd_and_empty(spark, odd, odd_rows):
    bench = spark.createDataFrame([(1, "one"), (2, "exact copy of one text")], "item_id int, text string")
    got = sorted(_rows(find_passages(odd, bench)), key=repr)
    want = []
    for i, text in (r[:2] for r in odd_rows):
        want.append((i, brute.passages([(i, text)], [(1, "one"), (2, "exact copy of one text")])[i]))
    assert got == sorted(want, key=repr)
    assert find_passages(odd.limit(0), bench).collect() == []
