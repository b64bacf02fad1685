import hashlib

import duckdb

from ledgerprofile.llm import queries
from ledgerprofile.llm.line_dedup import dedup_lines
from tests.llm import brute


def test_query_matches_sql_and_plain_version(spark, sf01):
    got = sorted(tuple(r) for r in queries.op5_line_dedup(spark, sf01).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf01}/documents.parquet')")
    assert got == sorted(con.sql(queries.OP5_SQL).fetchall())
    rows = con.sql("SELECT doc_id, text FROM documents").fetchall()
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute.line_dedup(rows))
    assert got == want and sum(r[2] for r in got) > 0


def test_odd_rows(odd, odd_rows):
    got = sorted((repr(r["row"]["doc_id"]), r["n_lines"], len(r["dropped"]), r["kept_text"])
                 for r in dedup_lines(odd).collect())
    want = sorted((repr(i), n, d, t) for i, n, d, t in brute.line_dedup([r[:2] for r in odd_rows]))
    assert got == want
    assert dedup_lines(odd.limit(0)).collect() == []


def test_keeper_and_white_space(spark):
    line = "A line that is certainly longer than forty characters"
    texts = [line, f" \t{line.lower()}\x0b", f"x\n{line.upper()}\ny", line, f"{line}\n{line}", line + "é", line + "É"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, line), (None, line), (9, line[:39]), (3, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((repr(r["row"]["doc_id"]), r["kept_text"]) for r in dedup_lines(docs).collect())
    assert got == sorted((repr(i), t) for i, _, _, t in brute.line_dedup(rows))
    assert ("4", f"{line}\n{line}") in got and ("2", "x\ny") in got


def test_native_plan(spark, sf001):
    plan = queries.op5_line_dedup(spark, sf001)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
