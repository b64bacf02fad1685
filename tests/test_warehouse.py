import os

import pytest
from pyspark.sql import functions as F

from ledgerprofile.functions.tagrows import TAG_COLUMNS, to_tags
from ledgerprofile.operators import summary
from ledgerprofile.plans.catalog import scratch_path
from ledgerprofile.sources import loaders, testdata, warehouse

INVOICE = "xf_nsrsbh string, gf_nsrsbh string, je decimal(18,2), kprq string"


def _invoices(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(a, b, Decimal(str(w)), t) for a, b, w, t in rows], INVOICE)


def _registry(spark):
    return spark.createDataFrame([("A", "H1"), ("B", "H1"), ("C", "H2"), ("D", "")], "nsrsbh string, hy_dm string")


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path.removeprefix("file:"))
            for f in names if f.startswith("part-")}


FIRST = [("A", "B", 10, "20120105000000"), ("B", "A", 4, "20120106000000"), ("A", "C", 1, "20120210000000"),
         ("C", "A", 2, "20120211000000"), ("D", "A", 9, "20120105000000"), ("A", "B", 5, "bad time"), ("B", "C", 3, "20120301000000")]
LATE = [("A", "B", 7, "20120212000000"), ("C", "A", 8, "20120213000000"), ("C", "B", 6, "20120401000000"), ("B", "C", 2, "20120402000000")]


@pytest.fixture
def store(spark):
    stored = warehouse.Warehouse(spark, scratch_path(spark, "test"))
    yield stored
    stored.drop()


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def _assert_full_run(spark, store, rows):
    """The stored tables are those of one run over all invoices."""
    inv, reg = _invoices(spark, rows), _registry(spark)
    taxpayers, industries = summary.monthly_tables(inv, inv, reg, materialise=False)
    pairs = summary.pair_monthly_for_tags(inv, reg)
    assert _rows(loaders.taxpayer_monthly_table(store.monthly("taxpayer_months"))) == _rows(taxpayers)
    assert _rows(loaders.industry_monthly_table(store.monthly("industry_months"))) == _rows(industries)
    assert _rows(loaders.trade_pairs_monthly_table(store.monthly("trade_pairs"))) == _rows(pairs)


def test_appended_batches_equal_a_full_run(spark, store):
    first, late = _invoices(spark, FIRST), _invoices(spark, LATE)
    assert store.load("one", first, first, _registry(spark)) == [201201, 201202, 201203]
    _assert_full_run(spark, store, FIRST)
    before = _files(store.folder)
    assert store.load("two", late, late, _registry(spark)) == [201202, 201204]
    _assert_full_run(spark, store, FIRST + LATE)
    after = _files(store.folder)
    # months that the batch does not touch were not written again, nor the first batch's invoices
    same = {f for f in before if "date_key=201201" in f or "date_key=201203" in f or "batch=one" in f}
    assert same and all(after.get(f) == before[f] for f in same)
    assert not any(f in after for f in before if "taxpayer_months/date_key=201202" in f)


def test_a_batch_run_again_replaces_itself(spark, store):
    reg = _registry(spark)
    first, late = _invoices(spark, FIRST), _invoices(spark, LATE)
    for _ in range(2):
        store.load("one", first, first, reg)
    _assert_full_run(spark, store, FIRST)
    # as if a load had failed after its invoices: the next one brings everything in order
    store.store_invoices("sales", "two", late)
    store.load("two", late, late, reg)
    _assert_full_run(spark, store, FIRST + LATE)
    # a corrected batch no longer has April: its partitions go
    corrected = _invoices(spark, LATE[:1])
    assert store.load("two", corrected, corrected, reg) == [201202, 201204]
    _assert_full_run(spark, store, FIRST + LATE[:1])
    assert not any("date_key=201204" in f for f in _files(store.folder))
    assert store.refresh(reg) == [201201, 201202, 201203]
    _assert_full_run(spark, store, FIRST + LATE[:1])


def test_empty_batches_and_names(spark, store):
    none = _invoices(spark, [])
    assert store.load("one", none, none, _registry(spark)) == []
    assert store.monthly("trade_pairs").count() == 0 and store.invoices("sales").count() == 0
    for name in ("", "a/b", "x=y"):
        with pytest.raises(ValueError):
            store.load(name, none, none, _registry(spark))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_periods_prune_partitions(spark, store):
    first = _invoices(spark, FIRST)
    store.load("one", first, first, _registry(spark))
    name = store.register("sales", "ledgerprofile_test_sales")
    period = loaders.catalog_invoices(spark, name, (201202, 201203))
    assert _rows(period) == _rows(_invoices(spark, [FIRST[2], FIRST[3], FIRST[6]]).select("gf_nsrsbh", "xf_nsrsbh", "je", "kprq"))
    pushed = next(line for line in _plan(period).splitlines() if "PartitionFilters" in line)
    assert "date_key" in pushed.split("PartitionFilters")[1].split("]")[0]
    assert len(period.inputFiles()) < len(spark.table(name).inputFiles())
    months = store.monthly("taxpayer_months", (201202, 201203))
    assert "PartitionFilters: [isnotnull(date_key" in _plan(months)
    # months that are known at run time only
    periods = spark.createDataFrame([(201202, "Q"), (201203, "R")], "ny int, name string").where("name = 'Q'")
    joined = warehouse.invoices_in_periods(spark.table(name), periods)
    assert joined.count() == 2
    assert "dynamicpruning" in _plan(joined).lower()


def test_stored_map_lookup(spark, sf001):
    """The map is read from a file and looked up there, keys missing or null maps in no list."""
    path = scratch_path(spark, "maps")
    testdata.write_registry_maps(spark, sf001, path)
    maps = spark.read.parquet(path)
    assert dict(maps.dtypes)["nsrkz"] == "map<string,string>" and maps.where("nsrkz IS NULL").count() == 1
    found = loaders.registry_from_maps(maps)
    plan = _plan(found)
    assert "nsrkz" in plan.split("FileScan parquet")[1] and "[hymx_dm]" in plan and "CASE" not in plan
    got = {r.nsrsbh for r in found.collect()}
    assert got == {r.nsrsbh for r in testdata.taxpayers(spark, sf001).where("s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0 AND hy_dm <> ''").collect()}
    odd = spark.createDataFrame([("N", None, None), ("E", {}, {}), ("V", {"hymx_dm": None}, {"nsrdj_no": None})],
                                "rowkey string, nsrkz map<string,string>, ckts map<string,string>")
    odd_path = scratch_path(spark, "maps")
    odd.write.parquet(odd_path)
    odd = spark.read.parquet(odd_path)
    assert loaders.registry_from_maps(odd).count() == loaders.registry_from_maps(odd, True).count() == 0
    assert loaders.foreign_trade_registry(odd).count() == 0


def test_replaced_tags(spark):
    path = scratch_path(spark, "tags")

    def tags(key, ids, end=201312):
        return to_tags(spark.createDataFrame([(i,) for i in ids], "nsrsbh string"), key, "nsrsbh", 1.5, end, "2026-01-01")
    both = tags("1", "AB").unionByName(tags("6", "C"))
    for _ in range(2):                                   # twice leaves one copy
        warehouse.replace_tags(both, path, ["1", "6"], 201312)
    warehouse.replace_tags(tags("1", "Z", 201412), path, ["1"], 201412)          # another period stays apart
    back = warehouse.read_tags(spark, path)
    assert back.columns == TAG_COLUMNS
    assert _rows(back.select("nsr_key", "bq_key", "bq_start_time")) == _rows(spark.createDataFrame(
        [("A", "1", "201312"), ("B", "1", "201312"), ("C", "6", "201312"), ("Z", "1", "201412")],
        "nsr_key string, bq_key string, bq_start_time string"))
    warehouse.replace_tags(tags("1", "A"), path, ["1", "6"], 201312)             # 6 has no rows any more
    assert sorted(r.nsr_key for r in warehouse.read_tags(spark, path).collect()) == ["A", "Z"]
    with pytest.raises(ValueError, match="outside"):
        warehouse.replace_tags(both, path, ["1"], 201312)
    assert warehouse.read_tags(spark, path).where(F.col("bq_key") == "6").count() == 0
    assert warehouse.read_tags(spark, scratch_path(spark, "none")).count() == 0


def test_rows_are_computed_once_and_not_staged(spark, monkeypatch):
    """Each source row meets one task of one write, and nothing is written beside the table."""
    from ledgerprofile.session import Scratch

    def refused(*args, **kwargs):
        raise AssertionError("staged")
    monkeypatch.setattr(Scratch, "store", refused)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    rows = spark.range(100).selectExpr("id", "cast(id % 3 as int) AS m").mapInArrow(counted, "id long, m int")
    path = scratch_path(spark, "once")
    warehouse.replace_partitions(rows, path, ["m"], [(0,), (1,), (2,), (3,)])
    assert read.value == 100 and spark.read.parquet(path).count() == 100
    with pytest.raises(ValueError, match="outside"):
        warehouse.replace_partitions(rows.selectExpr("id", "cast(null as int) AS m"), path, ["m"], [(0,)])
    assert spark.read.parquet(path).count() == 100


def test_invoice_lines_are_joined_once_for_the_warehouse(spark, sf001, monkeypatch):
    from ledgerprofile.plans.catalog import Inputs
    calls, plain = [], testdata.invoice_lines
    monkeypatch.setattr(testdata, "invoice_lines", lambda *a: calls.append(a) or plain(*a))
    inputs = Inputs(spark, sf001, stored=True)
    stored = inputs.warehouse()
    assert len(calls) == 1 and stored.monthly("trade_pairs").count() > 0
    stored.drop()


def test_monthly_tables_compute_the_invoices_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    sales = _invoices(spark, FIRST).mapInArrow(counted, INVOICE)
    months, _ = summary.monthly_tables(sales, _invoices(spark, FIRST), _registry(spark))
    assert months.count() > 0 and read.value == len(FIRST)
