"""Whole runs over stored tables: the scope matrix, repeatability and failure."""

from __future__ import annotations

import os

import pytest
from conftest import day, frame
from pyspark.sql import functions as F

from gainledger.operators.checks import DuplicateKeyError
from gainledger.plans.batch import Results, run_batch
from gainledger.plans.valuation import boundary_holdings
from gainledger.sources.jobs import DONE, FAILED, job_log, latest_status, read_job, status_log
from gainledger.sources.lists import RejectedLinesError
from gainledger.sources.parquet_tables import ParquetTables, ingest
from gainledger.sources.schemas import JOB, SOURCES
from gainledger.sources.star_tables import CUTOVER, StarTables

GIVEN = "/root/testdata/sf0.001"
PERIOD = dict(s_date="1997-01-01", e_date="1998-12-31", exclusion="00000000", calc_user="user1", status="0")

# Instruments and investors by segment, board, file and class; one exchange or both.
JOBS = [
    PERIOD | dict(batch="000001", obj_type="1", obj_content="11", invst_sort="3",
                  invst_content="2810,2310,1110,1540", exch="3", commission=0),
    PERIOD | dict(batch="000002", obj_type="1", obj_content="1", invst_sort="1",
                  invst_content="owners.txt", exch="0", commission=0),
    PERIOD | dict(batch="000003", obj_type="2", obj_content="instruments.txt", invst_sort="2",
                  invst_content="accounts.txt", exch="1", commission="0.002"),
    PERIOD | dict(batch="000004", obj_type="2", obj_content="instruments.txt", invst_sort="2",
                  invst_content="accounts.txt", exch="0", commission=0),
]

pytestmark = pytest.mark.skipif(not os.path.isdir(GIVEN), reason="no test data")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Stored source tables, lists, job rows and a result folder."""
    root = tmp_path_factory.mktemp("batch")
    star = StarTables(spark, GIVEN)
    for name, schema in SOURCES.items():
        ingest(star.table(name).select(*schema.names), str(root / "tables"), name)
    tables = ParquetTables(spark, str(root / "tables"), cutover=CUTOVER)
    accounts = [r.sec_acct for r in tables.table("intg_sec_acct").select("sec_acct").distinct().collect()]
    codes = [r.sec_cde for r in tables.table("sec_info").select("sec_cde").distinct().collect()]
    owners = [r[0] for r in tables.table("intg_sec_acct").select("oap_acct_nbr").distinct().collect()]
    lists = root / "lists"
    lists.mkdir()
    (lists / "accounts.txt").write_text("\n".join([*accounts, accounts[0], ""]))
    (lists / "instruments.txt").write_text("\n".join([*codes, "999999"]))
    (lists / "owners.txt").write_text("\n".join(o for o in owners if o))
    frame(spark, JOB, JOBS).write.parquet(str(root / "jobs"))
    log = job_log(spark, str(root / "jobs"))
    results = Results(spark, str(root / "out"))
    return log, tables, results, str(lists)


def execute(spark, world, batch):
    log, tables, results, lists = world
    return run_batch(spark, read_job(log, batch), tables, results.root, lists)


def snapshot(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def done(spark, world):
    reports = {job["batch"]: snapshot(execute(spark, world, job["batch"])) for job in JOBS}
    return world, reports


def test_every_scope_gives_a_report(done):
    (_, _, results, _), reports = done
    assert all(reports.values())
    exchanges = {b: {row[0] for row in rows} for b, rows in reports.items()}
    assert exchanges == {"000001": {"0", "1"}, "000002": {"0"}, "000003": {"1"}, "000004": {"0"}}


def test_status_is_done(spark, done):
    (_, _, results, _), _ = done
    states = {r.batch: r.status for r in latest_status(status_log(spark, results.status_path)).collect()}
    assert states == {job["batch"]: DONE for job in JOBS}


def test_ledger_has_no_negative_measures(done):
    (_, _, results, _), _ = done
    negative = results.ledger().filter("buy_vol < 0 OR sal_vol < 0 OR sal_amt < 0 OR tax_fee < 0")
    # Holdings of the derived data can be short, and rules that multiply a holding follow its sign.
    assert negative.filter(~F.col("biz_type").isin("3001", "4001", "4004")).count() == 0


def test_flows_and_gap_explain_the_change_in_holding(spark, done):
    (_, tables, results, _), _ = done
    from gainledger.plans.flows import Inputs, Scope

    ledger = results.ledger().filter("batch = '000003'")
    accounts = results.investors().filter("batch = '000003'").select(F.col("prmt_val").alias("sec_acct"))
    codes = results.instruments().filter("batch = '000003'").select(F.lit("1").alias("exch"), "sec_cde")
    scope = Scope("000003", day("1997-01-01"), day("1998-12-31"), accounts, codes)
    held = boundary_holdings(Inputs(tables, scope))
    total = ledger.groupBy("sec_acct", "sec_cde").agg(F.sum(F.col("buy_vol") - F.col("sal_vol")).alias("moved"))
    both = total.join(held.filter("exch = '1'"), ["sec_acct", "sec_cde"])
    wrong = both.filter("moved <> coalesce(end_vol, 0) - coalesce(start_vol, 0)")
    assert both.count() > 100 and wrong.count() == 0


def test_pivots_stay_within_totals(done):
    (_, _, results, _), _ = done
    wrong = results.report().filter(
        "non_trad_tran_incm_amt > sal_amt OR non_trad_tran_expdt_amt > buy_amt"
    )
    assert wrong.filter("sal_amt >= 0 AND buy_amt >= 0 AND cash_dvd >= 0").count() == 0


def test_second_run_gives_the_same_and_spares_other_batches(spark, done):
    world, reports = done
    results = world[2]
    before = snapshot(results.ledger())
    assert snapshot(execute(spark, world, "000003")) == reports["000003"]
    assert snapshot(results.ledger()) == before


def test_intermediate_tables_are_removed(spark, world, monkeypatch):
    from pathlib import Path

    from gainledger.operators.store import shared_folder

    below = Path(shared_folder(spark).removeprefix("file://")) / "gainledger"
    before = set(below.iterdir())
    execute(spark, world, "000004")
    assert set(below.iterdir()) <= before
    monkeypatch.setattr("gainledger.plans.batch.final_report", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        execute(spark, world, "000004")
    assert set(below.iterdir()) <= before
    monkeypatch.undo()
    execute(spark, world, "000004")


def test_rejected_lines_are_kept(spark, world, tmp_path):
    log, tables, results, lists = world
    for name in ("instruments.txt", "accounts.txt"):
        (tmp_path / name).write_text("600000\n" + "x" * 30)
    with pytest.raises(RejectedLinesError):
        run_batch(spark, read_job(log, "000004"), tables, str(tmp_path / "out"), str(tmp_path))
    kept = spark.read.parquet(str(tmp_path / "out/rejects/instruments/batch=000004"))
    assert [r.reject_reason for r in kept.collect()] == ["item too long"]


def test_slices_are_read_by_their_own_path(spark, done):
    (_, _, results, _), _ = done
    whole = results.ledger().filter("batch = '000001' AND exch = '1'")
    part = results.slice("ledger", batch="000001", exch="1")
    assert snapshot(part.select(*whole.columns)) == snapshot(whole)
    listed = part.inputFiles()
    assert listed and all("batch=000001/exch=1" in path for path in listed)


def test_codes_of_both_exchanges_fail(spark, world):
    log, tables, results, lists = world

    class Doubled:
        cutover = tables.cutover

        def table(self, name):
            rows = tables.table(name)
            if name != "sec_info":
                return rows
            return rows.unionByName(rows.withColumn("mkt_sort", F.when(F.col("mkt_sort") == "0", "1").otherwise("0")))

    with pytest.raises(DuplicateKeyError, match="both exchanges"):
        run_batch(spark, read_job(log, "000001"), Doubled(), results.root + "-doubled", lists)


def test_several_issue_prices_are_warned_of(spark, world):
    log, tables, results, lists = world

    class Doubled:
        cutover = tables.cutover

        def table(self, name):
            rows = tables.table(name)
            if name != "szse_stk_fi_info":
                return rows
            return rows.unionByName(rows.withColumn("iss_prc", (F.col("iss_prc") + 1).cast("decimal(9,3)")))

    with pytest.warns(UserWarning, match="several issue prices"):
        run_batch(spark, read_job(log, "000003"), Doubled(), results.root + "-prices", lists)


def test_failure_is_recorded(spark, world):
    from dataclasses import replace

    log, tables, results, lists = world
    job = replace(read_job(log, "000003"), batch="000009", obj_content="missing.txt")
    with pytest.raises(Exception):
        run_batch(spark, job, tables, results.root, lists)
    states = {r.batch: r.status for r in latest_status(status_log(spark, results.status_path)).collect()}
    assert states["000009"] == FAILED
