"""Lists, jobs, universes, ingest, key checks and calendar operators."""

from __future__ import annotations

import pytest
from conftest import FakeTables, day, frame
from pyspark.sql import functions as F

from gainledger.functions.columns import security_code
from gainledger.operators.checks import DuplicateKeyError, duplicate_keys, require_unique
from gainledger.operators.store import Workspace, replace_slice, shared_folder
from gainledger.operators.temporal import held_on, previous_open_day
from gainledger.plans import universe
from gainledger.sources.jobs import (
    JobError,
    job_log,
    latest_status,
    read_job,
    record_status,
    split_values,
    status_log,
)
from gainledger.sources.lists import RejectedLinesError, read_list
from gainledger.sources.parquet_tables import ParquetTables, ingest
from gainledger.sources.schemas import JOB, SOURCES

START, END = day("2016-04-01"), day("2017-04-01")


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_list_dedupe_and_empty_lines(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("600000\n000001  \n\n600000\n")
    assert {r.item_nbr for r in read_list(spark, str(path)).collect()} == {"600000", "000001", None}


@pytest.mark.parametrize("bad", ["600000,extra", "x" * 26])
def test_list_rejects(spark, tmp_path, bad):
    path = tmp_path / "list.txt"
    path.write_text(f"600000\n{bad}\n")
    rejects = str(tmp_path / "rejects")
    with pytest.raises(RejectedLinesError):
        read_list(spark, str(path), rejects_to=rejects)
    assert [r.line for r in spark.read.parquet(rejects).collect()] == [bad]
    assert values(read_list(spark, str(path), error_limit=2)) == [("600000",)]


JOB_ROW = dict(
    batch="000001", s_date="2016-04-01", e_date="2017-04-01", obj_type="1", obj_content="11",
    invst_sort="3", invst_content="2810,2310", exch="3", commission="0.002", exclusion="00000000",
)


def test_job_lookup(spark, tmp_path):
    frame(spark, JOB, [JOB_ROW, JOB_ROW | dict(batch="000002", exch="1")]).write.parquet(str(tmp_path / "jobs"))
    log = job_log(spark, str(tmp_path / "jobs"))
    assert read_job(log, "000001").exchanges == ["0", "1"]
    assert read_job(log, "000002").exchanges == ["1"]
    with pytest.raises(JobError):
        read_job(log, "000003")
    with pytest.raises(JobError):
        read_job(log.unionByName(log), "000001")


@pytest.mark.parametrize(
    "wrong", [dict(obj_type="9"), dict(obj_content="4"), dict(invst_sort="7"), dict(exch="5")]
)
def test_unknown_scopes_fail(spark, wrong):
    with pytest.raises(JobError):
        read_job(frame(spark, JOB, [JOB_ROW | wrong]), "000001")


def test_split_values():
    assert split_values("2810, 2310,,1110") == ["2810", "2310", "1110"]


def test_status_is_that_of_the_last_event(spark, tmp_path):
    path = str(tmp_path / "status")
    for status in ("0", "2", "0", "1"):
        record_status(spark, path, "000001", status)
    assert values(latest_status(status_log(spark, path))) == [("000001", "1")]


INFO = dict(mkt_sort="0", sec_cde="600000", mkt_lvl_sort="1", sec_ctg="11", s_date="2010-01-01", e_date="3000-12-31")


@pytest.fixture
def info(spark):
    rows = [
        INFO,
        INFO | dict(s_date="2005-01-01", e_date="2010-01-01"),
        INFO | dict(sec_cde="600001", mkt_lvl_sort="2"),
        INFO | dict(sec_cde="600002", e_date="2016-04-01"),
        INFO | dict(sec_cde="600003", sec_ctg="21"),
        INFO | dict(sec_cde="000001", mkt_sort="1"),
    ]
    return frame(spark, SOURCES["sec_info"], rows)


def test_instrument_universes(spark, info):
    both = universe.all_shares(info, START, ["0", "1"])
    assert values(both) == [("000001",), ("600000",), ("600001",)]
    assert values(universe.all_shares(info, START, ["1"])) == [("000001",)]
    assert values(universe.board_shares(info, START, ["0"], "2")) == [("600001",)]
    items = spark.createDataFrame([("600000",), ("600003",), ("999999",)], "item_nbr string")
    assert values(universe.listed_shares(info, START, ["0"], items)) == [("600000",)]
    assert values(universe.exchange_instruments(info, START, both)) == [
        ("0", "600000"), ("0", "600001"), ("1", "000001"),
    ]


def test_account_universes(spark):
    account = dict(mkt_sort="0", s_date="2010-01-01", e_date="3000-12-31")
    accounts = frame(
        spark,
        SOURCES["intg_sec_acct"],
        [
            account | dict(sec_acct="A1", oap_acct_nbr="O1"),
            account | dict(sec_acct="A2", oap_acct_nbr="O1", e_date="2016-04-01"),
            account | dict(sec_acct="A3", oap_acct_nbr="O2"),
            account | dict(sec_acct="A4", oap_acct_nbr="  "),
        ],
    )
    items = spark.createDataFrame([("O1",), (None,), ("  ",)], "item_nbr string")
    investors = universe.investors_from_list(accounts, items, universe.OWNER, START)
    assert values(investors) == [("1", "  "), ("1", "O1"), ("2", "A1")]
    assert values(universe.batch_accounts(investors)) == [("A1",)]
    owned = dict(s_date="2010-01-01", e_date="3000-12-31")
    classes = frame(
        spark,
        SOURCES["invst_clsf_his"],
        [
            owned | dict(oap_acct_nbr="O1", sec_acct_nbr="A1", clsf_3="2810", e_date="2017-04-01"),
            owned | dict(oap_acct_nbr="O2", sec_acct_nbr="A3", clsf_3="2310"),
        ],
    )
    chosen = universe.investors_of_classes(accounts, classes, ["2810", "2310"], START, END)
    assert values(chosen) == [("2", "A3")]


def test_security_code(spark):
    df = spark.createDataFrame([("1",), ("600000",), ("1234567",), (" 42 ",)], "c string")
    codes = [r[0] for r in df.select(security_code(df.c)).collect()]
    assert codes == ["000001", "600000", "1234567", "000042"]


def test_unique_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert values(duplicate_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(DuplicateKeyError):
        require_unique(df, ["k"], "keys")
    assert require_unique(df, ["k", "v"], "keys") is df


def test_previous_open_day(spark):
    rows = [("2016-04-28", "1"), ("2016-04-29", "1"), ("2016-04-30", "0"), ("2016-05-03", "1")]
    calendar = frame(spark, SOURCES["tdsum_date_exchange"], [dict(calendar_date=d, is_trd_dt=t) for d, t in rows])
    asked = ["2016-04-28", "2016-04-29", "2016-05-01", "2016-05-03", "2030-01-01"]
    dates = spark.createDataFrame([(day(d),) for d in asked], "d date")
    answers = previous_open_day(dates, calendar, "d", day("2016-04-01"))
    assert {str(r.d): str(r.prev_open) for r in answers.collect() if str(r.d) in asked} == {
        "2016-04-29": "2016-04-28", "2016-05-01": "2016-04-29", "2016-05-03": "2016-04-29",
        "2030-01-01": "2016-05-03",
    }


def test_history_is_half_open(spark):
    held = dict(mkt_sort="0", sec_acct_nbr="A1", sec_cde="600000", td_end_hold_vol=5)
    holdings = frame(spark, SOURCES["hold_his"], [held | dict(s_date="2016-04-01", e_date="2016-05-01")])
    asks = spark.createDataFrame(
        [("0", "600000", day(d)) for d in ("2016-03-31", "2016-04-01", "2016-04-30", "2016-05-01")],
        "exch string, sec_cde string, ask_date date",
    )
    days = [str(r.ask_date) for r in held_on(holdings, asks).collect()]
    assert sorted(days) == ["2016-04-01", "2016-04-30"]


def test_period_selects_month_folders(spark, tmp_path):
    from datetime import date

    from gainledger.plans.flows import period_rows

    days = [f"2016-{m:02d}-{d:02d}" for m in range(1, 13) for d in (1, 15, 28)]
    raw = spark.createDataFrame([("0", "600000", d, "8.5") for d in days], "sec_exch_cde string, sec_cde string, trad_date string, cls_prc string")
    ingest(raw, str(tmp_path), "sec_quot")
    table = ParquetTables(spark, str(tmp_path)).table("sec_quot")
    rows = period_rows(table, "trad_date", F.lit(date(2016, 3, 10)), F.lit(date(2016, 4, 20)))
    assert [str(r.trad_date) for r in rows.orderBy("trad_date").collect()] == ["2016-03-15", "2016-03-28", "2016-04-01", "2016-04-15"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_month" in plan
    assert len(list((tmp_path / "sec_quot").glob("data_month=*"))) == 12


HELD = "mkt_sort string, sec_acct_nbr string, cstd_unit_id string, sec_cde string, cap_type string, td_end_hold_vol long, s_date string, e_date string"


def test_holdings_are_read_by_the_period_they_are_in_force(spark, tmp_path):
    from datetime import date

    from gainledger.plans.flows import rows_in_force

    days = ["2014-12-31", "2015-01-01", "2015-06-15", "2016-03-31", "2016-04-01", "2016-04-20", "2017-01-01", "3000-12-31"]
    spells = [(a, b) for i, a in enumerate(days) for b in days[i + 1 :]] + [(None, "2016-05-01"), ("2016-01-01", None)]
    raw = spark.createDataFrame([("0", f"A{n}", "U", "600000 ", "PT", n, a, b) for n, (a, b) in enumerate(spells)], HELD)
    ingest(raw, str(tmp_path), "hold_his")
    table = ParquetTables(spark, str(tmp_path)).table("hold_his")
    assert table.count() == len(spells)
    assert (tmp_path / "hold_his/to_month=300012/from_year=2016").is_dir()
    for first, last in (("2015-01-01", "2015-01-01"), ("2016-04-01", "2016-04-20"), ("2016-03-31", "2017-06-01"), ("2018-01-01", "2018-02-01")):
        for on_end in (False, True):
            rows = rows_in_force(table, F.lit(date.fromisoformat(first)), F.lit(date.fromisoformat(last)), on_end)
            assert rows.columns == SOURCES["hold_his"].names
            wanted = [n for n, (a, b) in enumerate(spells) if a and b and a <= last and (b > first or on_end and b == first)]
            assert sorted(int(r.td_end_hold_vol) for r in rows.collect()) == wanted
    # The last period meets open rows only: folders that ended before it are neither listed nor read.
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(to_month" in plan and "from_year" in plan
    assert {f.split("to_month=")[1].split("/")[0] for f in rows.select("_metadata.file_path").distinct().toPandas()["file_path"]} == {"300012"}


def test_busy_month_is_written_by_many_tasks(spark, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    raw = spark.range(60_000).selectExpr(
        "'0' AS sec_exch_cde", "lpad(id, 6, '0') AS sec_cde", "'2016-05-03' AS trad_date", "id * 0.01 AS cls_prc"
    )
    ingest(raw, str(tmp_path), "sec_quot")
    for name in settings:
        spark.conf.unset(name)
    assert len(list((tmp_path / "sec_quot/data_month=201605").glob("*.parquet"))) > 1


def test_ingest_trims_and_types(spark, tmp_path):
    raw = spark.createDataFrame([("0 ", "600000  ", "2016-04-05", "12.5")], "sec_exch_cde string, sec_cde string, trad_date string, cls_prc string")
    ingest(raw, str(tmp_path), "sec_quot")
    [row] = ParquetTables(spark, str(tmp_path)).table("sec_quot").collect()
    assert (row.sec_exch_cde, row.sec_cde, str(row.trad_date), float(row.cls_prc)) == ("0", "600000", "2016-04-05", 12.5)


def test_empty_slice_replaces_old_rows(spark, tmp_path):
    rows = spark.createDataFrame([("x", "b1")], "v string, batch string")
    root = str(tmp_path / "t")
    replace_slice(rows, root, batch="b1")
    replace_slice(rows.limit(0), root, batch="b1")
    assert spark.read.schema(rows.schema).parquet(root).count() == 0


def test_workspace_uses_the_named_folder(spark, tmp_path):
    assert shared_folder(spark) == shared_folder(spark)
    stored = Workspace(spark).store(spark.range(3).toDF("n"), "numbers")
    assert sorted(r.n for r in stored.collect()) == [0, 1, 2]


def test_fake_tables_have_declared_schemas(spark):
    for name, schema in SOURCES.items():
        assert FakeTables(spark).table(name).schema == schema
