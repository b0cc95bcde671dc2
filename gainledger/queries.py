"""The registered queries: every operator over the given tables.

Each takes (spark, folder) and returns a DataFrame whose columns have plain types, so that
another engine's result can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.checks import duplicate_keys
from .operators.store import Workspace
from .plans import sse, szse, universe
from .plans.batch import Results, ledger_of, run_batch, stored_scope, with_shared_sets
from .plans.flows import Inputs, Scope
from .plans.report import (
    PER_SECURITY,
    REPORT_COLUMNS,
    business_sums,
    classes_at_end,
    commission,
    executives,
    final_report,
    latest_accounts,
    owner_holdings,
    top_holder_flags,
    top_holders,
    unlocked_holders,
)
from .plans.valuation import (
    GAP,
    PAIR,
    boundary_asks,
    boundary_values,
    net_change,
    quote_bounds,
    run_bounds,
)
from .sources.jobs import job_log, job_row, latest_status, read_job, status_log
from .sources.lists import distinct_items
from .sources.parquet_tables import ParquetTables, ingest
from .sources.schemas import JOB
from .sources.star_tables import StarTables

# The job the queries run: five of the seven years, all accounts and all A-shares, both exchanges.
BATCH = "000001"
START = date(1996, 1, 1)
END = date(2000, 12, 31)
EXCHANGES = ["0", "1"]
RATE = Decimal("0.00200")
CLASSES = ["2810", "2310", "1110", "1540"]

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Whole decimals and counts as long, other decimals as double, dates and times as text."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            kind = "bigint" if f.dataType.scale == 0 else "double"
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            kind = "string"
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            kind = "bigint"
        else:
            kind = None
        columns.append(F.col(f.name).cast(kind).alias(f.name) if kind else F.col(f.name))
    return df.select(*columns)


def inputs_of(
    spark: SparkSession, folder: str, exchanges: list[str] = EXCHANGES, tables: StarTables | None = None
) -> Inputs:
    """All accounts open after the start and all A-shares, stored, as one run's inputs."""
    tables = tables or StarTables(spark, folder)
    info = tables.table("sec_info")
    codes = universe.all_shares(info, START, exchanges)
    accounts = tables.table("intg_sec_acct").filter(F.col("e_date") > F.lit(START))
    scope = Scope(
        BATCH,
        START,
        END,
        accounts.select("sec_acct").distinct(),
        universe.exchange_instruments(info, START, codes),
    )
    return Inputs(tables, stored_scope(scope, Workspace(spark, tidy=True)))


def _with_ledger(
    spark: SparkSession, folder: str, exchanges: list[str] = EXCHANGES
) -> tuple[Inputs, DataFrame]:
    """A run's inputs with stored shared sets, and its whole ledger."""
    work = Workspace(spark, tidy=True)
    tables = StarTables(spark, folder).with_stored_lines(work)
    inputs = with_shared_sets(inputs_of(spark, folder, exchanges, tables), work, exchanges)
    return inputs, ledger_of(inputs, work, exchanges)


def rule_query(rule: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, folder: plain(rule(inputs_of(spark, folder)))


def gap_query(exch: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        _, ledger = _with_ledger(spark, folder, [exch])
        return plain(ledger.filter((F.col("biz_type") == GAP) & (F.col("exch") == exch)))

    return query


def on_inputs(make: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, folder: plain(make(inputs_of(spark, folder)))


def on_dates(make: Callable[[Inputs], DataFrame]) -> Query:
    """For what reads the run's period only: its universes are not stored."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = StarTables(spark, folder)
        nothing = spark.createDataFrame([], "exch string, sec_acct string, sec_cde string")
        scope = Scope(BATCH, START, END, nothing.select("sec_acct"), nothing.select("exch", "sec_cde"))
        return plain(make(Inputs(tables, scope)))

    return query


def on_tables(make: Callable[[StarTables], DataFrame]) -> Query:
    return lambda spark, folder: plain(make(StarTables(spark, folder)))


def on_ledger(make: Callable[[Inputs, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plain(make(*_with_ledger(spark, folder)))


# --- one function per query that is more than a call ----------------------------------------


def date_range_scan(inputs: Inputs) -> DataFrame:
    """Clearing lines of the period from the stored layout: the month folders select the files."""
    derived = inputs.tables.table("clr_stm_dtl")
    root = Workspace(derived.sparkSession).root
    ingest(derived, root, "clr_stm_dtl")
    inputs = replace(inputs, tables=ParquetTables(derived.sparkSession, root))
    lines = inputs.in_period("clr_stm_dtl", "trad_date")
    return lines.groupBy("trad_date").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("clr_amt").alias("clr_amt")
    )


def unique_check(tables: StarTables) -> DataFrame:
    return duplicate_keys(tables.table("clr_stm_dtl"), ["trad_nbr", "aply_nbr"])


def market_bounds(tables: StarTables) -> DataFrame:
    day = F.col("trad_date")
    quotes = tables.table("sec_quot").filter(day.between(F.lit(START), F.lit(END)))
    return quote_bounds(quotes.select(F.col("sec_exch_cde").alias("exch"), "sec_cde", day.alias("day"), "cls_prc"))


def holding_asof(inputs: Inputs) -> DataFrame:
    return inputs.held_on(boundary_asks(run_bounds(inputs)))


def open_value(inputs: Inputs) -> DataFrame:
    rows = boundary_values(inputs).select(*PAIR, "start_bal")
    return rows.filter(F.col("start_bal").isNotNull())


def close_value(inputs: Inputs) -> DataFrame:
    rows = boundary_values(inputs).select(*PAIR, "end_bal")
    return rows.filter(F.col("end_bal").isNotNull())


def top_holders_at_end(inputs: Inputs) -> DataFrame:
    """The ranking on the last day, when most securities have many owners."""
    last = Inputs(inputs.tables, replace(inputs.scope, start=END))
    return top_holders(owner_holdings(last, PER_SECURITY))


def listed_universe(tables: StarTables) -> DataFrame:
    items = distinct_items(tables.table("security_list"))
    return universe.listed_shares(tables.table("sec_info"), START, EXCHANGES, items)


def exchange_universe(tables: StarTables) -> DataFrame:
    codes = universe.all_shares(tables.table("sec_info"), START, EXCHANGES)
    return universe.exchange_instruments(tables.table("sec_info"), START, codes)


def expanded_owners(tables: StarTables) -> DataFrame:
    items = distinct_items(tables.table("owner_list"))
    accounts = tables.table("intg_sec_acct")
    return universe.investors_from_list(accounts, items, universe.OWNER, START)


def class_accounts(tables: StarTables) -> DataFrame:
    accounts, classes = tables.table("intg_sec_acct"), tables.table("invst_clsf_his")
    return universe.investors_of_classes(accounts, classes, CLASSES, START, END)


def biz_pivot(_: Inputs, ledger: DataFrame) -> DataFrame:
    wanted = [*PAIR, "non_trad_tran_incm_amt", "non_trad_tran_expdt_amt", "sprd_stock_estmt_amt", "cash_dvd"]
    return ledger.groupBy(*PAIR).agg(*business_sums()).select(*wanted)


def commissions(_: Inputs, ledger: DataFrame) -> DataFrame:
    rows = ledger.groupBy(*PAIR).agg(F.sum("buy_amt").alias("buy_amt"), F.sum("sal_amt").alias("sal_amt"))
    return rows.select(*PAIR, commission(RATE).cast("decimal(18,2)").alias("cmsn"))


def report(inputs: Inputs, ledger: DataFrame) -> DataFrame:
    return final_report(inputs, ledger, RATE)


def profits(inputs: Inputs, ledger: DataFrame) -> DataFrame:
    rows = final_report(inputs, ledger, RATE, PER_SECURITY)
    return rows.groupBy("exch", "sec_cde", "is_top10_shdr").agg(
        F.sum("brkv_amt").alias("brkv_amt"), F.count(F.lit(1)).alias("n_accounts")
    )


# --- whole batch runs -----------------------------------------------------------------------

LISTS = {"instruments.txt": "security_list", "accounts.txt": "account_list", "owners.txt": "owner_list"}


def batch_results(spark: SparkSession, folder: str, runs: int = 1, **job) -> Results:
    """The results of a job as a user runs it: uploaded lists as text, a job row, `run_batch`.

    Everything is below the run's own folder. Running again replaces the slices of the batch.
    """
    work = Workspace(spark, tidy=True)
    tables, root = StarTables(spark, folder).with_stored_lines(work), work.root
    for file, view in LISTS.items():
        lines = tables.table(view).select(F.coalesce("item_nbr", F.lit("")).alias("value"))
        lines.write.text(f"{root}/lists/{file}")
    row = dict(batch=BATCH, s_date=START, e_date=END, exclusion="00000000", calc_user="user1", status="0", **job)
    log = spark.createDataFrame([tuple(row.get(f.name) for f in JOB.fields)], JOB)
    log.write.parquet(f"{root}/jobs")
    entered = read_job(job_log(spark, f"{root}/jobs"), BATCH)
    for _ in range(runs):
        run_batch(spark, entered, tables, f"{root}/out", f"{root}/lists")
    return Results(spark, f"{root}/out")


def batch_report(spark: SparkSession, folder: str) -> DataFrame:
    """Uploaded instruments and accounts, both exchanges."""
    results = batch_results(
        spark, folder, obj_type="2", obj_content="instruments.txt", invst_sort=universe.ACCOUNT,
        invst_content="accounts.txt", exch="3", commission=RATE,
    )
    return plain(results.slice("report", batch=BATCH).select(*REPORT_COLUMNS))


def batch_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Uploaded owners, run twice: the second run replaces what the first one wrote."""
    results = batch_results(
        spark, folder, runs=2, obj_type="1", obj_content=universe.A_SHARE, invst_sort=universe.OWNER,
        invst_content="owners.txt", exch="3", commission=RATE,
    )
    return plain(results.ledger().filter(F.col("batch") == BATCH))


def batch_investors(spark: SparkSession, folder: str) -> DataFrame:
    """Investor classes given as a comma list, one exchange; with the batch's last status."""
    results = batch_results(
        spark, folder, obj_type="1", obj_content="2", invst_sort="3", invst_content=", ".join(CLASSES),
        exch="1", commission=Decimal(0),
    )
    status = latest_status(status_log(spark, results.status_path)).select("batch", "status")
    return plain(results.slice("investors", batch=BATCH).join(status, "batch").select("prmt_type", "prmt_val", "status"))


QUERIES: dict[str, Query] = {
    # scans and sources
    "q_job_params": on_tables(lambda t: job_row(t.table("job_log"), BATCH)),
    "q_list_dedupe": on_tables(lambda t: distinct_items(t.table("security_list"))),
    "q_date_range_scan": on_dates(date_range_scan),
    "q_status_latest": on_tables(lambda t: latest_status(t.table("status_event"), "seq")),
    "q_unique_check": on_tables(unique_check),
    # universes
    "q_universe_all": on_tables(lambda t: universe.all_shares(t.table("sec_info"), START, EXCHANGES)),
    "q_universe_board": on_tables(
        lambda t: universe.board_shares(t.table("sec_info"), START, EXCHANGES, "2")
    ),
    "q_universe_list": on_tables(listed_universe),
    "q_universe_exch": on_tables(exchange_universe),
    "q_invest_list": on_tables(
        lambda t: universe.uploaded_investors(distinct_items(t.table("account_list")), universe.ACCOUNT)
    ),
    "q_invest_expand": on_tables(expanded_owners),
    "q_invest_class": on_tables(class_accounts),
    # exchange 0
    "q_sse_trade": rule_query(sse.trades),
    "q_sse_margin": rule_query(sse.margin_trades),
    "q_sse_transfer": rule_query(sse.transfers),
    "q_sse_ipo": rule_query(sse.ipo),
    "q_sse_followon": rule_query(sse.follow_on),
    "q_sse_incentive": rule_query(sse.incentive),
    "q_sse_rights": rule_query(sse.rights_issue),
    "q_sse_bonus": rule_query(sse.bonus),
    "q_sse_dividend": rule_query(sse.dividend),
    "q_sse_conversion": rule_query(sse.conversion),
    "q_sse_etf": rule_query(sse.fund_units),
    "q_sse_gap": gap_query("0"),
    # exchange 1
    "q_szse_trade": rule_query(szse.trades),
    "q_szse_transfer": rule_query(szse.transfers),
    "q_szse_ipo": rule_query(szse.ipo),
    "q_szse_followon": rule_query(szse.follow_on),
    "q_szse_incentive": rule_query(szse.incentive),
    "q_szse_rights": rule_query(szse.rights_issue),
    "q_szse_bonus": rule_query(szse.bonus),
    "q_szse_dividend": rule_query(szse.dividend),
    "q_szse_conversion": rule_query(szse.conversion),
    "q_szse_etf": rule_query(szse.fund_units),
    "q_szse_gap": gap_query("1"),
    # valuation
    "q_quote_bounds": on_tables(market_bounds),
    "q_holding_asof": on_inputs(holding_asof),
    "q_open_value": on_inputs(open_value),
    "q_close_value": on_inputs(close_value),
    "q_net_change": on_ledger(lambda _, ledger: net_change(ledger)),
    "q_ledger_all": on_ledger(lambda _, ledger: ledger),
    # report
    "q_latest_account": on_dates(latest_accounts),
    "q_class_asof": on_dates(classes_at_end),
    "q_flag_executive": on_dates(executives),
    "q_flag_lockup": on_inputs(unlocked_holders),
    "q_top10_holder": on_inputs(top_holders_at_end),
    "q_flag_top10_literal": on_inputs(top_holder_flags),
    "q_biz_pivot": on_ledger(biz_pivot),
    "q_commission": on_ledger(commissions),
    "q_profit": on_ledger(profits),
    "q_final_report": on_ledger(report),
    # whole runs
    "q_batch_report": batch_report,
    "q_batch_ledger": batch_ledger,
    "q_batch_investors": batch_investors,
}
