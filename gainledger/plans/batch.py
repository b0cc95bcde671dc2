"""A whole run: universes, shared sets, ledger, gap, report, with replaceable results."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import duplicate_keys, require_unique
from ..operators.sizing import bound_tasks, broadcast_if_small, fits_broadcast, shuffle_less, split_shuffles
from ..operators.store import Workspace, extend_slice, read_slice, replace_slice, slice_path
from ..sources.jobs import DONE, FAILED, RUNNING, Job, record_status, split_values
from ..sources.lists import read_list
from ..sources.schemas import INSTRUMENTS, INVESTORS, LEDGER, REPORT
from . import sse, szse, universe
from .flows import (
    AT_BOUND,
    AT_EVENT,
    EXCHANGE_0,
    EXCHANGE_1,
    LEDGER_COLUMNS,
    Inputs,
    Scope,
    Tables,
    period_quotes,
    scope_holdings,
)
from .report import LITERAL, REPORT_COLUMNS, final_report
from .valuation import boundary_asks, boundary_holdings, holding_gap, quote_bounds

RULE_SETS = {EXCHANGE_0: sse, EXCHANGE_1: szse}


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- shared sets and the ledger -----------------------------------------------------------


def stored_scope(scope: Scope, work: Workspace) -> Scope:
    """The scope with its universes written out and counted.

    Both take part in every rule. Written once they are not derived again in each plan, and
    their counted size decides whether they are broadcast.
    """
    bound_tasks(work.spark)
    stored = work.store_all(
        {"accounts": lambda: scope.accounts, "instruments": lambda: scope.instruments}
    )
    many = not fits_broadcast(stored["instruments"])
    if many:
        shuffle_less(work.spark)
        split_shuffles(work.spark, stored["instruments"].count())
    return replace(scope, by_security=many, **{name: broadcast_if_small(df) for name, df in stored.items()})


def with_shared_sets(inputs: Inputs, work: Workspace, exchanges: list[str]) -> Inputs:
    """Store what several rules read: each large source is then scanned once per run.

    Quotes, transfer lines and changes are summed to days; holdings are reduced to the days
    that any rule or boundary asks for. The scope of `inputs` is a stored one.
    """
    scope = inputs.scope
    makers = {
        "quotes": lambda: period_quotes(inputs.tables, scope),
        "event_asks": lambda: event_asks(inputs, exchanges),
    }
    if EXCHANGE_0 in exchanges:
        makers["transfer_lines"] = lambda: sse.daily_transfer_lines(inputs)
    if EXCHANGE_1 in exchanges:
        makers["changes"] = lambda: szse.daily_changes(inputs)
    shared = work.store_all(makers)
    shared["quotes"] = broadcast_if_small(shared["quotes"])
    shared["bounds"] = broadcast_if_small(work.store(quote_bounds(shared["quotes"]), "bounds"))
    asks = work.store(marked_asks(shared.pop("event_asks"), boundary_asks(shared["bounds"])), "asks")
    shared["held"] = work.store(scope_holdings(inputs.tables, scope, asks), "held")
    held = Inputs(inputs.tables, scope, shared, work)
    # Both gaps and the report read the boundary.
    shared["boundary"] = work.store(boundary_holdings(held), "boundary")
    return Inputs(inputs.tables, scope, shared, work)


def event_asks(inputs: Inputs, exchanges: list[str]) -> DataFrame:
    """The (exch, sec_cde, ask_date) at which the rules look up holdings."""
    return union_all(
        make(inputs).select(F.lit(exch).alias("exch"), "sec_cde", "ask_date")
        for exch in exchanges
        for make in RULE_SETS[exch].HOLDING_EVENTS
    ).distinct()


def marked_asks(events: DataFrame, bounds: DataFrame) -> DataFrame:
    """All asked days, each with what asks for it: rules and boundary read only their own holdings."""
    both = events.withColumn(AT_EVENT, F.lit(True)).unionByName(
        bounds.withColumn(AT_BOUND, F.lit(True)), allowMissingColumns=True
    )
    marks = [F.bool_or(F.coalesce(mark, F.lit(False))).alias(mark) for mark in (AT_EVENT, AT_BOUND)]
    return both.groupBy("exch", "sec_cde", "ask_date").agg(*marks)


def flow_rows(inputs: Inputs, exch: str) -> DataFrame:
    """All flow rules of one exchange, as one ledger set."""
    return union_all(rule(inputs) for rule in RULE_SETS[exch].RULES.values())


def ledger_of(inputs: Inputs, work: Workspace, exchanges: list[str]) -> DataFrame:
    """The whole ledger: stored flows plus the gap rows that follow from them.

    One write per exchange: the planner re-plans a running query after each of its stages, so
    two unions of ten rules cost less than one of twenty.
    """
    stored = work.store_all({f"flows_{exch}": partial(flow_rows, inputs, exch) for exch in exchanges})
    flows = union_all(stored.values())
    gaps = [holding_gap(inputs, flows, exch) for exch in exchanges]
    return union_all([flows, *gaps]).select(*LEDGER_COLUMNS)


# --- universes of a job -------------------------------------------------------------------


def job_instruments(
    spark: SparkSession, job: Job, tables: Tables, lists: str, rejects_to: str | None = None
) -> DataFrame:
    info = tables.table("sec_info")
    if job.obj_type == "1":
        if job.obj_content == universe.A_SHARE:
            return universe.all_shares(info, job.s_date, job.exchanges)
        return universe.board_shares(info, job.s_date, job.exchanges, job.obj_content)
    items = read_list(spark, f"{lists}/{job.obj_content}", rejects_to=rejects_to)
    return universe.listed_shares(info, job.s_date, job.exchanges, items)


def job_investors(
    spark: SparkSession, job: Job, tables: Tables, lists: str, rejects_to: str | None = None
) -> DataFrame:
    accounts = tables.table("intg_sec_acct")
    if job.invst_sort in (universe.OWNER, universe.ACCOUNT):
        items = read_list(spark, f"{lists}/{job.invst_content}", rejects_to=rejects_to)
        return universe.investors_from_list(accounts, items, job.invst_sort, job.s_date)
    wanted = split_values(job.invst_content)
    classes = tables.table("invst_clsf_his")
    return universe.investors_of_classes(accounts, classes, wanted, job.s_date, job.e_date)


# --- the run ------------------------------------------------------------------------------


RESULTS = {"instruments": INSTRUMENTS, "investors": INVESTORS, "ledger": LEDGER, "report": REPORT}


@dataclass(frozen=True)
class Results:
    """Result tables below one folder; every batch replaces only its own slices."""

    spark: SparkSession
    root: str

    @property
    def status_path(self) -> str:
        return f"{self.root}/status"

    def slice(self, name: str, **slice_of: str) -> DataFrame:
        return read_slice(self.spark, RESULTS[name], f"{self.root}/{name}", **slice_of)

    def instruments(self) -> DataFrame:
        return self.spark.read.schema(INSTRUMENTS).parquet(f"{self.root}/instruments")

    def investors(self) -> DataFrame:
        return self.spark.read.schema(INVESTORS).parquet(f"{self.root}/investors")

    def ledger(self) -> DataFrame:
        rows = self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger")
        return rows.select(*LEDGER_COLUMNS)

    def report(self) -> DataFrame:
        rows = self.spark.read.schema(REPORT).parquet(f"{self.root}/report")
        return rows.select(*REPORT_COLUMNS)


def run_batch(
    spark: SparkSession,
    job: Job,
    tables: Tables,
    out: str,
    lists: str = ".",
    top10: str = LITERAL,
) -> DataFrame:
    """Compute one batch and return its report.

    The status log says running from the start and done or failed at the end, whatever happens
    in between, and the run's intermediate tables are removed then. Running a batch again replaces
    its slices and leaves other batches alone. Lines rejected from uploaded lists are kept below
    `rejects`, also when they fail the run.
    """
    results = Results(spark, out.rstrip("/"))
    record_status(spark, results.status_path, job.batch, RUNNING)
    status = FAILED
    work = Workspace(spark, tidy=True)
    try:
        report = _compute(spark, job.check(), tables, results, lists, top10, work)
        status = DONE
        return report
    finally:
        work.remove()
        record_status(spark, results.status_path, job.batch, status)


def _compute(
    spark: SparkSession, job: Job, tables: Tables, results: Results, lists: str, top10: str, work: Workspace
) -> DataFrame:
    root, batch = results.root, job.batch

    codes = job_instruments(spark, job, tables, lists, slice_path(f"{root}/rejects/instruments", batch=batch))
    replace_slice(codes, f"{root}/instruments", batch=batch)  # distinct by construction
    investors = job_investors(spark, job, tables, lists, slice_path(f"{root}/rejects/investors", batch=batch))
    replace_slice(investors, f"{root}/investors", batch=batch)
    stored = results.slice("investors", batch=batch)
    accounts = universe.batch_accounts(require_unique(stored, ["prmt_val"], "investors").drop("batch"))
    codes = results.slice("instruments", batch=batch).select("sec_cde")
    instruments = universe.exchange_instruments(tables.table("sec_info"), job.s_date, codes)

    scope = stored_scope(Scope(batch, job.s_date, job.e_date, accounts, instruments), work)
    # Holdings are valued by code, so a code must not stand for an instrument on both exchanges.
    require_unique(scope.instruments, ["sec_cde"], "instruments of both exchanges")
    inputs = with_shared_sets(Inputs(tables, scope), work, job.exchanges)
    require_unique(inputs.quotes(), ["exch", "sec_cde", "day"], "quotes")
    if EXCHANGE_1 in job.exchanges:
        for issue in duplicate_keys(szse.listed_issues(inputs), ["stk_cde", "fi_list_date"]).take(1):
            warnings.warn(f"several issue prices multiply volumes, e.g. {issue.asDict()}", stacklevel=3)

    for exch in ("0", "1"):
        if exch not in job.exchanges:
            continue
        replace_slice(flow_rows(inputs, exch), f"{root}/ledger", batch=batch, exch=exch)
        flows = results.slice("ledger", batch=batch, exch=exch).select(*LEDGER_COLUMNS)
        gap = work.store(holding_gap(inputs, flows, exch), f"gap_{exch}")
        extend_slice(gap, f"{root}/ledger", batch=batch, exch=exch)

    parts = [results.slice("ledger", batch=batch, exch=exch) for exch in ("0", "1") if exch in job.exchanges]
    ledger = union_all(parts).select(*LEDGER_COLUMNS)
    report = final_report(inputs, ledger, job.commission, top10)
    replace_slice(report, f"{root}/report", batch=batch)
    return results.slice("report", batch=batch).select(*REPORT_COLUMNS)
