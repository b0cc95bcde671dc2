"""Mixing sources to target weights by entropy balancing.

Each source has a token target. Among all document rates that meet it, the one closest to taking
every document once (in relative entropy) is an exponential tilt of the document sizes; its one
unknown per source is found by Newton iterations on the convex dual. Rates become whole copies.

Documents of one source and size share their rate, so all iterations run over the table of
(source, size) counts, and no step needs the documents of a source in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .common import WORD, free_name, lookup, numbered, text_of

# Fixed values of the contract: weights by source in code point order, the part of all sizes that is
# shared out, and how often a source or a document may be taken.
WEIGHTS = [5, 2, 1]
SHARE = 1.5
MOST = 2

# Newton steps, each halved into the bracket when it leaves it, and when they are near enough.
NEWTON_ROUNDS = 40
NEAR = 1e-9
# Rounds of mending what rounding left, and documents ranked together.
MENDING_ROUNDS = 6
ROWS_PER_CELL = 10_000


def words(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of each source, from rows (source, source_size), one per source.

    Targets are in proportion to the weights, but none is above MOST times its source's size: the
    sources are filled up in the order in which a rising level reaches that bound.
    """
    place = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.row_number().over(place) - 1) % len(WEIGHTS) + 1
    )
    total = F.sum("source_size").over(W.partitionBy()) * SHARE
    filled = sizes.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size").cast("double"))
    # Filled up as soon as the level, the words for a weight of one, reaches cap / weight.
    level = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = level.rowsBetween(W.unboundedPreceding, -1)
    onward = level.rowsBetween(0, W.unboundedFollowing)
    reach = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    filled = filled.withColumn("reach", reach)
    # Once one source is not filled up, no later one is, and all share the level found there.
    open_level = F.min(F.when(F.col("reach") * F.col("weight") < F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "reach")))
    filled = filled.withColumn("open", open_level.over(W.partitionBy())["reach"])
    target = F.least("cap", F.coalesce(F.col("open") * F.col("weight"), F.col("cap")))
    return filled.select("source", "source_size", target.alias("target"))


def tilt(lam: Column, x: Column) -> Column:
    """The rate of a document: exponential in its relative size, at most MOST."""
    return F.least(F.lit(float(MOST)), F.exp(F.least(F.lit(50.0), lam * x)))


def balanced(histogram: DataFrame, targets: DataFrame, work: Workspace) -> DataFrame:
    """Adds `rate` to (source, size, n) rows so that sum(n * size * rate) is the source's target.

    The dual of each source is one-dimensional and convex; its slope is what is taken beyond the
    target. Sizes are damped to x between 1/2 and 1, so that long documents neither vanish nor crowd
    out the others.
    """
    mean = F.sum(F.col("n") * F.col("size")).over(W.partitionBy("source")) / F.sum("n").over(W.partitionBy("source"))
    x = F.lit(0.5) + F.lit(0.5) * F.col("size") / (F.col("size") + mean)
    same = F.col("source").eqNullSafe(F.col("t_source"))
    known = lookup(targets.select(F.col("source").alias("t_source"), "target"))
    rows = histogram.filter("size > 0").withColumn("x", x).join(known, same).drop("t_source")
    rows = work.store(rows, "mix_rows")

    state = work.store(
        rows.groupBy("source").agg(
            F.lit(0.0).alias("lam"), F.lit(-60.0).alias("low"), F.lit(2.0).alias("high"), F.lit(1.0).alias("off")
        ),
        "mix_state_0",
    )
    for k in range(1, NEWTON_ROUNDS + 1):
        now = lookup(state.select(F.col("source").alias("s_source"), "lam", "low", "high"))
        rate = tilt(F.col("lam"), F.col("x"))
        tokens = F.col("n") * F.col("size")
        bend = F.when(rate < MOST, tokens * F.col("x") * rate).otherwise(0.0)
        sums = (
            rows.join(now, F.col("source").eqNullSafe(F.col("s_source")))
            .groupBy("source", "lam", "low", "high")
            .agg(F.sum(tokens * rate).alias("taken"), F.sum(bend).alias("bend"), F.first("target").alias("target"))
        )
        slope = F.col("taken") - F.col("target")
        low = F.when(slope < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(slope < 0, F.col("high")).otherwise(F.col("lam"))
        step = F.col("lam") - slope / F.col("bend")
        inside = (F.col("bend") > 0) & (step > low) & (step < high)
        new = F.when(slope == 0, F.col("lam")).when(inside, step).otherwise((low + high) / 2)
        off = F.abs(slope) / F.greatest(F.lit(1.0), F.col("target"))
        stepped = sums.select("source", new.alias("lam"), low.alias("low"), high.alias("high"), off.alias("off"))
        state = work.store(stepped, f"mix_state_{k}")
        # A bracket that has closed up is as near as doubles come.
        if not state.filter((F.col("off") > NEAR) & (F.col("high") - F.col("low") > 1e-13)).take(1):
            break
    now = lookup(state.select(F.col("source").alias("s_source"), "lam"))
    return rows.join(now, F.col("source").eqNullSafe(F.col("s_source"))).select(
        "source", "size", "n", "target", F.round(tilt(F.col("lam"), F.col("x")), 9).alias("rate")
    )


def mix(
    docs: DataFrame, work: Workspace, id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """One row per input row: id, size, source, source_size, target, copies (0, 1 or 2).

    The words taken from a source come within a few short documents of its target. Null sources form
    one source, the last; null and blank texts have size 0 and one copy; null ids and repeated rows
    are treated like any other; an empty table gives no rows. What is chosen depends on the rows
    only, not on how they are stored.
    """
    return mixed_rows(docs, work, id, text, source, F.lit(0)).drop("row")


def mixed_rows(docs: DataFrame, work: Workspace, id: str, text: str, source: str, row: Column) -> DataFrame:
    """`mix` with `row`, which only decides between rows that are equal in id and text."""
    return handed_out(*planned(docs, work, id, text, source, row), work)


def sized(id: str, text: str, source: str, row: Column) -> dict[str, Column]:
    """What the mix reads of a row. Rows of one source and size are taken in the order of their luck."""
    return {
        "row": row.cast("long"),
        "id": F.col(id),
        "source": F.col(source),
        "size": words(text),
        "luck": F.xxhash64(F.col(id), F.col(text), F.lit(3)),
    }


def planned(
    docs: DataFrame, work: Workspace, id: str, text: str, source: str, row: Column
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stored rows without their texts, whole copies and counts of each (source, size), and targets."""
    rows = docs.select(*[how.alias(name) for name, how in sized(id, text, source, row).items()])
    rows = work.store(rows, "mix_sized")
    histogram = work.store(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix_histogram")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = work.store(source_targets(sizes), "mix_targets")
    plan = mended(rounded(balanced(histogram, targets, work), work), work)
    return rows, plan, histogram, targets


def rounded(rated: DataFrame, work: Workspace) -> DataFrame:
    """Whole copies of each (source, size): every row gets the whole part of its rate, and how many
    rows get one more follows from running sums over the sizes, so that rounding never adds up."""
    part = F.col("n") * (F.col("rate") - F.floor("rate"))
    by_size = W.partitionBy("source").orderBy("size")
    running = rated.withColumn("upto", F.round(F.sum(part).over(by_size.rowsBetween(W.unboundedPreceding, 0)), 6))
    more = F.floor(F.col("upto") + 0.5) - F.floor(F.lag("upto", 1, 0.0).over(by_size) + 0.5)
    copies = (F.col("n") * F.floor("rate") + more).cast("long")
    return work.store(running.select("source", "size", "n", "target", F.least(MOST * F.col("n"), copies).alias("copies")), "mix_plan_0")


def mended(plan: DataFrame, work: Workspace) -> DataFrame:
    """Adds or takes away single copies of the size nearest to what a source still misses."""
    for k in range(1, MENDING_ROUNDS + 1):
        taken = plan.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        taken = lookup(work.store(taken.withColumnRenamed("source", "t_source"), f"mix_taken_{k}"))
        missing = plan.join(taken, F.col("source").eqNullSafe(F.col("t_source")))
        gap = F.col("target") - F.col("taken")
        able = F.when(gap > 0, F.col("copies") < MOST * F.col("n")).otherwise(F.col("copies") > 0)
        left = F.abs(F.abs(gap) - F.col("size"))
        nearest = (
            missing.filter(able & (left < F.abs(gap)))
            .groupBy("source")
            .agg(F.min(F.struct(left.alias("left"), "size", F.signum(gap).cast("long").alias("by"))).alias("m"))
            .select(F.col("source").alias("m_source"), F.col("m.size").alias("m_size"), F.col("m.by").alias("by"))
        )
        nearest = work.store(nearest, f"mix_mend_{k}")
        if not nearest.take(1):
            break
        meets = F.col("source").eqNullSafe(F.col("m_source")) & (F.col("size") == F.col("m_size"))
        copies = F.col("copies") + F.coalesce("by", F.lit(0))
        plan = plan.join(lookup(nearest), meets, "left").select("source", "size", "n", "target", copies.alias("copies"))
        plan = work.store(plan, f"mix_plan_{k}")
    return plan


def cell_of(luck: Column, cells: Column) -> Column:
    """The cell of a row, of as many as its (source, size) has."""
    return F.pmod(F.shiftright(luck, 20), cells)


def dealt_to_cells(
    rows: DataFrame, plan: DataFrame, histogram: DataFrame, work: Workspace
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """How the copies of each (source, size) are given to its rows, in the order of a hash.

    The rows of one (source, size) are ranked in cells of bounded size, so that a large group of
    copies is no task of its own, and the cells follow each other by their counts. Returns how many
    cells each (source, size) of several has, the rows with their cell, and what begins where:
    (s_source, s_size, s_cell, m rows, start, each, more).
    """
    cells = histogram.select(
        F.col("source").alias("h_source"), F.col("size").alias("h_size"), F.ceil(F.col("n") / ROWS_PER_CELL).alias("cells")
    ).filter("cells > 1")
    cells = work.store(cells, "mix_cells")
    at = F.col("source").eqNullSafe(F.col("h_source")) & (F.col("size") == F.col("h_size"))
    cell = cell_of(F.col("luck"), F.coalesce("cells", F.lit(1)))
    celled = rows.join(lookup(cells), at, "left").withColumn("cell", cell)
    counts = celled.groupBy("source", "size", "cell").agg(F.count("*").alias("m"))
    before = W.partitionBy("source", "size").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    given = plan.select(
        F.col("source").alias("p_source"),
        F.col("size").alias("p_size"),
        F.floor(F.col("copies") / F.col("n")).alias("each"),
        (F.col("copies") % F.col("n")).alias("more"),
    )
    starts = counts.withColumn("start", F.coalesce(F.sum("m").over(before), F.lit(0))).join(
        given, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")), "left"
    )
    starts = starts.select(
        F.col("source").alias("s_source"),
        F.col("size").alias("s_size"),
        F.col("cell").alias("s_cell"),
        "m",
        "start",
        F.coalesce("each", F.lit(1)).alias("each"),
        F.coalesce("more", F.lit(0)).alias("more"),
    )
    return cells, celled, work.store(starts, "mix_starts")


HERE = "source <=> s_source AND size = s_size AND cell = s_cell"


def handed_out(
    rows: DataFrame, plan: DataFrame, histogram: DataFrame, targets: DataFrame, work: Workspace
) -> DataFrame:
    """Every row with its copies and the figures of its source."""
    _, celled, starts = dealt_to_cells(rows, plan, histogram, work)
    known = lookup(targets.withColumnRenamed("source", "t_source"))
    rank = F.row_number().over(W.partitionBy("source", "size", "cell").orderBy("luck", "id", "row"))
    copies = F.col("each") + (F.col("start") + F.col("rank") <= F.col("more")).cast("long")
    return (
        celled.withColumn("rank", rank)
        .join(lookup(starts), F.expr(HERE))
        .join(known, F.col("source").eqNullSafe(F.col("t_source")))
        .select("row", "id", "size", "source", "source_size", "target", copies.alias("copies"))
    )


def take_copies(
    docs: DataFrame, work: Workspace, id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with their own columns only.

    Texts are not moved to a decision per row. In the order in which a (source, size) is handed out
    its first rows get one copy more than the others, so the row at that edge says it for all: the
    edges, one row per (source, size), are sent to the texts. `docs` is as read from files, or else
    copied once. Tables as `mix` takes them are taken here, the empty one too.
    """
    work = work.inner()
    row = free_name(docs, "row_number")
    rows = numbered(docs, work, row)
    read = sized(id, text, source, F.col(row))
    cells, celled, starts = dealt_to_cells(*planned(rows, work, id, text, source, F.col(row))[:3], work)
    want = F.col("more") - F.col("start")
    edges = work.store(starts.filter((want > 0) & (want <= F.col("m"))).withColumn("want", want), "mix_edges")
    place = F.row_number().over(W.partitionBy("source", "size", "cell").orderBy("luck", "id", "row"))
    last = celled.join(lookup(edges), F.expr(HERE)).withColumn("place", place).filter("place = want")
    last = last.select("s_source", "s_size", F.struct("cell", "luck", "id", "row").alias("edge"))
    given = starts.groupBy("s_source", "s_size").agg(F.first("each").alias("each"))
    sizes = given.alias("g").join(last.alias("l"), F.expr("g.s_source <=> l.s_source AND g.s_size = l.s_size"), "left")
    sizes = sizes.select(F.col("g.s_source").alias("s_source"), F.col("g.s_size").alias("s_size"), "each", "edge")
    sizes = sizes.join(cells, F.expr("s_source <=> h_source AND s_size = h_size"), "left")
    name = free_name(docs, "given")
    found = F.struct("each", F.coalesce("cells", F.lit(1)).alias("cells"), "edge").alias(name)
    source_name, size_name = free_name(docs, "given_source"), free_name(docs, "given_size")
    sizes = sizes.select(F.col("s_source").alias(source_name), F.col("s_size").alias(size_name), found)
    sizes = lookup(work.store(sizes, "mix_given"))
    work.remove(keep=[f"{row}_input", f"{row}_files", "mix_given"])

    here = read["source"].eqNullSafe(F.col(source_name)) & (read["size"] == F.col(size_name))
    cell = cell_of(read["luck"], F.col(f"{name}.cells"))
    mine = F.struct(cell.alias("cell"), *[read[x].alias(x) for x in ("luck", "id", "row")])
    more = F.coalesce(mine <= F.col(f"{name}.edge"), F.lit(False)).cast("long")
    copies = F.col(f"{name}.each") + more
    columns = [f"`{c}`" for c in docs.columns]
    times = free_name(docs, "times")
    taken = rows.join(sizes, here).withColumn(times, copies).filter(F.col(times) > 0)
    return taken.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*columns)
