"""Near-duplicate embeddings by sorted projection passes.

In every pass the vectors of a label are ordered lexicographically by the signs of random
projections, and each is compared with a bounded window of its neighbours in that order. Verified
pairs of all passes are united. Equal vectors are one class throughout, so that a vector repeated
many times does not fill the windows.

In a dense label many vectors lie between two that link, and a window ends where its task's range
does, so windows miss some links. What is wanted are groups, so an exact last step compares whole
blocks of a label, but for pairs already in one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .common import lookup
from .components import connected

# Passes, sign bits of an order, and neighbours compared on each side.
PASSES = 10
BITS = 48
WINDOW = 100
# Rows multiplied at once, and vectors in one block of the counting step.
ROWS = 256
BLOCK = 512
# Bytes of vectors in one block of the last step, and numbers multiplied at once to verify pairs.
REST_BYTES = 32 << 20
NUMBERS = 4 << 20


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def stored_vectors(rows: DataFrame, work: Workspace, id: str, vector: str, label: str) -> DataFrame:
    """row, id, label, dim, raw (doubles as bytes), key of its class; raw is null if it links with nothing."""
    kind, mark = rows.schema[id].dataType.simpleString(), rows.schema[label].dataType.simpleString()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, raws = [], []
            labels = batch.column(2).to_pylist()
            for value, name in zip(batch.column(1), labels, strict=True):
                values = value.values
                raw = None
                if name is not None and values is not None and len(values) and not values.null_count:
                    x = values.to_numpy().astype("<f8")
                    # A scaled copy has the same angles and no norm that overflows or vanishes.
                    top = np.abs(x).max()
                    raw = (x / top).tobytes() if np.isfinite(x).all() and top > 0 else None
                dims.append(len(values) if raw else 0)
                raws.append(raw)
            columns = [batch.column(0), batch.column(2), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "dim", "raw"])

    plain = rows.select(F.col(id).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    cleaned = plain.mapInArrow(clean, f"id {kind}, label {mark}, dim int, raw binary")
    return work.store(
        cleaned.select(
            F.monotonically_increasing_id().alias("row"),
            "*",
            F.when(F.col("raw").isNotNull(), F.sha2(F.concat(F.col("label").cast("string").cast("binary"), F.lit(b"|"), "raw"), 256)).alias("key"),
        ),
        "vector_rows",
    )


def window_links(classes: DataFrame, threshold: float, passes: int = PASSES, window: int = WINDOW) -> DataFrame:
    """(a, b) rows that join classes found near each other; enough of them to connect all found."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([19, int(dim)]).standard_normal((int(dim), passes * BITS))
                for small in (part.slice(i, 2048) for i in range(0, part.num_rows, 2048)):
                    signs = unit(small.column(3).to_pylist(), int(dim)) @ planes[dim] > 0
                    keys = np.packbits(signs.reshape(-1, BITS), axis=1)
                    n = small.num_rows
                    repeat = pa.array(np.repeat(np.arange(n), passes))
                    columns = [pa.array(np.tile(np.arange(passes, dtype=np.int32), n))]
                    columns += [small.column(i).take(repeat) for i in range(4)]
                    columns.append(pa.array([k.tobytes() for k in keys], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, ["pass", "class", "label", "dim", "raw", "order"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            step = max(4 * window, (16 << 20) // (8 * max(1, batch.column(2)[0].as_py())))
            for begin in range(0, batch.num_rows, step):
                rows = held + list(zip(*(c.to_pylist() for c in batch.slice(begin, step).columns), strict=True))
                fresh = len(held)
                held = rows[-window:]
                pairs = set()
                start = 0
                while start < len(rows):  # one run of pass, label and dimension after the other
                    run = rows[start][:3]
                    end = start
                    while end < len(rows) and rows[end][:3] == run:
                        end += 1
                    if end > fresh and end - start > 1:
                        x = unit([r[4] for r in rows[start:end]], run[2])
                        names = [r[3] for r in rows[start:end]]
                        root = list(range(end - start))

                        def find(i: int) -> int:
                            while root[i] != i:
                                root[i] = root[root[i]]
                                i = root[i]
                            return i

                        for at in range(0, end - start, ROWS):
                            near = x[at : at + ROWS] @ x[at : at + ROWS + window].T >= threshold
                            i, j = np.nonzero(near)
                            ahead = (j > i) & (j - i <= window)
                            for p, q in zip((i[ahead] + at).tolist(), (j[ahead] + at).tolist(), strict=True):
                                p, q = find(p), find(q)
                                if p != q:
                                    root[q] = p
                                    pairs.add((names[p], names[q]))
                    start = end
                if pairs:
                    a, b = zip(*sorted(pairs), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    mark = classes.schema["label"].dataType.simpleString()
    ordered = classes.select("class", "label", "dim", "raw").mapInArrow(
        project, f"pass int, class long, label {mark}, dim int, raw binary, order binary"
    )
    order = ["pass", "label", "dim", "order", "class"]
    ranged = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("pass", "label", "dim", "class", "raw").mapInArrow(compare, "a long, b long")


def joining_pairs(x: np.ndarray, y: np.ndarray, gx: np.ndarray, gy: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Pairs of groups, of x's rows and of y's, that links join; enough of them to connect all.

    Single precision finds the candidates, with a margin above its error, and double decides.
    """
    dim = x.shape[1]
    low = threshold - 2.0**-22 * (dim + 8)
    fx, fy = x.astype(np.float32), y.astype(np.float32)
    names, place = np.unique(np.concatenate([gx, gy]), return_inverse=True)
    at_x, at_y = place[: len(x)], place[len(x) :]
    root = np.arange(len(names))
    found = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, len(x), ROWS):
        now_y = root[at_y]
        i, j = np.nonzero((fx[at : at + ROWS] @ fy.T >= low) & (root[at_x[at : at + ROWS]][:, None] != now_y))
        i += at
        step = max(1, NUMBERS // dim)
        joined = False
        for k in range(0, len(i), step):
            p, q = i[k : k + step], j[k : k + step]
            if joined:  # what the pairs before have joined is settled
                open_pairs = root[at_x[p]] != root[at_y[q]]
                p, q = p[open_pairs], q[open_pairs]
            near = np.einsum("ij,ij->i", x[p], y[q]) >= threshold
            for a, b in np.unique(np.stack([at_x[p[near]], at_y[q[near]]], axis=1), axis=0).tolist():
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    found.append((int(names[a]), int(names[b])))
                    joined = True
            while joined and (root != root[root]).any():
                root = root[root]
    return found


def rest_links(classes: DataFrame, groups: DataFrame, work: Workspace, threshold: float) -> DataFrame:
    """(a, b): links between groups (node, component) of classes; with these, groups are whole.

    The classes of a label are dealt into blocks of bounded bytes, and every pair of blocks is one
    task's group. This is exact, and its arithmetic is quadratic in a label's size.
    """
    rows = classes.join(groups, F.col("class") == F.col("node"), "left")
    rows = rows.select("class", "label", "dim", "raw", F.coalesce("component", "class").alias("group"))
    size = F.floor(F.greatest(F.lit(1.0), F.lit(REST_BYTES) / (8 * F.col("dim"))))
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / size))
    sizes = work.store(sizes.filter("n > 1").select(F.col("label").alias("s_label"), F.col("dim").alias("s_dim"), "blocks"), "vector_sizes")
    rows = rows.join(lookup(sizes), (F.col("label") == F.col("s_label")) & (F.col("dim") == F.col("s_dim"))).drop("s_label", "s_dim")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        x = unit(part["raw"].tolist(), int(part["dim"].iloc[0]))
        group, first = part["group"].to_numpy(), (part["own"] == part["low"]).to_numpy()
        # Where a block meets itself all rows are on both sides.
        second = first if part["low"].iloc[0] == part["high"].iloc[0] else ~first
        found = joining_pairs(x[first], x[second], group[first], group[second], threshold)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    chosen = rows.select("label", "dim", "low", "high", "raw", "own", "group")
    return chosen.groupBy("label", "dim", "low", "high").applyInPandas(compare, "a long, b long")


def link_counts(classes: DataFrame, member: DataFrame, threshold: float) -> DataFrame:
    """(class, links): how many vectors of other classes of its component each class links with.

    All links lie inside components, so counting there is exact. A component is cut into blocks of
    bounded size and every pair of blocks is one task's group; only sums leave a group.
    """
    sizes = member.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = classes.join(member, "class").join(sizes, "component")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def count(group: pd.DataFrame) -> pd.DataFrame:
        x = unit(group["raw"].tolist(), int(group["dim"].iloc[0]))
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        if group["low"].iloc[0] != group["high"].iloc[0]:
            own = group["own"].to_numpy()
            near &= own[:, None] != own[None, :]  # the rest is counted where the block meets itself
        return pd.DataFrame({"class": group["class"], "links": near.astype(np.int64) @ group["copies"].to_numpy()})

    chosen = rows.select("component", "low", "high", "class", "dim", "raw", "copies", "own")
    counted = chosen.groupBy("component", "low", "high").applyInPandas(count, "class long, links long")
    return counted.groupBy("class").agg(F.sum("links").alias("links"))


def near_vectors(
    rows: DataFrame,
    work: Workspace,
    threshold: float,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per input row: id, n_links, component_id (smallest id reachable), kept.

    Vectors are linked when their labels are equal and not null, their dimensions are equal, and
    their cosine in double precision is at least `threshold`. A vector that is null, empty, zero or
    holds a null or non-finite component links with nothing, nor does one without a label. Repeated
    rows are linked copies of each other. Null ids come last: a component's id is null only when all
    its ids are. An empty table gives no rows.
    """
    work = work.inner()
    stored = stored_vectors(rows, work, id, vector, label)
    classes = stored.filter("raw is not null").groupBy("key").agg(
        F.min("row").alias("class"),
        F.count("*").alias("copies"),
        F.min("id").alias("first_id"),
        F.any_value("label").alias("label"),
        F.any_value("dim").alias("dim"),
        F.any_value("raw").alias("raw"),
    )
    classes = work.store(classes, "vector_classes")
    links = work.store(window_links(classes, threshold), "vector_links")
    groups = work.store(connected(links, work, "vector_windows"), "vector_groups")
    rest = work.store(rest_links(classes, groups, work, threshold), "vector_rest")
    links = links.unionByName(rest)
    member = work.store(
        connected(links, work, "vector_components").withColumnRenamed("node", "class"), "vector_members"
    )
    counts = link_counts(classes, member, threshold)
    known = classes.join(member, "class", "left").join(counts, "class", "left").select(
        "key",
        "class",
        F.coalesce("component", "class").alias("component"),
        "first_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
    )
    known = work.store(known, "vector_known")
    smallest = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = work.store(known.join(smallest, "component").select(F.col("key").alias("class_key"), "n", "component_id"), "vector_result")
    work.remove(keep=["vector_rows", "vector_result"])
    # Rows without a class get a key of their own, so that they do not meet in one task.
    key = F.coalesce("key", F.col("row").cast("string"))
    alone = F.col("n").isNull()
    out = stored.join(known, key == F.col("class_key"), "left").select(
        "id",
        F.coalesce("n", F.lit(0)).alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
