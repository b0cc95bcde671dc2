"""Row numbers of tables read from files: nothing is copied, and they stay the same at every reading."""

from collections import Counter

from gainledger.llm.common import ROWS_PER_FILE, numbered
from gainledger.llm.exact_dedup import drop_exact_copies
from gainledger.llm.jaccard_join import drop_near_copies
from gainledger.llm.mixing import mix, take_copies


def stored(work, docs, parts=3):
    return work.store(docs.repartition(parts), "docs")


def test_numbers_are_distinct_and_stay(spark, documents, work):
    docs = stored(work, documents(*[(i // 2, "t") for i in range(50)])).withColumnRenamed("_row", "row_path")
    first = numbered(docs, work.inner(), "row")
    rows = first.collect()
    assert first.columns == [*docs.columns, "row"] and len({r.row for r in rows}) == 50
    assert {r.row // ROWS_PER_FILE for r in rows} == {0, 1, 2}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        again = numbered(docs, work.inner(), "row").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert Counter(again) == Counter(rows)


def test_files_of_one_name_in_several_folders(spark, documents, work):
    documents(*[(i, f"text {i}") for i in range(6)]).coalesce(1).write.partitionBy("doc_id").parquet(f"{work.root}/split")
    docs = spark.read.parquet(f"{work.root}/split")
    assert len({r.row for r in numbered(docs, work, "row").collect()}) == 6


def test_nothing_is_copied(spark, documents, work):
    docs = stored(work, documents((1, "a b"), (2, "ab"), (3, "c")))
    plan = drop_exact_copies(docs, work)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number_input" not in plan
    left = drop_exact_copies(docs, work)
    assert left.schema == docs.schema
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_stages_over_files_with_null_and_repeated_ids(documents, work):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:-1], "other"])
    docs = stored(work, documents((None, " ".join(words)), (None, near), (7, "clean one"), (7, "another clean"), (7, "clean one")))
    left = drop_exact_copies(docs, work)
    assert sorted(r.text for r in left.collect()) == sorted([" ".join(words), near, "another clean", "clean one"])
    left = drop_near_copies(work.store(left, "left"), work)
    assert sorted(len(r.text.split()) for r in left.collect()) == [2, 2, 60]
    empty = work.store(docs.limit(0), "empty")
    for stage in (drop_exact_copies, drop_near_copies, take_copies):
        assert stage(empty, work).count() == 0


def test_copies_over_files_are_those_of_the_mix(documents, work, monkeypatch):
    monkeypatch.setattr("gainledger.llm.mixing.ROWS_PER_CELL", 7)
    rows = [(i, "w " * (i % 4), None, ["a", "b", None][i % 3]) for i in range(150)]
    rows += [(500, "x y", None, "a")] * 9 + [(None, None, None, "b")]
    docs = stored(work, documents(*rows), 5)
    wanted = Counter()
    for r in mix(docs, work.inner()).collect():
        wanted[r.id, r.source, r["size"]] += r.copies
    taken = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in take_copies(docs, work).collect())
    assert taken == +wanted
