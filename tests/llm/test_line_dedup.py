import random
from collections import defaultdict

import pytest

from sluice.llm.line_dedup import LineRuns, deduplicate, drop_known_lines
from sluice.llm.session import work_dir


def brute(rows):
    strip = "".join(map(chr, [32, *range(9, 14)]))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = defaultdict(set)
    key = lambda line: line.translate(lower).strip(strip)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20 and d is not None:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(holders.get(key(x), ())) >= 3 and d != max(holders[key(x)]))]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    common = [f"A common line number {k} that repeats." for k in range(8)] + ["short", "Exactly twenty chars", "exactly 19 chars ..", "é" * 20]
    out = [(d, "\n".join(r.choice([r.choice(common), "  " + r.choice(common).upper() + "\r", f"private line of document {d} {r.random()}", ""]) for _ in range(r.randint(0, 12)))) for d in range(120)]
    return out + [(None, common[0]), (3, common[0]), (3, common[0]), (3, f"{common[1]}\nother"), (500, None), (501, ""), (119, "\n\n")]


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_equals_brute_force(spark, rows, batches):
    df = spark.createDataFrame([(d, t, *"pqrstu") for d, t in rows], "doc_id long, text string, place string, _id string, _hash string, text_hash string, dropped string, h1 string").repartition(3)
    assert deduplicate(df, batches).columns == [*df.columns, "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in deduplicate(df, batches).collect()), key=str)
    assert got == brute(rows)


def test_edges_and_plan(edges):
    out = deduplicate(edges)
    assert out.columns == [*edges.columns, "n_lines", "n_dropped"] and out.count() == edges.count()
    assert deduplicate(edges.limit(0)).count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()


def test_columns_named_like_the_counts_stay(spark):
    df = spark.createDataFrame([(1, "a", 7, "x")], "doc_id long, text string, n_lines int, N_dropped string")
    out = deduplicate(df)
    assert out.columns == [*df.columns, "_n_lines", "_n_dropped"] and tuple(out.first()) == (1, "a", 7, "x", 1, 0)


def test_runs_are_merged_by_level_and_can_be_opened_again(spark):
    path = work_dir(spark, "runs")
    for k in range(10):
        runs = LineRuns(spark, path, 3)
        lines = spark.createDataFrame([(100 - k, h, h) for h in range(k, k + 3)] + [(100 - k, 0, 0)], "doc_id long, h1 long, h2 long")
        fresh = {r.h1 for r in runs.ingest(lines, work_dir(spark, "fresh")).collect()}
        assert fresh == ({0, 1, 2} if k == 0 else {k + 2})
    assert {k: len(x) for k, x in LineRuns(spark, path).levels().items()} == {0: 1, 2: 1} and LineRuns(spark, path).buckets == 3
    totals = {r.h1: (r.n_docs, r.last_doc) for r in LineRuns(spark, path).totals().collect()}
    assert totals[0] == (10, 100) and totals[5] == (3, 97) and totals[11] == (1, 91)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("sluice")]


def test_a_merge_that_is_cut_off_counts_nothing_twice(spark, monkeypatch):
    runs = LineRuns(spark, work_dir(spark, "runs"), 2)
    real = runs._fs

    class NoDelete:
        def __getattr__(self, name):
            return (lambda *a: False) if name == "delete" else getattr(real, name)

    monkeypatch.setattr(runs, "_fs", NoDelete())
    for k in range(3):
        runs.ingest(spark.createDataFrame([(k, 1, 1)], "doc_id long, h1 long, h2 long"), work_dir(spark, "fresh"))
    assert [tuple(r) for r in runs.totals().collect()] == [(1, 1, 3, 2)] and len(runs._names(f"{runs.root}/level=0")) == 3


def test_anti_joins_of_runs_need_no_exchange_or_sort(spark):
    runs = LineRuns(spark, work_dir(spark, "runs"), 2)
    for k in range(2):
        runs.ingest(spark.createDataFrame([(k, 1, k), (k, 2, k)], "doc_id long, h1 long, h2 long"), work_dir(spark, "fresh"))
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    try:
        a, b = runs.runs()
        joined = a.join(b.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan


def test_a_later_batch_loses_the_lines_that_the_runs_know(spark):
    runs = LineRuns(spark, work_dir(spark, "runs"))
    a, b, c = (f"a line of more than twenty characters, {x}" for x in "abc")
    first = spark.createDataFrame([(1, f"{a}\n{b}"), (2, a)], "doc_id long, text string")
    later = spark.createDataFrame([(3, f"{a}\n{c}\nshort"), (4, f"{c}\n{b} "), (5, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in drop_known_lines(first, runs).collect()} == {1: f"{a}\n{b}", 2: a}
    assert {r.doc_id: (r.text, r.n_dropped) for r in drop_known_lines(later, LineRuns(spark, runs.path)).collect()} == {3: (f"{c}\nshort", 1), 4: (c, 1), 5: ("", 0)}
    again = spark.createDataFrame([(6, f"{c}\nnew")], "doc_id long, text string")
    assert drop_known_lines(again, LineRuns(spark, runs.path)).first().text == "new"
