import random

import pytest
from pyspark.sql import functions as F

from flexspark.examples import flows
from flexspark.jobs.measures import STATE, check_measures, lies_between, measure, merge_measures, repeated_rows, report, unmatched_rows


def test_merged_states_are_those_of_the_whole(spark, folder):
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 1) if i % 10 else None, f"w{rng.randrange(500)}" if i % 7 else None) for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, x double, w string").repartition(6)
    parts = [measure(df.where(F.col("id") % 3 == k), ["id", "x", "w"]) for k in range(3)]
    for k, p in enumerate(parts):
        p.write.parquet(f"{folder}/part={k}")
    stored = spark.read.parquet(folder).drop("part")
    got = {r["column"]: r for r in report(merge_measures(stored), [0.1, 0.5, 0.9]).collect()}
    xs = sorted(x for _, x, _ in rows if x is not None)
    assert (got["x"]["n"], got["x"]["nulls"], got["x"]["low"], got["x"]["high"]) == (20000, 2000, xs[0], xs[-1])
    words = {w for *_, w in rows if w}
    assert (got["w"]["nulls"], got["w"]["low_text"], got["w"]["high_text"], got["w"]["low"]) == (sum(w is None for *_, w in rows), min(words), max(words), None)
    for column, true in (("id", 20000), ("x", len(set(xs))), ("w", len(words))):
        assert abs(got[column]["distinct_values"] / true - 1) < 0.06
    for share, q in zip((0.1, 0.5, 0.9), got["x"]["quantiles"]):
        assert abs(sum(x <= q for x in xs) / len(xs) - share) < 0.03
    assert got["w"]["quantiles"] == [None] * 3
    again = {r["column"]: r for r in report(merge_measures(merge_measures(*parts[:2]), parts[2])).collect()}
    assert all(again[c]["n"] == 20000 and again[c]["low"] == got[c]["low"] for c in got)


def test_odd_columns_and_empty_parts(spark):
    df = spark.sql("SELECT named_struct('a', 1) AS s, array(1, 2) AS `x.y`, double('NaN') AS d, CAST(NULL AS int) AS n, date'2020-01-02' AS day")
    state = measure(df)
    assert [f.dataType for f in state.schema.fields] == [f.dataType for f in spark.createDataFrame([], STATE).schema.fields]
    got = {r["column"]: r for r in report(merge_measures(state, measure(df.where("false"))), [0.5]).collect()}
    assert got["s"]["low_text"] == '{"a":1}' and got["x.y"]["high_text"] == "[1,2]" and got["day"]["low_text"] == "2020-01-02"
    assert (got["d"]["nulls"], got["d"]["low"], got["d"]["quantiles"]) == (0, None, [None]) and (got["n"]["nulls"], got["n"]["distinct_values"]) == (1, 0)
    rules = [{"rule": "quantile", "share": 0.5, "column": "n", "min": 0}, {"rule": "rows", "column": "s", "min": 1, "max": 1}, {"rule": "distinct", "column": "s", "max": 0}]
    assert [r["passed"] for r in check_measures(state, rules).collect()] == [False, True, False]
    with pytest.raises(ValueError, match="unknown"):
        check_measures(state, [{"rule": "nothing", "column": "s"}])


def test_failing_rows(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (None, "a", 4), (None, "a", 5)], "k int, `w.w` string, count int")
    assert sorted(r["count"] for r in repeated_rows(df, ["k", "w.w"]).collect()) == [1, 2]
    other = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, w string")
    assert [r["count"] for r in unmatched_rows(df, ["k", "w.w"], other, ["k", "w"]).collect()] == [3]
    assert unmatched_rows(df, ["k"], other.where("false"), ["k"]).count() == 3


def test_lies_between_as_percentile_has_it(spark):
    rng = random.Random(4)
    for values in ([1.0], [1.0, 2.0], [3.0, 3.0, 3.0, 4.0], [rng.randrange(9) / 2 for _ in range(41)] + [None], [float(i) for i in range(100)], [1.0, float("nan"), 2.0], [None]):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        near = [v + d for v in sorted({v for v in values if v is not None and v == v}) for d in (-0.3, 0.0, 0.45, 0.55)][:60]
        for x in (near, [None, 0.0]):
            if x:
                want = df.agg(*[F.expr("percentile(v, array(0.45, 0.55))").alias("q")]).select(*[F.lit(y).cast("double").between(F.col("q")[0], F.col("q")[1]) for y in x]).first()
                assert list(df.agg(*[lies_between(F.col("v"), y, 0.45, 0.55) for y in x]).first()) == list(want)


def test_whole_columns_are_not_gathered(spark):
    plan = flows.measures_merged(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "count(distinct" in plan and "percentile(" not in plan
