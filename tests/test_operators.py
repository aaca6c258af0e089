"""Table operators: properties, edge rows and plans."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tabload.config import DeltaSpec
from tabload.operators import clean, dedup, delta, joins, links, reshape, rules, submissions
from tabload.sinks.publish import validate

SPEC = DeltaSpec(keys=("k",))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frame(spark, values, schema):
    return spark.createDataFrame(values, schema)


# --- delta -------------------------------------------------------------------------------------


def current_rows(spark):
    return frame(spark, [(1, "a", 1.0, "x"), (2, "b", None, "y"), (3, "c", 3.0, "z")], "k int, s string, v double, z string")


def incoming_rows(spark):
    return frame(spark, [(1, "a", 1.00001, ), (2, "b", None), (3, "d", 3.0), (4, "e", 4.0)], "k int, s string, v double")


def test_classes(spark):
    got = delta.classify(incoming_rows(spark), current_rows(spark), SPEC)
    assert rows(got, "k", "op") == [(1, "same"), (2, "same"), (3, "update"), (4, "insert")]


def test_merge_keeps_absent_columns(spark):
    changes = delta.classify(incoming_rows(spark), current_rows(spark), SPEC)
    merged = delta.merge_snapshot(current_rows(spark), changes, SPEC)
    assert rows(merged) == [(1, "a", 1.0, "x"), (2, "b", None, "y"), (3, "d", 3.0, "z"), (4, "e", 4.0, None)]
    spec = DeltaSpec(keys=("k",), absent_columns="null")
    assert rows(delta.merge_snapshot(current_rows(spark), changes, spec))[2] == (3, "d", 3.0, None)


def test_merge_is_idempotent(spark):
    current, incoming = current_rows(spark), incoming_rows(spark)
    merged = delta.merge_snapshot(current, delta.classify(incoming, current, SPEC), SPEC)
    again = delta.classify(incoming, merged, SPEC)
    assert {r.op for r in again.collect()} == {"same"}
    assert rows(delta.merge_snapshot(merged, again, SPEC)) == rows(merged)


@pytest.mark.parametrize("absent", ["keep", "null"])
def test_one_join_gives_the_same_snapshot(spark, absent):
    spec = DeltaSpec(keys=("k",), absent_columns=absent)
    current, incoming = current_rows(spark), incoming_rows(spark)
    two_steps = delta.merge_snapshot(current, delta.classify(incoming, current, spec), spec)
    assert rows(delta.upsert(current, incoming, spec)) == rows(two_steps)
    only_current = delta.upsert(current, incoming.filter("k = 4"), spec)
    assert rows(only_current) == sorted([*rows(current), (4, "e", 4.0, None)], key=repr)


def test_every_incoming_row_has_one_class(spark):
    pick = random.Random(3)
    now = frame(spark, [(k, pick.choice("ab")) for k in range(300) if pick.random() < 0.6], "k int, s string")
    new = frame(spark, [(k, pick.choice("ab")) for k in range(300)], "k int, s string")
    summary = delta.run_summary(delta.classify(new, now, SPEC), SPEC, "t")
    assert sum(r.n_rows for r in summary.collect()) == 300


def test_late_rows_do_not_overwrite(spark):
    spec = DeltaSpec(keys=("k",), version="i")
    now = frame(spark, [(1, "new", 7)], "k int, s string, i int")
    late = frame(spark, [(1, "old", 5)], "k int, s string, i int")
    changes = delta.classify(late, now, spec)
    assert rows(changes, "k", "op") == [(1, "stale")]
    assert rows(delta.merge_snapshot(now, changes, spec)) == [(1, "new", 7)]


def test_key_with_wildcards_hits_one_row(spark):
    now = frame(spark, [("99_000001", "a"), ("99x000001", "a")], "k string, s string")
    new = frame(spark, [("99_000001", "b")], "k string, s string")
    merged = delta.merge_snapshot(now, delta.classify(new, now, SPEC), SPEC)
    assert rows(merged) == [("99_000001", "b"), ("99x000001", "a")]


def test_few_keys_move_no_snapshot_row(spark, tmp_path):
    spark.range(1000).selectExpr("id as k", "cast(id as string) as s").write.parquet(str(tmp_path / "now"))
    spark.range(5).selectExpr("id as k", "'x' as s").write.parquet(str(tmp_path / "new"))
    now, new = spark.read.parquet(str(tmp_path / "now")), spark.read.parquet(str(tmp_path / "new"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert joins.fits_broadcast(new) and not joins.fits_broadcast(new, max_rows=4)
        assert not joins.fits_broadcast(new, max_bytes=10)
        labelled = delta.classify(new, now, SPEC, few_keys=True)
        assert "LeftSemi, BuildRight" in plan(labelled)
        labelled.write.parquet(str(tmp_path / "changes"))
        merged = delta.merge_snapshot(now, spark.read.parquet(str(tmp_path / "changes")), SPEC, few_changes=True)
        text = plan(merged)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text
        assert merged.filter("s = 'x'").count() == 5 and merged.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_and_validation(spark):
    child = frame(spark, [(1, 10), (2, 20), (3, None)], "id int, ref int")
    parent = frame(spark, [(10,)], "k int")
    assert rows(delta.orphans(child, parent, {"ref": "k"})) == [(2, 20)]
    snapshot = frame(spark, [(1,), (1,), (None,)], "k int")
    assert rows(validate(snapshot, SPEC, "t")) == [("t", 3, 1, 1)]


# --- versions ----------------------------------------------------------------------------------


def test_last_values_with_first_version(spark):
    df = frame(spark, [("k", 3, "a", None), ("k", 7, "b", None), ("n", 1, None, "x"), (None, 2, "q", None)], "k string, i int, v string, w string")
    got = dedup.last_value_first_version(df, ["k"], "i", ["v", "w"])
    assert rows(got) == sorted([("k", 3, "b", None), ("n", 1, None, "x"), (None, 2, "q", None)], key=repr)


def test_result_does_not_depend_on_row_order(spark):
    values = [(k % 7, k % 3, f"v{k}") for k in range(200)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = frame(spark, values, "k int, i int, v string").repartition(seed + 2)
        got = rows(dedup.last_value_first_version(df, ["k"], "i", ["v"])) + rows(dedup.keep_last(df, ["k"], ["i", "v"]))
        want = want or got
        assert got == want


def test_latest_cohort(spark):
    df = frame(
        spark, [("99_1", 5, "X"), ("99_1", 9, "Y"), ("41_1", 5, "X"), ("41_1", 9, "Y"), ("99_2", 1, "Z")],
        "p string, i int, c string",
    )
    got = dedup.harmonise_latest(df, "p", "c", ["i", "c"], F.substring("p", 1, 2) == "41")
    assert rows(got) == [("41_1", 5, "X"), ("41_1", 9, "Y"), ("99_1", 5, "Y"), ("99_1", 9, "Y"), ("99_2", 1, "Z")]


@pytest.mark.parametrize("hot_share", [0.0, 0.4, 1.0])
def test_hot_key_gets_the_same_result(spark, hot_share):
    n = 6000
    key = F.when(F.col("id") < int(n * hot_share), F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 2500))
    df = spark.range(n).select(key.alias("p"), F.col("id").alias("i"), F.concat(F.lit("v"), F.col("id") % 11).alias("c"))
    got = {r.p: r.c for r in dedup.harmonise_latest(df, "p", "c", ["i"]).select("p", "c").distinct().collect()}
    want = {r.p: r.c for r in df.groupBy("p").agg(F.max_by("c", "i").alias("c")).collect()}
    assert got == want
    assert dedup.harmonise_latest(df, "p", "c", ["i"]).count() == n


def test_a_hot_key_is_split(spark, tmp_path):
    """A key with two thirds of the rows is read by several tasks in the join back."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    key = F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    df = spark.range(0, 60000, 1, 16).select(key.alias("p"), F.col("id").alias("i"), F.concat(F.lit("v"), F.col("id") % 11).alias("c"))
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        got = dedup.harmonise_latest(df, "p", "c", ["i"])
        got.write.parquet(str(tmp_path / "out"))
        executed = got.groupBy().count()
        assert executed.collect()[0][0] == 60000
        assert "skew=true" in plan(executed)
        want = df.filter("p = 'hot'").agg(F.max_by("c", "i")).first()[0]
        stored = spark.read.parquet(str(tmp_path / "out")).filter("p = 'hot'")
        assert stored.select("c").distinct().collect()[0][0] == want and stored.count() == 40000
    finally:
        for name in small:
            spark.conf.unset(name)


def test_one_row_per_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as i")
    for kept in (dedup.keep_last(df, ["k"], ["i"]), dedup.keep_first(df, ["k"], ["i"])):
        text = plan(kept)
        assert text.count("WindowGroupLimit") == 2
        assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_superseded_rows_without_a_group_window(spark):
    df = frame(spark, [("a", 1), ("a", 2), ("b", None), ("b", 1), (None, 1)], "g string, i int")
    flagged = dedup.flag_superseded(df, ["g"], ["i"], "f")
    assert rows(flagged) == sorted([("a", 1, 1), ("a", 2, 0), ("b", None, 1), ("b", 1, 0), (None, 1, 0)], key=repr)
    assert "Window" not in plan(flagged)


# --- joins and reshaping -----------------------------------------------------------------------


def test_null_keys_match(spark):
    left = frame(spark, [(None, 1), ("a", 2)], "k string, v int")
    right = frame(spark, [(None, 10), ("b", 20)], "k string, w int")
    assert rows(joins.natural_join(left, right)) == [(None, 1, 10)]
    assert rows(joins.anti(left, right, ["k"])) == [("a", 2)]
    assert rows(joins.lookup(left, right, ["k"], "found")) == sorted([(None, 1, 10, True), ("a", 2, None, False)], key=repr)


def test_routes_are_disjoint_and_complete(spark):
    df = frame(spark, [(1, "FD1"), (2, "x"), (3, None)], "i int, k string")
    one = frame(spark, [("FD1", "one"), ("x", "one"), (None, "one")], "k string, via string")
    got = joins.split_route(df, F.col("k").rlike("FD|FS"), one, ["k"], one.withColumn("via", F.lit("two")), ["k"])
    assert rows(got, "i", "via") == [(1, "one"), (2, "two"), (3, "two")]


def test_flags_unpivot_with_nulls(spark):
    df = frame(spark, [("a", "Yes", "No", None)], "Assay_ID string, Target_biospecimen_is_Serum string, PBMC string, Saliva string")
    assert rows(reshape.assay_targets(df, ["Serum", "PBMC", "Saliva"])) == [("a", "Serum", "Yes")]


def test_code_lists(spark):
    df = frame(spark, [(1, "lung | skin|lung"), (2, None)], "k int, c string")
    words = frame(spark, [("lung", "Lung"), ("Not Reported", "None")], "term string, name string")
    got = rules.normalise_codes(df, words, "k", "c", "term", "found")
    assert rows(got) == [(1, "lung", "Lung", True), (1, "skin", None, False), (2, "Not Reported", "None", True)]


def test_excluded_pieces(spark):
    df = frame(spark, [("99_300777_1",), ("x99_300777",), ("99_30077",), (None,), ("",)], "id string")
    listed = frame(spark, [("99_300777",), ("zz",), ("",)], "piece string")
    got = clean.exclude_containing(df, ["id"], listed, "piece")
    assert rows(got) == [("",), ("99_30077",)]
    assert "NestedLoop" not in plan(got) and "CartesianProduct" not in plan(got)


def test_excluded_pieces_in_several_columns(spark):
    values = [(f"p{k % 40}", f"s{k}") for k in range(200)] + [(None, "s1"), ("p1", None)]
    df = frame(spark, values, "p string, s string")
    pieces = ("1", "p3", "7")
    listed = frame(spark, [(x,) for x in pieces], "piece string")
    want = sorted((p, s) for p, s in values if p and s and not any(x in p or x in s for x in pieces))
    assert rows(clean.exclude_containing(df, ["p", "s"], listed, "piece")) == want
    assert rows(clean.exclude_pieces(df, ["p", "s"], pieces)) == want


def test_nothing_listed_excludes_nothing(spark):
    df = frame(spark, [("a",), (None,)], "id string")
    assert rows(clean.exclude_containing(df, ["id"], frame(spark, [], "piece string"), "piece")) == [("a",)]


@pytest.mark.parametrize("exclude", [clean.exclude_containing, clean.exclude_by_grams])
def test_cut_ids_do_not_pass_through_the_driver(spark, tmp_path, exclude):
    digests = [hashlib.md5(str(k).encode()).hexdigest() for k in range(21000)]
    other = str.maketrans("0123456789abcdef", "ghijklmnopqrstuv")
    ids = [f"id-{digest}" for digest in digests[:20000]] + [f"id-{digest.translate(other)}" for digest in digests[20000:]] + [None, "", "id-"]
    cut = [digest.translate(other)[: 3 + k % 18] for k, digest in enumerate(digests[:400])]
    pieces = sorted({*"0123456789", *cut, "", ids[20007], ids[20008][9:17], "-vv"})
    want = sorted((x,) for x in ids if x is not None and not any(p in x for p in pieces if p))
    assert 500 < len(want) < 950
    frame(spark, [(x,) for x in ids], "id string").write.parquet(str(tmp_path / "ids"))
    frame(spark, [(p,) for p in pieces], "piece string").write.parquet(str(tmp_path / "listed"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", "24m")  # a page of 16 MB is the least; the cut ids take more than two
    try:
        got = exclude(spark.read.parquet(str(tmp_path / "ids")), ["id"], spark.read.parquet(str(tmp_path / "listed")), "piece")
        assert rows(got) == want
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")


def test_blank_and_template_rows(spark):
    df = frame(spark, [("", None, "1"), ("a", "a", "a"), ("a", None, "a"), ("a", "b", "1")], "x string, y string, i string")
    assert clean.drop_blank_rows(df, ignore=("i",)).count() == 3
    assert rows(clean.drop_constant_rows(df)) == sorted([("", None, "1"), ("a", None, "a"), ("a", "b", "1")], key=repr)


# --- numbering, order, routes ------------------------------------------------------------------


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(1000).select(F.hash("id").alias("h"), F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("t"))
    got = links.number_rows(df, ["t", "h"], "n", 11).orderBy("n").collect()
    assert [r.n for r in got] == list(range(11, 1011))
    assert [(r.t, r.h) for r in got] == sorted((r.t, r.h) for r in got)


def test_numbers_over_any_number_of_ranges(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("a"))
    for ranges in (1, 2, 7, 100, 1000):
        got = links.number_rows(df, ["a"], "n", ranges=ranges).orderBy("a").collect()
        assert [r.n for r in got] == list(range(1, 3001))
        assert [r.a for r in got] == sorted(r.a for r in got)


def test_numbers_of_no_rows(spark):
    assert links.number_rows(frame(spark, [], "a int"), ["a"], "n").count() == 0


def test_first_submission_is_number_one(spark):
    new = frame(spark, [("b", 2), ("a", 2), ("c", 1)], "submission string, submitted_at int")
    done = frame(spark, [], "submission string, Submission_Index int")
    assert rows(submissions.number_submissions(new, done), "submission", "Submission_Index") == [("a", 2), ("b", 3), ("c", 1)]


def test_surrogates_continue(spark):
    existing = frame(spark, [("a", None, 4)], "x string, y string, id bigint")
    new = frame(spark, [("a", None), ("b", "q"), ("b", "q")], "x string, y string")
    assert rows(links.assign_surrogates(new, existing, ["x", "y"], "id")) == [("b", "q", 5)]


def test_load_order():
    order = links.load_order({"child": {"parent", "elsewhere"}, "parent": {"parent"}, "leaf": {"child"}})
    assert order == [["parent"], ["child"], ["leaf"]]
    with pytest.raises(ValueError, match="cycle"):
        links.load_order({"a": {"b"}, "b": {"a"}})


def test_routes(spark):
    df = frame(spark, [("x/CBC_Folders/Assay_Data/f",), ("y",)], "path string")
    assert [r.jobs for r in df.select(submissions.route_by_path(F.col("path")).alias("jobs")).collect()] == [["assay_data"], []]
