"""No row lost or doubled, buckets, and publishing against other runs."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landing import land
from tabload.config import CastSpec, DeltaSpec
from tabload.operators import cast, delta, dedup
from tabload.plans.load import load_bundle, run_load, run_refresh
from tabload.plans.tables import LoadJob, Run
from tabload.sinks.publish import BUCKETS, SnapshotStore, StaleRun, bucket_of
from tabload.sources.catalog import Catalog, Entry, ForeignKey, foreign_keys, from_information_schema
from tabload.sources.delimited import read_delimited
from tabload.sources.listing import list_files
from tabload.streaming.check import landed_and_streamed
from tabload.streaming.load import stream_load
from test_load import SMALL, load, log_of, make_job, quick_planning, read  # noqa: F401


def put(store, run_id, rows, table="t", keys=("k",), read=None):
    paths = store.stage_buckets(rows, run_id, table, list(keys))
    store.publish(run_id, {table: dict.fromkeys(paths, 1)}, read)
    return paths


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB", "spark.sql.shuffle.partitions": "4"}
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        paths, counts = SnapshotStore(spark, str(tmp_path)).stage_buckets_counted(df, "one", "t", ["k"])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    (hot,) = (row[0] for row in spark.createDataFrame([(7,)], "k bigint").select(bucket_of(["k"])).collect())
    files = {at: len(spark.read.parquet(path).inputFiles()) for at, path in paths.items()}
    assert sum(counts.values()) == spark.read.parquet(*paths.values()).count() == 60_000
    assert files[hot] > 4 and len(paths) == BUCKETS
    assert sorted(files.values())[BUCKETS // 2] == 1  # the others are not cut up


def test_a_small_change_leaves_other_buckets_in_place(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    schema = "k bigint, v string"
    first = put(store, "one", spark.createDataFrame([(at, "old") for at in range(2000)], schema))
    assert len(first) == BUCKETS
    change = spark.createDataFrame([(7, "new"), (5000, "new")], schema)
    hit = {row[0] for row in change.select(bucket_of(["k"])).collect()}
    current = store.open([path for at, path in first.items() if at in hit], change.schema)
    assert current.count() < 200
    spec = DeltaSpec(keys=("k",))
    second = put(store, "two", delta.merge_snapshot(current, delta.classify(change, current, spec), spec))
    assert set(second) == hit
    head = store.heads()["t"]
    assert head.version == 2 and {at: p for at, p in head.paths.items() if at not in hit} == {
        at: p for at, p in first.items() if at not in hit
    }
    got = dict(store.read("t", change.schema).collect())
    assert len(got) == 2001 and sorted(k for k, v in got.items() if v == "new") == [7, 5000]


def test_a_stale_run_is_refused(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    frame = spark.createDataFrame([(1, "a")], "k bigint, v string")
    read_by_both = store.heads()
    put(store, "one", frame, read=read_by_both)
    with pytest.raises(StaleRun):
        put(store, "two", frame, read=read_by_both)
    put(store, "three", frame, table="other", read=read_by_both)
    assert store.heads()["t"].version == 1


def test_a_whole_table_replaces_buckets_and_the_other_way_round(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    frame = spark.createDataFrame([(at, "a") for at in range(300)], "k bigint, v string")
    put(store, "one", frame)
    store.stage(frame.limit(5), "two", "tables/t")
    store.publish("two", {"t": 5})
    assert store.read("t", frame.schema).count() == 5 and not store.heads()["t"].bucketed
    put(store, "three", frame)
    assert store.read("t", frame.schema).count() == 300 and store.heads()["t"].bucketed


def test_other_read_errors_are_not_an_empty_store(spark, tmp_path):
    (tmp_path / "manifest").mkdir()
    (tmp_path / "manifest" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark raises for a broken file
        SnapshotStore(spark, str(tmp_path)).heads()


def test_lines_are_loaded_or_rejected(spark, tmp_path):
    folder = land(tmp_path / "landing", "Site_99", "13-05-09-02-28-2021", "submission_001_a.zip", "Create", {
        "baseline.csv": [["Research_Participant_ID", "Age", "Cohort", "BMI", "Obesity"], ["99_000001", "45", "HIV", "24", ""]],
    })
    with (folder / "baseline.csv").open("a") as stream:
        stream.write('99_000002,46,"HIV, or so",25,,surplus\n99_000003,47\n99_000004,48,,22,x\n')
    job = make_job(spark, tmp_path, SMALL)
    result = load(job, tmp_path / "landing", "run")
    assert result.published
    reasons = {(r.reason, r.record.split('"Research_Participant_ID":"')[1][:9]) for r in result.rejects.collect() if r.source == "baseline.csv"}
    assert reasons == {("line has too many cells", "99_000002"), ("no cohort", "99_000003"), ("no cohort", "99_000004")}
    assert rows(read(job, "Participant"), "Research_Participant_ID") == [("99_000001",)]
    log = log_of(result)
    assert log[("baseline.csv", "landed")] == 4 and log[("baseline.csv", "short line, missing cells read as NULL")] == 1


def test_orphans_long_aliquots_and_unmapped_kinds(spark, tmp_path):
    land(tmp_path / "landing", "Site_99", "13-05-09-02-28-2021", "submission_001_a.zip", "Create", {
        "aliquot.csv": [
            ["Aliquot_ID", "Biospecimen_ID", "Aliquot_Volume"], ["99_000001_101_123", "99_000001_101", "1"],
            ["99_000001_101_124", "99_000001_101", "1"], ["99_000001_101_1", "99_000009_999", "1"],
        ],
        "mystery.csv": [["Biospecimen_ID"], ["99_000001_101"]],
    })
    job = make_job(spark, tmp_path, {"submission.csv": ["Submission"], "aliquot.csv": ["Aliquot", "Nowhere"]})
    specimens = spark.createDataFrame([("99_000001_101",)], "Biospecimen_ID string")
    job.store.stage(specimens, "seed", "tables/Biospecimen")
    job.store.publish("seed", {"Biospecimen": 1})
    result = load(job, tmp_path / "landing", "run")
    assert [r.error for r in result.log.collect() if r.error] == []
    assert rows(read(job, "Aliquot"), "Aliquot_ID") == [("99_000001_101_123",), ("99_000001_101_124",)]
    reasons = [(r.source, r.reason) for r in result.rejects.collect()]
    assert reasons.count(("aliquot.csv", "aliquot number has more than two digits; the id is kept as it is")) == 2
    assert ("Aliquot", "no such row in Biospecimen") in reasons
    log = log_of(result)
    assert ("mystery.csv", "unmapped") in log and ("Nowhere", "not in catalog") in log and log[("Aliquot", "orphan")] == 1


def test_late_files_are_listed(spark, tmp_path):
    folder = land(tmp_path / "landing", "Site_99", "13-05-09-02-28-2021", "submission_001_a.zip", "Create", {
        "baseline.csv": [["Research_Participant_ID", "Age", "Cohort"], ["99_000001", "45", "HIV"]],
    })
    job = make_job(spark, tmp_path, SMALL)
    where = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    assert [r.published for r in stream_load(job, *where)] == [True]
    (folder / "follow_up.csv").write_text("Research_Participant_ID,Visit_Number,Cohort\n99_000001,2,HIV\n")
    (result,) = stream_load(job, *where)
    assert [r.reason for r in result.rejects.collect()] == ["file landed after its submission was loaded"]


def test_an_error_before_the_tables_is_logged(spark, tmp_path):
    land(tmp_path / "landing", "Site_99", "13-05-09-02-28-2021", "submission_001_a.zip", "Create", {
        "baseline.csv": [["Research_Participant_ID", "Age", "Cohort"], ["99_000001", "45", "HIV"]],
    })
    job = make_job(spark, tmp_path, SMALL)
    job.sites = job.sites.drop("site_code")
    result = run_load(job, list_files(spark, str(tmp_path / "landing")), "run")
    assert not result.published and [r.table_name for r in result.log.collect() if r.error] == ["run"]


def test_streamed_events_of_any_type_arrive(spark):
    events = spark.createDataFrame([(1, 1, "x", 1.0), (2, 1, None, 2.0), (3, 2, "view", None)], "event_id bigint, user_id bigint, event_type string, value double")
    assert landed_and_streamed(spark, events).count() == 3


def test_rows_without_an_id_go_whatever_the_list(spark):
    from tabload.config import CleanSpec
    from tabload.plans.clean import clean_landed

    landed = spark.createDataFrame([("99_000001_101_1", "x"), (None, "x")], "Aliquot_ID string, v string")
    for pieces in ((), ("77",), None):
        listed = spark.createDataFrame([("77",)], "id string")
        assert clean_landed(landed, CleanSpec(), listed, pieces=pieces).count() == 1


def test_exact_numbers(spark):
    cells = [("9007199254740993", "1234567890123456789.12"), ("1e3", "0.005"), ("12.50", "x"), ("-1000000000", "-10000")]
    typed = cast.schema_cast(spark.createDataFrame(cells, "n string, d string"), CastSpec({"n": "BIGINT", "d": "DECIMAL(21,2)"}))
    got = [(r.n, None if r.d is None else str(r.d), r["_bad"]) for r in typed.collect()]
    assert got == [
        (9007199254740993, "1234567890123456789.12", []), (1000, "0.01", []), (None, None, ["n", "d"]), (None, None, []),
    ]


def test_exempt_rows_skip_the_join(spark):
    df = spark.createDataFrame([("a", 1, "x", False), ("a", 2, "y", False), (None, 3, "z", True), ("a", 4, "w", True)], "k string, t int, v string, e boolean")
    got = dedup.harmonise_latest(df, "k", "v", ["t"], df.e)
    assert rows(got, "t", "v") == [(1, "y"), (2, "y"), (3, "z"), (4, "w")]


def test_many_small_files_in_three_shapes(spark, tmp_path):
    for at in range(300):
        header = ["a,b,c", "c,a,b", "b,a"][at % 3]
        (tmp_path / f"f{at}.csv").write_text(f"{header}\n" + ",".join(f"{name}{at}" for name in header.split(",")) + "\n")
    got = read_delimited(list_files(spark, str(tmp_path)))
    assert got.count() == 300 and got.filter("a = concat('a', substr(b, 2)) and (c is null or c = concat('c', substr(b, 2)))").count() == 300


BUNDLE_CATALOG = (Entry("Design", "Cohort_Name", "VARCHAR(50)", primary=True), Entry("Design", "Notes", "VARCHAR(50)"))


def design_job(spark, folder):
    sites = spark.createDataFrame([], "site_folder string, site_code string")
    return LoadJob(SnapshotStore(spark, str(folder / "store")), Catalog(BUNDLE_CATALOG), {"study_design.csv": ["Design"]}, sites)


def design(spark, *found):
    return {"study_design.csv": spark.createDataFrame(found, "Cohort_Name string, Notes string")}


def test_a_repeated_refresh_leaves_the_table_whole(spark, tmp_path):
    job = design_job(spark, tmp_path)
    assert run_refresh(job, design(spark, ("A", "x"), ("B", "y")), "day-1").published
    assert run_refresh(job, design(spark, ("A", "changed")), "day-1").published  # the run is known; nothing is written
    assert rows(read(job, "Design")) == [("A", "x"), ("B", "y")]
    assert run_refresh(job, design(spark, ("A", "changed")), "day-2").published
    assert rows(read(job, "Design")) == [("A", "changed"), ("B", "y")]


def test_a_killed_refresh_is_repeated(spark, tmp_path, monkeypatch):
    job = design_job(spark, tmp_path)
    assert run_refresh(job, design(spark, ("A", "x")), "day-1").published
    for step in ("put", "finish"):
        with monkeypatch.context() as patch:
            patch.setattr(Run, step, lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                run_refresh(job, design(spark, ("A", "half"), ("B", "y")), "day-2")
        assert rows(read(job, "Design")) == [("A", "x")]
    assert run_refresh(job, design(spark, ("A", "new"), ("B", "y")), "day-2").published
    assert rows(read(job, "Design")) == [("A", "new"), ("B", "y")]


def test_of_two_runs_that_read_one_version_one_publishes(spark, tmp_path):
    job = design_job(spark, tmp_path)
    assert run_refresh(job, design(spark, ("A", "x")), "day-1").published
    first, second = Run(job, "one"), Run(job, "two")
    load_bundle(first, design(spark, ("B", "1")), None)
    load_bundle(second, design(spark, ("B", "2")), None)
    job.store.claim("Design", 2, "one")  # both see version 1; the first is about to write its manifest rows
    assert not second.finish().published
    assert rows(read(job, "Design")) == [("A", "x")]
    assert first.finish().published
    assert rows(read(job, "Design")) == [("A", "x"), ("B", "1")]


def test_a_refresh_without_files_is_logged(spark, tmp_path):
    job = design_job(spark, tmp_path)
    turned_away = spark.createDataFrame([("study_design.csv", "line has too many cells", "{}")], "source string, reason string, record string")
    result = run_refresh(job, {}, "day-1", turned_away)
    assert result.published and log_of(result)[("study_design.csv", "rejected")] == 1 and ("run", "absent") in log_of(result)
    assert [r.reason for r in result.rejects.collect()] == ["line has too many cells"]
    failed = run_refresh(job, {"study_design.csv": design(spark)["study_design.csv"].drop("Cohort_Name")}, "day-2")
    assert not failed.published and [r.error for r in failed.log.collect() if r.error]


def test_rows_that_hang_on_a_lost_row_are_lost(spark, tmp_path):
    entries = (Entry("Node", "id", "INTEGER", primary=True), Entry("Node", "up", "INTEGER"), Entry("Node", "a", "INTEGER"), Entry("Node", "b", "INTEGER"),
               Entry("Pair", "a", "INTEGER", primary=True), Entry("Pair", "b", "INTEGER", primary=True))
    catalog = Catalog(entries, (ForeignKey("up", "Node", ("up",), "Node", ("id",)), ForeignKey("pair", "Node", ("a", "b"), "Pair", ("a", "b"))))
    job = LoadJob(SnapshotStore(spark, str(tmp_path / "store")), catalog, {"node.csv": ["Node"], "pair.csv": ["Pair"]},
                  spark.createDataFrame([], "site_folder string, site_code string"))
    pairs = spark.createDataFrame([(1, 1), (2, 2)], "a int, b int")
    nodes = spark.createDataFrame([
        (1, 9, None, None), (2, 1, None, None), (3, 2, 1, 1), (4, None, 1, 2), (5, 4, None, None), (6, None, 2, 2), (7, 6, 2, None), (8, 8, None, None),
    ], "id int, up int, a int, b int")
    result = run_refresh(job, {"pair.csv": pairs, "node.csv": nodes}, "day-1")
    assert result.published and log_of(result)[("Node", "orphan")] == 5
    assert rows(read(job, "Node"), "id") == [(6,), (7,), (8,)]
    reasons = sorted((json.loads(r.record)["id"], r.reason) for r in result.rejects.collect())
    assert reasons == [(1, "no such row in Node"), (2, "no such row in Node"), (3, "no such row in Node"), (4, "no such row in Pair"), (5, "no such row in Node")]
    # a row whose change is turned away stands as it was, and so does what refers to it
    again = run_refresh(job, {"node.csv": spark.createDataFrame([(6, 77, 2, 2), (10, 6, None, None)], "id int, up int, a int, b int")}, "day-2")
    assert again.published and rows(read(job, "Node"), "id", "up") == [(10, 6), (6, None), (7, 6), (8, 8)]


def test_references_of_a_database_view(spark):
    usage = spark.createDataFrame([
        ("fk1", "T", "a", 1, "P", "x"), ("fk1", "T", "b", 2, "P", "y"), ("fk2", "T", "a", 1, "Q", "k"), ("PRIMARY", "T", "id", 1, None, None),
    ], "CONSTRAINT_NAME string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, REFERENCED_TABLE_NAME string, REFERENCED_COLUMN_NAME string")
    columns = spark.createDataFrame([("T", "id", "int", "PRI", ""), ("T", "a", "int", "", ""), ("T", "b", "int", "", "")],
                                    "TABLE_NAME string, COLUMN_NAME string, COLUMN_TYPE string, COLUMN_KEY string, EXTRA string")
    found = Catalog.load(from_information_schema(columns, usage), foreign_keys(usage)).foreign_keys("T")
    assert [(key.columns, key.parent, key.parent_columns) for key in found] == [(("a", "b"), "P", ("x", "y")), (("a",), "Q", ("k",))]


def test_counts_are_taken_while_rows_are_written(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("counted", "counts")
    try:
        rows_ = spark.range(1000).selectExpr("id as k", "cast(id as string) as v")
        _, found = store.stage_counted(rows_, "run", "part", n=F.count(F.lit(1)), low=F.min("k"))
        assert found == {"n": 1000, "low": 0} and jobs() == 1
        paths, counts = store.stage_buckets_counted(rows_, "run", "t", ["k"])
        assert sum(counts.values()) == 1000 and sorted(paths) == sorted(counts)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert all(store.open([path], rows_.schema).count() == counts[at] for at, path in list(paths.items())[:5])


def test_an_unreadable_cell_keeps_what_is_stored(spark, tmp_path):
    first = land(tmp_path / "one", "Site_99", "13-05-09-02-28-2021", "submission_001_a.zip", "Create", {
        "baseline.csv": [["Research_Participant_ID", "Age", "Cohort", "BMI", "Obesity"], ["99_000001", "45", "HIV", "24", ""], ["99_000002", "x", "HIV", "24", ""]],
    })
    assert first
    job = make_job(spark, tmp_path, SMALL)
    assert load(job, tmp_path / "one", "day-1").published
    land(tmp_path / "two", "Site_99", "2021-03-01-10-00-00", "submission_002_b.zip", "Update", {
        "baseline.csv": [["Research_Participant_ID", "Age", "Cohort", "BMI", "Obesity"], ["99_000001", "fortysix", "HIV", "", ""], ["99_000002", "51", "HIV", "24", ""]],
    })
    result = load(job, tmp_path / "two", "day-2")
    assert result.published
    assert rows(read(job, "Participant"), "Research_Participant_ID", "Age") == [("99_000001", 45.0), ("99_000002", 51.0)]
    assert rows(read(job, "Participant_Visit_Info"), "Research_Participant_ID", "BMI") == [("99_000001", None), ("99_000002", 24.0)]
    told = [json.loads(r.record).get("_mixed") for r in result.rejects.collect() if r.reason == "cell does not fit its column type"]
    assert {"Age": "fortysix"} in told


def test_an_unchanged_resubmission_opens_no_bucket(spark, tmp_path):
    job = design_job(spark, tmp_path)
    found = [(f"C{at}", "x" if at % 3 else None) for at in range(500)]
    assert run_refresh(job, design(spark, *found), "day-1").published
    key = ["Cohort_Name"]
    current, rest, left, same = Run(job, "look").touched("Design", design(spark, *found[::-1])["study_design.csv"], key)
    assert (current.count(), len(rest), left.count(), same) == (0, BUCKETS, 0, 500)
    changed = [*found[1:], ("C0", "y")]
    current, rest, left, same = Run(job, "look").touched("Design", design(spark, *changed)["study_design.csv"], key)
    assert len(rest) == BUCKETS - 1 and left.count() == current.count() == 500 - same
    again = run_refresh(job, design(spark, *found), "day-2")
    assert again.published and log_of(again)[("Design", "same")] == 500 and not [k for k in log_of(again) if k[1] in ("insert", "update")]
    last = run_refresh(job, design(spark, *changed), "day-3")
    assert last.published and log_of(last)[("Design", "update")] == 1 and log_of(last)[("Design", "same")] == 499
    assert rows(read(job, "Design")) == sorted(changed, key=repr)
