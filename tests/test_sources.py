"""File sources: header shapes, bundles, streams."""

from pyspark.sql import functions as F

from conftest import rows
from landing import write_csv
from tabload.operators import submissions
from tabload.sources import bundles, catalog, delimited, lines, listing, tables
from tabload.streaming.ingest import append_batches, keep_latest_within, run_available, stream_files


def test_files_with_different_headers(spark, tmp_path):
    folder = tmp_path / "odd (1) [x]+y"
    write_csv(folder / "a.csv", ["x", "y"], ["1", "2"], ['quo"te', "a,b"])
    write_csv(folder / "b.csv", ["y", "x", "", "x"], ["2", "1", "9", "8"])
    (folder / "c.csv").write_text("")
    files = listing.list_files(spark, str(tmp_path), "*.csv")
    df = delimited.read_delimited(files.select("path"))
    assert rows(df, "x", "y", "Unnamed: 2", "x.1") == sorted(
        [("1", "2", None, None), ('quo"te', "a,b", None, None), ("1", "2", "9", "8")], key=repr
    )
    assert df.select("_path").distinct().count() == 2
    assert rows(df.select(listing.comparable_path(F.col("_path")).alias("p")).distinct()) == rows(
        files.filter("size > 0").select(listing.comparable_path(F.col("path")).alias("p"))
    )


def test_malformed_lines_are_kept_and_marked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n1,2,3\n")
    df = delimited.read_delimited(listing.list_files(spark, str(tmp_path)).select("path"))
    assert rows(df, "x", "y", "_malformed") == sorted([("1", "2", None), ("1", "2", "1,2,3")], key=repr)


def test_line_ends_in_cells(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ["x", "y"], ["one\ntwo", "2"])
    df = delimited.read_delimited(listing.list_files(spark, str(tmp_path)).select("path"), multi_line=True)
    assert rows(df, "x", "y") == [("one\ntwo", "2")]


def test_lines_give_what_a_read_per_shape_gives(spark, tmp_path):
    odd = tmp_path / "odd (1) [x]+y"
    odd.mkdir()
    (odd / "a.csv").write_text("x,y\n1,2\n\nx,y\n 3 ,\"a,\"\"b\"\nx,y\n1,2,3\n5\n\"\",\n")
    (odd / "b.csv").write_bytes(b"\xef\xbb\xbfy,x,,x\r\n2,1,9,8\r\n")
    (odd / "quoted.csv").write_text('\n"x","y"\n7,8')
    (odd / "empty.csv").write_text("")
    (odd / "header.csv").write_text("x,y,z\n")
    (odd / "latin.csv").write_bytes("gr\u00f6\u00dfe,y\n1,2\n".encode("latin-1"))
    (odd / "other.csv").write_text("x,y\nnot,listed\n")
    (odd / "c.csv").write_text("x,y\n1,2\n")
    kind = F.when(F.col("key").contains("/c."), "c").otherwise("ab")
    files = listing.list_files(spark, str(tmp_path), "*.csv").filter(~F.col("key").contains("other")).withColumn("kind", kind)
    rejects, wanted = [], []
    got, slow = lines.read_lines(spark, str(tmp_path), files, rejects=rejects), delimited.read_kinds(files, rejects=wanted)
    assert sorted(got) == sorted(slow) == ["ab", "c"]
    names = ["x", "y", "z", "Unnamed: 2", "x.1", "_malformed", "_short"]
    place = listing.comparable_path(F.col("_path")).alias("at")
    for found in ("ab", "c"):
        columns = [F.col(f"`{name}`") for name in names if name in got[found].columns] + [place]
        assert rows(got[found].select(columns)) == rows(slow[found].select(columns))
    assert got["ab"].filter("x = 'x' and y = 'y'").count() == 2  # the header once more is data
    assert [r.source for r in rejects[0].collect()] == [r.source for r in wanted[0].collect()] == ["ab"]
    assert lines.read_lines(spark, str(tmp_path), files.limit(0)) == {}


def test_submission_folders(spark):
    paths = [
        "S/Site_99/13-05-09-02-28-2021/submission_001_a.zip/UnZipped_Files/x.csv",
        "S/Site_99/13-05-09-02-28-2021/submission_001_a.zip/UnZipped_Files/y.csv",
        "S/Site_99/13-05-09-02-28-2021/submission_001_a.zip/x.zip",
        "test/Site_99/t/f/UnZipped_Files/x.csv",
        "S/Submissions_in_Review/t/f/UnZipped_Files/x.csv",
    ]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    sites = spark.createDataFrame([("Site_99", "99")], "site_folder string, site_code string")
    got = submissions.describe_submissions(submissions.list_submissions(files), sites).collect()
    assert [(r.site_code, str(r.submitted_at), r.file_name) for r in got] == [("99", "2021-02-28 13:05:09", "a.zip")]


def test_newest_assay_files(spark):
    files = spark.createDataFrame(
        [("d/assay_1.xlsx", 1), ("d/assay_2.xlsx", 2), ("d/assay_qc.xlsx", 1), ("e/assay_target_antigen.xlsx", 1),
         ("d/assay_20210402.xlsx", 9), ("d/other.xlsx", 9), ("d/Assay_Target_Organism_Conversion.xlsx", 1)],
        "key string, modified_at int",
    )
    got = listing.latest_assay_files(files, "20210402")
    assert rows(got, "key", "file_class") == [
        ("d/Assay_Target_Organism_Conversion.xlsx", "conversion"), ("d/assay_2.xlsx", "assay"),
        ("d/assay_qc.xlsx", "qc"), ("e/assay_target_antigen.xlsx", "target"),
    ]


def test_assay_bundle(spark, tmp_path):
    write_csv(
        tmp_path / "CBC_Folders/a/assay_1.xlsx/Sheet1.csv", ["Assay_ID", "Calibration_Type", "Target_Organism", "Assay_Target_Antigen"],
        ["99_001", "N/A", "virus–x", "Spike"], ["template", "", "", ""],
    )
    write_csv(tmp_path / "CBC_Folders/a/assay_qc_1.xlsx/Sheet1.csv", ["Assay_ID", "QC", "Comments"], ["99_001", "", ""])
    bundle = bundles.assay_bundle(listing.list_files(spark, str(tmp_path), "*.csv"))
    assert rows(bundle["assay_data.csv"], "Assay_ID", "Calibration_Type", "Assay_Target_Organism", "Assay_Target") == [
        ("99_001", "No Data Provided", "virus-x", "Spike")
    ]
    assert rows(bundle["assay_qc.csv"], "Assay_ID", "QC", "Comments") == [("99_001", "No Data Provided", "")]


def test_study_design_names_the_site(spark, tmp_path):
    for site, cohort in (("one", "A"), ("two", "B")):
        write_csv(tmp_path / f"CBC_Folders/{site}/Vaccine_Respone_Study_Design/d.csv", ["Cohort_Name", "Notes"], [cohort, "N/A"])
    got = bundles.study_design(listing.list_files(spark, str(tmp_path), "*.csv"))
    assert rows(got, "Cohort_Name", "Notes", "CBC_Name") == [("A", None, "one"), ("B", None, "two")]


def test_panel_results_take_two_routes(spark, tmp_path):
    write_csv(tmp_path / "p/one.csv", ["Subaliquot_ID", "Result"], ["FD_1", "3"], ["99_1", "4"])
    write_csv(tmp_path / "p/blinded_validation_panel_results_example.csv", ["Subaliquot_ID", "Result"], ["FD_1", "9"])
    children = spark.createDataFrame(
        [("B1", "99_1", "FD_1"), ("B2", "99_2", "FD_2")], "Biorepository_ID string, Subaliquot_ID string, CGR_Aliquot_ID string"
    )
    got = bundles.panel_results(listing.list_files(spark, str(tmp_path), "*.csv"), children)
    assert rows(got, "Result", "Biorepository_ID", "Subaliquot_ID") == [("3", "B1", "99_1"), ("4", "B1", "99_1")]


def test_confirmatory_results_keep_the_last_file(spark, tmp_path):
    write_csv(tmp_path / "c/r_01012021.xlsx/IgG.csv", ["Patient ID", "Value"], ["99_0001 9002", "1"])
    write_csv(tmp_path / "c/r_02012021.xlsx/IgG.csv", ["Patient ID", "Value"], ["99_0001", "2"])
    write_csv(tmp_path / "c/r_02012021.xlsx/IgM.csv", ["Patient ID", "Value"], ["99_0001", "5"])
    got = bundles.confirmatory_results(listing.list_files(spark, str(tmp_path), "*.csv"))
    assert rows(got, "Patient ID", "Value", "file_date", "Measurand_Antibody", "BSI_Parent_ID") == [
        ("99_0001", "2", "02012021", "IgG", "99_0001 0001"), ("99_0001", "5", "02012021", "IgM", "99_0001 0001"),
    ]


def test_maps_keep_their_texts(spark, tmp_path):
    for sheet in ("BSI_Parent_Aliquots", "BSI_Child_Aliquots"):
        write_csv(tmp_path / f"m/Map.xlsx/{sheet}.csv", ["ID", "Note"], ["1", "N/A"])
    maps = bundles.biorepository_maps(listing.list_files(spark, str(tmp_path), "*.csv"), "Map.xlsx")
    assert {kind: rows(df) for kind, df in maps.items()} == {"bsi_parent.csv": [("1", "N/A")], "bsi_child.csv": [("1", "N/A")]}


def test_catalog_from_information_schema(spark):
    columns = spark.createDataFrame(
        [("T", "id", "int", "PRI", "auto_increment"), ("T", "ref", "varchar(255)", "", ""), ("T", "both", "float", "", "")],
        "TABLE_NAME string, COLUMN_NAME string, COLUMN_TYPE string, COLUMN_KEY string, EXTRA string",
    )
    usage = spark.createDataFrame(
        [("T", "ref", "P", "id"), ("T", "both", "P", "id"), ("T", "both", "Q", "id"), ("T", "id", None, None)],
        "TABLE_NAME string, COLUMN_NAME string, REFERENCED_TABLE_NAME string, REFERENCED_COLUMN_NAME string",
    )
    rows_of = catalog.from_information_schema(columns, usage)
    known = catalog.Catalog.load(rows_of)
    assert known.auto_column("T") == "id" and known.parents("T") == {"P"} and known.columns("T") != []
    assert {(e.column, e.parent) for e in known.of("T")} == {("id", None), ("ref", "P"), ("both", None)}


def test_mapping_file(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"file_kind":"a.csv","target_table":"T"}\n{"file_kind":"b.csv","target_table":"T"}\n')
    mapping = tables.read_mapping(spark, str(tmp_path / "m.json"))
    assert sorted(tables.kinds_of(mapping, "T")) == ["a.csv", "b.csv"]


def test_stream_reads_new_files_once(spark, tmp_path):
    landing, out, seen = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "seen")
    write_csv(landing / "1.csv", ["x", "y"], ["1", "2"])
    write_csv(landing / "2.csv", ["y", "x"], ["2", "1"])
    keep = append_batches(out, lambda df: df.select("x", "y"))
    run_available(stream_files(spark, str(landing)), seen, keep)
    write_csv(landing / "3.csv", ["x", "y"], ["3", "4"])
    run_available(stream_files(spark, str(landing)), seen, keep)
    run_available(stream_files(spark, str(landing)), seen, keep)
    assert rows(spark.read.parquet(out).select("x", "y")) == [("1", "2"), ("1", "2"), ("3", "4")]


def test_stream_drops_repeats(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("select 'a' as k, timestamp'2024-01-01 00:00:00' as ts union all select 'a', timestamp'2024-01-01 00:00:05'").write.parquet(source)
    stream = spark.readStream.schema("k string, ts timestamp").parquet(source)
    kept = keep_latest_within(stream, ["k"], "ts", "1 minute")
    query = kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1
