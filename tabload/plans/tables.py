"""From cleaned file kinds to published target tables.

Every step that other steps build on is written to the run's folder and read back, so plans stay
short, nothing is held in executor memory, and a lost executor costs one step at most.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabload import config
from tabload.config import CastSpec, DeltaSpec
from tabload.functions import keys, numbers, text
from tabload.operators import cast, clean, dedup, delta, joins, links, references, reshape, rules
from tabload.operators.references import Reference
from tabload.sinks.publish import SnapshotStore, StaleRun, bucket_of, validate
from tabload.sources.catalog import Catalog
from tabload.sources.tables import kinds_of

VISIT_TABLE = "Participant_Visit_Info"
CONTAINER_TABLE = "Tube"
LAB_ITEMS = ("Consumable", "Equipment", "Reagent")
MIXED = "_mixed"  # what did not fit the type of its column
UNREAD = "_unread:"  # before the name of a column: true where its cell could not be read, so the stored value stays
ALIQUOT_COLUMNS = {"aliquot.csv": ("Aliquot_ID",), "shipping_manifest.csv": ("Current Label",)}
UNSTRIPPED_TABLES = ("Tube", "Aliquot", *LAB_ITEMS)


@dataclass
class LoadJob:
    """What a load needs besides its files."""

    store: SnapshotStore
    catalog: Catalog
    mapping: dict[str, list[str]]
    sites: DataFrame
    clean_spec: config.CleanSpec = field(default_factory=config.CleanSpec)
    excluded_ids: DataFrame | None = None
    excluded_ages: DataFrame | None = None
    excluded_keys: dict[str, DataFrame] = field(default_factory=dict)
    absent_columns: str = "keep"
    data_release: str = config.DATA_RELEASE
    multi_line: tuple[str, ...] = ()  # file kinds whose quoted cells hold line ends
    encoding: str = "UTF-8"  # of landed files; one whose header cannot be read so is rejected

    @property
    def spark(self) -> SparkSession:
        return self.store.spark


@dataclass
class RunResult:
    run_id: str
    published: bool
    log: DataFrame
    rejects: DataFrame


class Run:
    """One load: staged tables, log rows and rejects."""

    def __init__(self, job: LoadJob, run_id: str):
        self.job = job
        self.run_id = run_id
        self.folder = f"{run_id}/{uuid.uuid4().hex[:12]}"  # of this attempt alone
        self.staged: dict[str, DataFrame] = {}
        self.heads = job.store.heads()
        self.counts: dict[str, int | dict[int, int]] = {}
        self.log: list[tuple[str, str, str, int, str | None]] = []
        self.rejected: list[DataFrame] = []
        self.bucket_digests: dict[str, dict[int, str]] = {}

    def current(self, table: str) -> DataFrame:
        """The table as this run left it, else as it was published."""
        if table not in self.staged:
            schema = self.job.catalog.schema(table)
            head = self.heads.get(table)
            self.staged[table] = self.job.store.open(list(head.paths.values()) if head else None, schema)
        return self.staged[table]

    def compared(self, table: str) -> list[str]:
        """The columns of a table that tell whether a row has changed, and its key."""
        return sorted(c for c in self.job.catalog.schema(table).fieldNames() if c not in config.UNCOMPARED_COLUMNS)

    def digests(self, table: str, rows: DataFrame, keys: list[str]) -> dict[int, tuple[int, str]]:
        """Rows and digest of each bucket, in the types of the table."""
        types = self.job.catalog.schema(table)
        columns = self.compared(table)
        typed = rows.select(*[F.col(f"`{c}`").cast(types[c].dataType).alias(c) for c in columns])
        return {row.bucket: (row.n_rows, row.digest) for row in delta.bucket_digests(typed, bucket_of(keys), columns).collect()}  # at most BUCKETS

    def touched(self, table: str, incoming: DataFrame, keys: list[str]) -> tuple[DataFrame, dict[int, str], DataFrame, int]:
        """The published rows of the buckets that incoming keys fall in, the folders of the other buckets, the incoming rows that are
        left to be compared, and how many are known to be the same.

        A bucket that comes in with the digest it was published with holds the same rows; it counts as not touched. A table that was
        published whole counts as touched whole.
        """
        schema = self.job.catalog.schema(table)
        head = self.heads.get(table)
        if head is None or not head.bucketed:
            return self.current(table), {}, incoming, 0
        if set(self.compared(table)) | set(keys) <= set(incoming.columns):
            found = self.digests(table, incoming, keys)
            equal = {at: n for at, (n, digest) in found.items() if head.digests.get(at) == digest}
            hit = set(found) - set(equal)
        else:
            hit, equal = {row[0] for row in incoming.select(bucket_of(keys)).distinct().collect()}, {}  # at most BUCKETS
        left = incoming.filter(~bucket_of(keys).isin(*equal)) if equal else incoming
        paths = [path for at, path in head.paths.items() if at in hit]
        return self.job.store.open(paths, schema), {at: path for at, path in head.paths.items() if at not in hit}, left, sum(equal.values())

    def put(self, table: str, rows: DataFrame, keys: list[str], rest: dict[int, str]) -> int:
        """Stage the next rows of the touched buckets; their number."""
        written, counts = self.job.store.stage_buckets_counted(rows, self.folder, table, keys)
        self.staged[table] = self.job.store.open([*rest.values(), *written.values()], rows.schema)
        if written and set(self.compared(table)) <= set(rows.columns):
            part = self.job.store.open(list(written.values()), rows.schema)
            self.bucket_digests[table] = {at: digest for at, (_, digest) in self.digests(table, part, keys).items()}
        self.counts[table] = counts
        return sum(counts.values())

    def stage(self, rows: DataFrame, part: str) -> DataFrame:
        return self.job.store.stage(rows, self.folder, part)

    def stage_counted(self, rows: DataFrame, part: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
        """``stage`` with aggregates of the rows, gathered while they are written."""
        return self.job.store.stage_counted(rows, self.folder, part, **metrics)

    def note(self, table: str, op: str, count: int, error: str | None = None) -> None:
        self.log.append((self.run_id, table, op, count, error))

    def failed(self) -> bool:
        return any(row[4] is not None for row in self.log)

    def reject(self, rows: DataFrame, source: str, reason: str) -> None:
        self.rejected.append(
            rows.select(F.lit(source).alias("source"), F.lit(reason).alias("reason"), F.to_json(F.struct("*")).alias("record"))
        )

    def reject_each(self, rows: DataFrame, source: str, reason: str) -> None:
        """Reject rows that tell the reason themselves, in the column ``reason``."""
        record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != reason]))
        self.rejected.append(rows.select(F.lit(source).alias("source"), F.col(reason).alias("reason"), record.alias("record")))

    def finish(self) -> RunResult:
        """Write rejects and log, then publish if nothing failed."""
        empty = self.job.spark.createDataFrame([], "source string, reason string, record string")
        rejects = self.stage(reshape.union_all([empty, *self.rejected]), "rejects")
        ok = not self.failed()
        if ok and self.counts:
            try:
                self.job.store.publish(self.run_id, self.counts, self.heads, self.folder, self.bucket_digests)
            except StaleRun as error:
                self.note("manifest", "error", 0, str(error))
                ok = False
        log = self.job.store.log(self.log)
        return RunResult(self.run_id, ok, log, rejects)


# --- file kinds --------------------------------------------------------------------------------


def cast_spec(types: dict[str, str]) -> CastSpec:
    """Visit numbers stay text: they may be -1 or a word."""
    return CastSpec({c: t for c, t in types.items() if c != "Visit_Number"})


def kind_key(job: LoadJob, kind: str) -> list[str]:
    """Key columns over all target tables of a file kind, under their names in the file."""
    if kind == "shipping_manifest.csv":
        return ["Current Label"]
    tables = job.mapping.get(kind)
    if not tables:
        return ["Biospecimen_ID"]
    found = dict.fromkeys(c for table in tables for e in job.catalog.of(table) if e.primary for c in [e.column])
    found.pop("Biospecimens_Collected", None)
    return ["SARS_CoV_2_PCR_Test_Result" if c == "Test_Result" else c for c in found]


def add_visit(rows: DataFrame, kind: str) -> DataFrame:
    """Visit type, number and key of the kinds that define visits."""
    if kind == "baseline.csv":
        rows = rows.withColumns({
            "Type_Of_Visit": F.lit("Baseline"), "Visit_Number": F.lit("1"), "Unscheduled_Visit": F.lit("No"),
        })
    else:
        base = F.col("Baseline_Visit") == "Yes" if "Baseline_Visit" in rows.columns else F.lit(False)
        rows = rows.withColumn("Type_Of_Visit", F.when(base, "Baseline").otherwise("Follow_up"))
    key = keys.visit_key(F.col("Research_Participant_ID"), F.col("Type_Of_Visit"), F.col("Visit_Number"))
    return rows.withColumns({"Visit_Number": keys.visit_number(F.col("Visit_Number")), "Visit_Info_ID": key})


def prepare_kind(kind: str, rows: DataFrame) -> DataFrame:
    """Rules that read the texts as told: obesity class, aliquot ids with two-digit numbers,
    volumes without N/A; shipped rows need a label."""
    if kind == "baseline.csv" and {"BMI", "Obesity"} <= set(rows.columns):
        rows = rules.obesity_bands(rows)
    if kind == "shipping_manifest.csv":
        rows = clean.require_label(rows, "Current Label")
    for column in ALIQUOT_COLUMNS.get(kind, ()):
        rows = rows.withColumn(column, text.pad_aliquot_id(F.col(f"`{column}`")))
    for column in {"aliquot.csv": ["Aliquot_Volume"], "shipping_manifest.csv": ["Volume"]}.get(kind, []):
        if column in rows.columns:
            rows = rows.withColumn(column, F.regexp_replace(column, "N/A", "0"))
    return rows


def version_kind(run: Run, kind: str, rows: DataFrame) -> DataFrame:
    """Typed rows of a file kind, one per key: values of the last submission, index of the first."""
    job = run.job
    spec = cast_spec(job.catalog.types(*job.mapping.get(kind, [])))
    for column in ALIQUOT_COLUMNS.get(kind, ()):
        if column in rows.columns:
            long = F.coalesce(text.has_third_digit(F.col(f"`{column}`")), F.lit(False))
            run.reject(rows.filter(long), kind, "aliquot number has more than two digits; the id is kept as it is")
    typed = run.stage(cast.schema_cast(prepare_kind(kind, rows), spec, MIXED), f"typed/{kind}")
    names = sorted(row[0] for row in typed.select(F.explode(spec.reject_column)).distinct().collect())  # some of the columns
    marks = {c: f"{UNREAD}{c}" for c in names}
    typed = typed.withColumns({mark: F.when(F.array_contains(spec.reject_column, c), True) for c, mark in marks.items()})
    typed, bad = cast.split_rejects(typed, spec)
    run.reject(bad.drop(*marks.values()), kind, "cell does not fit its column type")
    typed = typed.drop(MIXED)
    if "Submission_Index" in typed.columns:
        typed = typed.withColumn("Submission_Index", F.col("Submission_Index").cast("bigint"))
    by_participant = {"Cohort", "Research_Participant_ID", "Submission_Index"} <= set(typed.columns)
    if by_participant:
        run.reject(typed.filter(F.col("Cohort").isNull()), kind, "no cohort")
        typed = typed.filter(F.col("Cohort").isNotNull())
        exempt = text.site_prefix(F.col("Research_Participant_ID")).isin(*config.COHORT_EXEMPT_SITES)
        typed = dedup.harmonise_latest(
            typed, "Research_Participant_ID", "Cohort", ["Submission_Index", "Cohort"], exempt
        )
    key = kind_key(job, kind)
    if "Visit_Info_ID" in key and "Visit_Info_ID" not in typed.columns:
        if kind in ("baseline.csv", "follow_up.csv"):
            typed = add_visit(typed, kind)
        else:
            key = [*key, "Research_Participant_ID", "Cohort", "Visit_Number"]
            if "Visit_Number" in typed.columns:
                typed = typed.withColumn("Visit_Number", keys.visit_number(F.col("Visit_Number")))
    key = [c for c in dict.fromkeys(key) if c in typed.columns]
    if kind == "submission.csv" or not key or "Submission_Index" not in typed.columns:
        return typed
    typed = typed.drop(*[marks[c] for c in key if c in marks])
    marks = {c: mark for c, mark in marks.items() if c not in key and c != "Submission_Index"}
    rest = [c for c in typed.columns if c not in key and c != "Submission_Index" and not c.startswith(UNREAD)]
    if kind == "shipping_manifest.csv":
        return dedup.keep_last(typed, [f"`{c}`" for c in key], ["Submission_Index", *[f"`{c}`" for c in rest]])
    return dedup.last_value_first_version(typed, key, "Submission_Index", [f"`{c}`" for c in rest] if marks else rest, marks)


def apply_kind_rules(run: Run, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rules that concern one file kind or a kind and its provenance."""
    out = dict(frames)
    if "baseline.csv" in out:
        rows = out["baseline.csv"]
        order = [c for c in ("Visit_Info_ID", "Submission_Index") if c in rows.columns]
        order += [c for c in rows.columns if c not in order and c != "Research_Participant_ID"]
        out["baseline.csv"] = dedup.keep_first(rows, ["Research_Participant_ID"], [f"`{c}`" for c in order])
    for base, kept in (("treatment_history", None), ("cancer_cohort", ("Research_Participant_ID", "Cohort", "Visit_Number", "Cancer_Provenance"))):
        if f"{base}.csv" in out and f"{base}_prov.csv" in out:
            extra = out[f"{base}_prov.csv"]
            extra = extra.select(*kept) if kept else extra.drop("Comments", "Submission_Index", "Submission_CBC")
            pair = [clean.recode_all(rows, config.BASELINE_VISIT_RECODES) for rows in (out[f"{base}.csv"], extra)]
            out[f"{base}.csv"] = joins.enrich_distinct(*pair)
    if "covid_history.csv" in out:
        out["covid_history.csv"], dropped = rules.apply_covid_tree(out["covid_history.csv"])
        run.reject(dropped, "covid_history.csv", "status and symptoms fit no branch")
    second = config.SECONDARY_CONFIRMATION_KIND
    if second in out:
        rows = out[second]
        if "Subaliquot_ID" in rows.columns:
            rows = rows.withColumn("BSI_Parent_ID", text.parent_id(F.col("Subaliquot_ID")))
        out[second] = rows.withColumnsRenamed({"Comments": "Confirmatory_Clinical_Test_Comments"})
    return out


# --- target tables -----------------------------------------------------------------------------


def resolve_visits(run: Run, table: str, kind: str, rows: DataFrame) -> DataFrame:
    """Visit key by participant and visit number; rows without a visit are rejected."""
    if kind == "baseline.csv":
        rows = rows.withColumn("Visit_Number", F.lit("1"))
    if "Visit_Number" not in rows.columns:
        return rows
    rows = rows.withColumn("Visit_Number", keys.visit_number(F.col("Visit_Number")))
    visits = run.current(VISIT_TABLE).select(
        "Visit_Info_ID", "Research_Participant_ID", keys.visit_number(F.col("Visit_Number")).alias("Visit_Number")
    )
    on = joins.shared_columns(rows, visits)
    visits = joins.reachable(visits, rows, on)
    found, lost = joins.resolve_or_reject(rows, visits, on)
    run.reject(lost, f"{kind} > {table}", "no such visit")
    return found


def find_container(run: Run, table: str, rows: DataFrame) -> DataFrame:
    """Container id by the container attributes a specimen or aliquot row carries."""
    prefix, usage = ("Collection_Tube", "Biospecimen_Collection") if table == "Biospecimen" else ("Aliquot_Tube", "Aliquot")
    tubes = run.current(CONTAINER_TABLE)
    if "Tube_Used_For" in tubes.columns:
        tubes = tubes.filter(F.col("Tube_Used_For") == usage).drop("Tube_Used_For")
    renamed = clean.rename_by_part(tubes, {"Tube": prefix})
    on = [c for c in joins.shared_columns(rows, renamed) if c != f"{prefix}_ID"]
    if not on:
        return rows
    types = {c.replace("Tube", prefix): t for c, t in run.job.catalog.types(CONTAINER_TABLE).items()}
    keyed = rows.withColumns({c: cast.typed(F.col(c).cast("string"), types[c]) for c in on})
    one = renamed.groupBy(*on).agg(F.min(f"{prefix}_ID").alias(f"{prefix}_ID"))
    return joins.lookup(keyed, one, on).withColumnsRenamed({"Collection_Tube_ID": "Biospecimen_Tube_ID"})


def assemble(run: Run, table: str, kind: str, rows: DataFrame) -> DataFrame:
    """A file kind in the columns and types of one target table."""
    job = run.job
    columns = [c for c in job.catalog.columns(table) if c != "Data_Release_Version" or kind == "baseline.csv"]
    rows = rows.withColumnsRenamed({"Comments": f"{table}_Comments"})
    if set(config.DURATION_COLUMNS) <= set(rows.columns):
        rows = rows.withColumn(
            "Average_Duration_Of_Test",
            numbers.row_mean(*[numbers.compare_form(F.col(c).cast("string")) for c in config.DURATION_COLUMNS]),
        )
    if table == CONTAINER_TABLE:
        rows = clean.rename_by_part(rows, {
            "Collection_Tube": "Tube", "Aliquot_Tube": "Tube", "Biospecimen_Company": "Biospecimen_Collection_Company",
        })
        usage = {"aliquot.csv": "Aliquot", "biospecimen.csv": "Biospecimen_Collection"}.get(kind)
        rows = rows.withColumn("Tube_Used_For", F.lit(usage)) if usage else rows
    if table == "Assay_Bio_Target":
        # Only types that are columns here matter, so the list is of schema size.
        bare = {c.replace("Target_biospecimen_is_", "").replace("/", "_") for c in rows.columns}
        types = run.current("Biospecimen_Type").filter(F.col("Biospecimen_Type").isin(*bare)).distinct().collect()
        rows = reshape.assay_targets(rows, [r.Biospecimen_Type for r in types])
    if table == VISIT_TABLE:
        if "CBC_Classification" not in rows.columns:
            rows = rows.withColumnsRenamed({"Cohort": "CBC_Classification"})
        if "Visit_Info_ID" not in rows.columns and kind in ("baseline.csv", "follow_up.csv"):
            rows = add_visit(rows, kind)
    elif "Visit_Info_ID" in columns:
        rows = resolve_visits(run, table, kind, rows)
    if table in ("Biospecimen", "Aliquot"):
        rows = find_container(run, table, rows)
    if "Submission_CBC" in columns and "Submission_CBC" not in rows.columns:
        source = "Research_Participant_ID" if "Research_Participant_ID" in rows.columns else "Biospecimen_ID"
        rows = rows.withColumn("Submission_CBC", text.site_prefix(F.col(source)))
    rows = clean.conform(rows, [*columns, *[f"{UNREAD}{c}" for c in columns]])
    spec = cast_spec(job.catalog.types(table))
    typed, bad = cast.split_rejects(cast.schema_cast(rows, spec, MIXED), spec)
    typed = typed.drop(MIXED)
    told = cast_spec(job.catalog.types(*job.mapping.get(kind, []))).types
    if any(told.get(c, "VARCHAR(255)") != spec.types.get(c, "VARCHAR(255)") for c in rows.columns):
        # Only a column that tables type differently can fail here and not before.
        run.reject(bad, f"{kind} > {table}", "cell does not fit its column type")
    return typed


def canonical_rows(table: str, rows: DataFrame) -> DataFrame:
    """Texts of a table as they are stored and compared."""
    rows = clean.canonical_text(rows)
    if table not in UNSTRIPPED_TABLES:
        coded = tuple(c for c in rows.columns if "ICD10" in c or "ICD_10" in c)
        rows = clean.strip_trailing_zeros(rows, (*config.KEEP_TRAILING_ZERO, *coded))
    rows = clean.recode_all(clean.blank_comment(rows), config.CELL_RECODES)
    if "Biospecimens_Collected" in rows.columns:
        rows = clean.recode_columns(rows, {"Biospecimens_Collected": config.SPECIMEN_RECODES})
        rows = clean.fill_labels(rows, {"Biospecimens_Collected": "No Specimens Collected"})
    return rows.drop("Primary_Study_Cohort", "Data_Release_Version")


def total_order(rows: DataFrame, first: list[str], keyed: list[str]) -> list[str]:
    lead = [c for c in first if c in rows.columns]
    return [*lead, *[f"`{c}`" for c in rows.columns if c not in lead and c not in keyed]]


def apply_table_rules(table: str, rows: DataFrame) -> DataFrame:
    """Rules of a target table before it is compared."""
    have = set(rows.columns)
    if table == "Biospecimen" and {"Visit_Info_ID", "Biospecimen_ID"} <= have:
        key = ["Visit_Info_ID", "Biospecimen_ID"]
        rows = dedup.keep_last(rows, key, total_order(rows, ["Biospecimen_Collection_Date_Duration_From_Index"], key))
    if table == "Covid_Vaccination_Status" and "Covid_Vaccination_Status_Comments" in have:
        order = [c for c in ("Vaccination_Status", "Submission_Index") if c in have]
        rows = rules.flag_repeated_vaccinations(rows.distinct(), order)
    if table == "Treatment_History" and {"Visit_Info_ID", "Health_Condition_Or_Disease", "Treatment"} <= have:
        key = ["Visit_Info_ID", "Health_Condition_Or_Disease"]
        rows = dedup.keep_first_ignoring_case(rows, key, "Treatment", total_order(rows, [], key))
    if "Assay_Target_Organism" in have:
        rows = clean.require(rows, "Assay_Target_Organism")
    return rows


def insert_rules(job: LoadJob, table: str, rows: DataFrame) -> DataFrame:
    """Rules for rows that are new to a table."""
    have = set(rows.columns)
    treatment = ["Visit_Info_ID", "Health_Condition_Or_Disease", "Treatment", "Dosage", "Dosage_Units"]
    if "Treatment_History" in table and set(treatment) <= have:
        rows = dedup.keep_first(rows, treatment, total_order(rows, [], treatment) or treatment)
    if {"Biospecimen_ID", "Visit_Info_ID"} <= have:
        rows = dedup.keep_last(rows, ["Biospecimen_ID"], total_order(rows, ["Visit_Info_ID"], ["Biospecimen_ID"]))
    if table in job.excluded_keys:
        listed = job.excluded_keys[table]
        rows = clean.exclude_keys(rows, listed, listed.columns)
    return rows


def incoming_rows(run: Run, table: str, frames: dict[str, DataFrame], key: list[str]) -> DataFrame | None:
    """All file kinds of a table, canonical, one row per key."""
    kinds = [kind for kind in kinds_of(run.job.mapping, table) if kind in frames]
    if not kinds:
        return None
    rows = reshape.union_all([assemble(run, table, kind, frames[kind]) for kind in kinds])
    rows = apply_table_rules(table, canonical_rows(table, rows))
    missing = [c for c in key if c not in rows.columns]
    if missing:
        raise ValueError(f"{table}: key columns {missing} are in none of {kinds}")
    if not key:
        return rows.distinct()
    staged = run.stage(rows, f"assembled/{table}")
    run.reject(staged.filter(reduce(lambda one, other: one | other, [F.col(c).isNull() for c in key])), table, "missing key")
    return dedup.keep_last(clean.require(staged, *key), key, total_order(staged, ["Submission_Index"], key))


def keep_stored(run: Run, table: str, rows: DataFrame, key: list[str]) -> DataFrame:
    """Cells that could not be read take the value the stored row has, so they never erase one; only rows with such cells are looked up."""
    marks = [c for c in rows.columns if c.startswith(UNREAD)]
    plain = rows.drop(*marks)
    if not key or not marks:
        return plain
    columns = [c.removeprefix(UNREAD) for c in marks]
    stored = run.current(table).select(
        *[F.col(f"`{c}`") for c in key], *[F.col(f"`{c}`").alias(f"_stored:{c}") for c in columns]
    )
    unread = reduce(lambda one, other: one | other, [F.col(f"`{mark}`").isNotNull() for mark in marks])
    found = joins.join_on(rows.filter(unread), stored, key, "left")
    filled = found.withColumns({c: F.when(F.col(f"`{UNREAD}{c}`").isNotNull(), F.col(f"`_stored:{c}`")).otherwise(F.col(f"`{c}`")) for c in columns})
    return rows.filter(~unread).select(*[f"`{c}`" for c in plain.columns]).unionByName(filled.select(*[f"`{c}`" for c in plain.columns]))


def load_table(run: Run, table: str, frames: dict[str, DataFrame]) -> None:
    """Classify a table's incoming rows against its current ones and stage the next snapshot."""
    job = run.job
    key = job.catalog.keys(table)
    rows = incoming_rows(run, table, frames, key)
    if rows is None:
        run.note(table, "absent", 0)
        return
    incoming = run.stage(keep_stored(run, table, rows, key), f"incoming/{table}")
    incoming = drop_orphans(run, table, incoming)
    auto, same = job.catalog.auto_column(table), 0
    if not key and auto:
        fresh = links.assign_surrogates(incoming, run.current(table), incoming.columns, auto)
        changes, counts = run.stage_counted(fresh.withColumn("op", F.lit("insert")), f"changes/{table}", **delta.op_metrics("op"))
        spec = DeltaSpec(keys=(auto,), null_keys=False)
        current, rest, _, _ = run.touched(table, changes, [auto])
    else:
        current, rest, incoming, same = run.touched(table, incoming, key) if key else (run.current(table), {}, incoming, 0)
        version = "Submission_Index" if "Submission_Index" not in key else None
        spec = DeltaSpec(keys=tuple(key), version=version, absent_columns=job.absent_columns, null_keys=False)
        labelled = delta.classify(incoming, current, spec, joins.fits_broadcast(incoming.select(*key)))
        is_new = F.col("op") == "insert"
        kept = reshape.union_all([labelled.filter(~is_new), insert_rules(job, table, labelled.filter(is_new))])
        changes, counts = run.stage_counted(kept, f"changes/{table}", **delta.op_metrics(spec.label))
    counts["same"] += same
    for op, count in sorted(counts.items()):
        if count:
            run.note(table, op, count)
    if not counts.get("insert", 0) + counts.get("update", 0):
        return
    few = bool(counts.get("update")) and joins.fits_broadcast(delta.updates(changes, spec))
    count = run.put(table, delta.merge_snapshot(current, changes, spec, few), list(spec.keys), rest)
    check_merge(run, table, spec, changes, count, current.count() + counts.get("insert", 0))


def find_orphans(run: Run, table: str, incoming: DataFrame) -> DataFrame | None:
    """Keys of the incoming rows that cannot be merged, with the names of their broken references; None if the table has no reference.

    A table that refers to itself may also refer to rows that come in with it, as long as these are merged themselves.
    """
    catalog = run.job.catalog
    found = [link for link in catalog.foreign_keys(table) if set(link.columns) <= set(incoming.columns)]
    if not found:
        return None
    key = catalog.keys(table) or incoming.columns
    stored = {link.parent: run.current(link.parent) for link in found}
    to = lambda link, rows: Reference(link.name, link.columns, rows, link.parent_columns)
    own = [to(link, stored[table]) for link in found if link.parent == table and set(link.parent_columns) <= set(incoming.columns)]
    coming = [
        to(link, reshape.union_all([stored[table].select(*link.parent_columns), incoming.select(*link.parent_columns)])) for link in found
        if link.parent == table and set(link.parent_columns) <= set(incoming.columns)
    ]
    others = [to(link, stored[link.parent]) for link in found if link.name not in {r.name for r in own}]
    columns = list(dict.fromkeys(c for link in found for c in link.columns))
    small = joins.fits_broadcast(incoming.select(*[f"`{c}`" for c in columns]))
    lost = run.stage(references.broken(incoming, key, [*others, *coming], small), f"orphans/{table}/direct")
    if own and not lost.isEmpty():
        return references.cascade(incoming, key, lost, own, lambda rows, part: run.stage(rows, f"orphans/{table}/{part}"))
    return lost.withColumn("depth", F.lit(0))


def drop_orphans(run: Run, table: str, incoming: DataFrame) -> DataFrame:
    """Incoming rows whose references exist; the others are logged and rejected, not merged."""
    lost = find_orphans(run, table, incoming)
    if lost is None:
        return incoming
    key = run.job.catalog.keys(table) or incoming.columns
    lost = run.stage(lost, f"orphans/{table}/all")
    orphaned = lost.count()
    if not orphaned:
        return incoming
    run.note(table, "orphan", orphaned)
    parents = F.create_map(*[F.lit(x) for link in run.job.catalog.foreign_keys(table) for x in (link.name, link.parent)])
    named = F.array_join(F.array_sort(F.array_distinct(F.transform("broken", lambda name: parents[name]))), ", ")
    lost = lost.select(*[f"`{c}`" for c in key], F.concat(F.lit("no such row in "), named).alias("_reason"))
    rows = run.stage(joins.join_on(incoming, lost, key), f"orphans/{table}/rows")
    run.reject_each(rows, table, "_reason")
    return run.stage(joins.anti(incoming, lost, key), f"incoming/{table}/with parents")


def check_merge(run: Run, table: str, spec: DeltaSpec, changes: DataFrame, count: int, due: int) -> None:
    """Log an error unless the next snapshot is sound.

    Its keys are unique and present if those of the changes are and its size is as due, since the
    current keys were checked when they came in. So no snapshot row is shuffled for the check.
    """
    applied = changes.filter(F.col(spec.label).isin("insert", "update"))
    found = validate(applied, spec, table).first()
    if found.repeated_keys or found.missing_keys:
        run.note(table, "check", count, f"{found.repeated_keys} repeated and {found.missing_keys} missing keys")
    if count != due:
        run.note(table, "check", count, f"{count} rows instead of {due}")


def load_links(run: Run, item: str, frames: dict[str, DataFrame]) -> None:
    """Link rows (specimen, lab item) of one item table."""
    job = run.job
    table, index = f"Biospecimen_{item}", f"{item}_Index"
    kind = f"{item.lower()}.csv"
    if kind not in frames or table not in job.catalog.tables() or "Biospecimen_ID" not in frames[kind].columns:
        return
    types = cast_spec(job.catalog.types(item))
    items, bad = cast.split_rejects(cast.schema_cast(clean.trim_all(frames[kind]), types), types)
    run.reject(bad, f"{kind} > {table}", "cell does not fit its column type")
    items = canonical_rows(item, items)
    base = run.current(item)
    on = [c for c in joins.shared_columns(items, base) if "Comments" not in c and c != index]
    if not on:
        run.note(table, "error", 0, f"{kind} shares no column with {item}")
        return
    # One id per set of attributes, so no specimen gets several.
    base = base.groupBy(*on).agg(F.min(index).alias(index))
    stored = run.current(table)
    pairs = links.link_table(
        items.select("Biospecimen_ID", *[c for c in on if c != "Biospecimen_ID"]), base, on,
        ["Biospecimen_ID", index], stored, run.current("Biospecimen"), "Biospecimen_ID",
    )
    changes, found = run.stage_counted(pairs.withColumn("op", F.lit("insert")), f"changes/{table}", n=F.count(F.lit(1)))
    count = found["n"]
    run.note(table, "insert", count)
    if count:
        spec = DeltaSpec(keys=("Biospecimen_ID", index), null_keys=False)
        part, rest, _, _ = run.touched(table, changes, list(spec.keys))
        merged = run.put(table, delta.merge_snapshot(part, changes, spec), list(spec.keys), rest)
        check_merge(run, table, spec, changes, merged, part.count() + count)


def load_tables(run: Run, frames: dict[str, DataFrame]) -> None:
    """All target tables the frames feed, parents first. A failure is logged and blocks publishing."""
    job = run.job
    for kind in sorted(set(frames) - set(job.mapping)):
        run.note(kind, "unmapped", 0)
    known = set(job.catalog.tables())
    link_tables = {f"Biospecimen_{item}" for item in LAB_ITEMS}
    wanted = {
        table for kind, tables in job.mapping.items() if kind in frames and "_sql.csv" not in kind for table in tables
    } - link_tables
    for table in sorted(wanted - known):
        run.note(table, "not in catalog", 0)
    parents = {table: job.catalog.parents(table) for table in wanted & known}
    for wave in links.load_order(parents):
        for table in wave:
            try:
                load_table(run, table, frames)
            except Exception as error:  # noqa: BLE001 - recorded; the run is then not published
                run.note(table, "error", 0, f"{type(error).__name__}: {error}")
                return
    for item in LAB_ITEMS:
        if item in parents:
            load_links(run, item, frames)
