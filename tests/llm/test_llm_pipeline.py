"""The pipeline against a slow version, and its behaviour on odd rows."""

import hashlib
import random
import sys
from pathlib import Path

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import cases  # noqa: E402
import corpus_pipeline  # noqa: E402
from tabload.llm import language, mixing, resemblance  # noqa: E402
from tabload.llm.queries import PIECE_MODEL  # noqa: E402
from test_llm_text import slow_print  # noqa: E402


def shingle_set(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in cases.WORD.findall(text or "")]
    return {tuple(words[at: at + 5]) for at in range(max(1, len(words) - 4))} if words else set()


def edited_copies():
    """Copies of one text with more and more edited words: near ones by their shingles, of which fingerprints link some and not others."""
    rng, found = random.Random(8), []
    words = cases.prose(4242, 120).split()
    for edits in (0, 1, 2, 3, 5, 8, 12):
        copy = list(words)
        for place in rng.sample(range(len(words)), edits):
            copy[place] = f"edit{rng.randrange(10**6)}"
        found.append(" ".join(copy))
    return found


def slow_pipeline(spark, docs):
    """Rows of the last stage, each stage done row by row in plain Python."""
    model = language.train(docs)
    rows = [r.asDict() for r in docs.collect()]
    best, score = model.score([r["text"] or "" for r in rows])
    rows = [r for r, b, s in zip(rows, best, score) if b >= 0 and s >= corpus_pipeline.LEAST_SCORE]

    sets = [shingle_set(r["text"]) for r in rows]
    root = cases.groups(sets, lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    first = {}
    for r, at in zip(rows, root):
        if r["doc_id"] is not None:
            first[at] = min(r["doc_id"], first.get(at, r["doc_id"]))
    kept = {(r["doc_id"], r["text"]): r for r, at in zip(rows, root) if r["doc_id"] == first.get(at)}
    rows = list(kept.values())

    out = []
    for r, (_, data, gone) in zip(rows, cases.later_bytes([(r["doc_id"], r["text"]) for r in rows])):
        at, text = 0, ""
        for char in r["text"]:
            size = len(char.encode())
            text += "" if all(gone[at: at + size]) else char
            at += size
        if text or not any(gone):
            out.append(r | {"text": text})
    rows = out

    place = {
        r["doc_id"]: (r["size"], r["at"]) for r in spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id bigint, text string")
        .select("doc_id", mixing.word_count(F.col("text")).alias("size"), mixing.position(F.col("doc_id"), F.col("text")).alias("at")).collect()
    }
    totals = {}
    for r in rows:
        totals[r["source"]] = totals.get(r["source"], 0) + place[r["doc_id"]][0]
    budget = mixing.share_out(totals, mixing.WEIGHTS, mixing.MOST_COPIES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    result = []
    for source, total in totals.items():
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: place[r["doc_id"]][1])
        whole = min(3, int(budget[source] // total)) if total else 0
        rest, more = budget[source] - whole * total, True
        for r in own:
            size = place[r["doc_id"]][0]
            more = more and (size <= rest or 2 * rest >= size) and rest > 0
            times = whole + more
            if size > rest:
                more = False
            rest -= size
            ids = library.encode(r["text"])
            digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            back = hashlib.sha256(library.decode(ids).encode()).hexdigest()
            result += [(r["doc_id"], len(ids), digest, back)] * times
    return sorted(result, key=repr)


@pytest.mark.parametrize("many", [False, True])
def test_pipeline_equals_the_slow_version(spark, tmp_path, many):
    found = [cases.prose(at, 30 + at % 50) for at in range(150)] if many else []
    copies = edited_copies()
    prints, sets = [slow_print(x, 4) for x in copies], [shingle_set(x) for x in copies]
    near = [len(sets[0] & x) >= 0.8 * len(sets[0] | x) for x in sets]
    assert any(near) and not all(near) and near != [(prints[0] ^ x).bit_count() <= 4 for x in prints]
    docs = cases.documents(spark, cases.texts() + copies + found)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == slow_pipeline(spark, docs)


def test_stages_keep_all_columns(spark):
    docs = cases.documents(spark)
    for nothing in (docs, cases.no_documents(spark)):
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, nothing, "")
            assert out.dtypes == nothing.dtypes
            assert out.count() <= 3 * nothing.count()
        assert corpus_pipeline.STAGES[-1][1](spark, nothing, "").count() == nothing.count()


def test_clean_documents_stay(spark):
    found = [(at, cases.prose(at, 60), "en", "s", 1) for at in range(60)]
    docs = spark.createDataFrame(found, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, step in corpus_pipeline.STAGES[:3]:
        assert step(spark, docs, "").count() == 60


@pytest.mark.parametrize("block", [512, 2])
def test_edited_copies_go(spark, monkeypatch, block):
    monkeypatch.setattr(resemblance, "BLOCK", block)
    rng = random.Random(4)
    found = []
    for at in range(40):
        words = cases.prose(1000 + at, 150).split()
        for edits in (0, 1, 2, 3, 4, 6):
            edited = list(words)
            for place in rng.sample(range(len(words)), edits):
                edited[place] = f"edit{rng.randrange(10**6)}"
            found.append(" ".join(edited))
    sets = [{tuple(x.split()[at: at + 5]) for at in range(len(x.split()) - 4)} for x in found]
    root = cases.groups(found, lambda a, b: a // 6 == b // 6 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    rows = [(at, text, "en", "s", 1) for at, text in enumerate(found)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert left == set(root)


def test_a_step_gives_memory_back_when_its_task_ends():
    """What a step has freed below a block that is still in use does not stay with the worker."""
    from tabload.llm.common import tidy

    def resident():
        return next(int(x.split()[1]) // 1024 for x in open("/proc/self/status") if x.startswith("VmRSS"))

    pins = []

    def step(batches):
        for batch in batches:
            many = [bytes(2000) for _ in range(100_000)]
            pins.append(bytes(2000))
            yield batch
            del many

    grown = []
    for run in (step, tidy(step)):
        before = resident()
        assert list(run(iter([1]))) == [1]
        grown.append(resident() - before)
    assert grown[0] > 100 and grown[1] < 0  # in MB


def test_near_fingerprints_propose_and_exact_sets_decide(spark):
    """Without a MinHash key in common: texts with near fingerprints are linked if their sets are alike, and only then."""
    words = cases.prose(77, 400).split()
    texts = [" ".join(words), " ".join([*words[:-1], "edited"]), cases.prose(78, 400), "", " ".join([*words[:-2], "other", "end"])]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array([x.encode() for x in texts], pa.binary())], ["id", "text"])
    made = next(resemblance._sketch(iter([batch]), 5, False)).to_pylist()
    assert [r["fp"] for r in made[:3]] == resemblance.simhash.fingerprints([x.encode() for x in texts[:3]], 5).tolist()
    assert made[3]["fp"] is None and made[3]["bands"] == []
    prints = [made[0]["fp"], made[0]["fp"] ^ 0b1111, made[0]["fp"] ^ 0b1, None, made[0]["fp"] ^ (0b11111 << 40)]
    rows = spark.createDataFrame([(at, t.encode()) for at, t in enumerate(texts)], "id bigint, text binary")
    found = spark.createDataFrame(
        [(r["id"], r["node"], fp, []) for r, fp in zip(made, prints)], "id bigint, node bigint, fp bigint, bands array<bigint>"
    )
    id_of = {r["node"]: r["id"] for r in made}
    edges = {frozenset((id_of[r["a"]], id_of[r["b"]])) for r in resemblance.link_edges(rows, found, 5, 0.8).collect()}
    assert edges == {frozenset((0, 1))}  # 2 is near by its fingerprint only, 4 alike but out of reach of fingerprints
