"""Fingerprints, near-duplicates, passages and pieces against slow versions."""

import hashlib
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import cases  # noqa: E402
from tabload.llm import graph, minhash, pieces, simhash, suffixes  # noqa: E402
from tabload.llm.queries import PIECE_MODEL  # noqa: E402


def shingles(text, n=5):
    words = cases.WORD.findall(text or "")
    return {tuple(words[at: at + n]) for at in range(max(1, len(words) - n + 1))} if words else set()


def test_fingerprints_estimate_shared_shingles(spark):
    found = [cases.prose(seed, 60 + 10 * seed) for seed in range(30)]
    found += [f"{found[at]} {cases.prose(100 + at, 4 * at + 1)}" for at in range(30)]
    docs = spark.createDataFrame([(at, text, found[at % 30]) for at, text in enumerate(found)], "i int, a string, b string")
    both = minhash.add_fingerprint(minhash.add_fingerprint(docs, "a", "x"), "b", "y")
    got = {r["i"]: r["n"] for r in both.select("i", minhash.likeness("x", "y").alias("n")).collect()}
    errors = []
    for at, text in enumerate(found):
        a, b = shingles(text), shingles(found[at % 30])
        errors.append(got[at] - len(a & b) / len(a | b))
    assert all(got[at] == 1.0 for at in range(30))
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.17


def test_splice_next_goes_round_by_id(spark):
    docs = cases.documents(spark)
    got = {r["id"]: r for r in minhash.splice_next(docs.dropDuplicates(["doc_id"])).collect()}
    known = sorted((r[0], r[1] or "") for r in set(cases.rows()) if r[0] is not None)
    for at, (doc, text) in enumerate(known):
        after = known[(at + 1) % len(known)][1]
        quarter = len(text) // 4
        assert got[doc]["edited"] == text[: len(text) - quarter] + after[:quarter]
    alone = cases.rows()[-1][1]
    assert got[None]["edited"] == alone[: len(alone) - len(alone) // 4]
    repeated = minhash.splice_next(docs).filter(F.col("id") == cases.rows()[4][0]).collect()
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    by_text = {}
    for row in got.values():
        by_text.setdefault(row["text"], set()).add(tuple(row["fp"]))
    assert all(len(prints) == 1 for prints in by_text.values())
    assert by_text[""] == {(0,) * 16}
    assert minhash.splice_next(cases.no_documents(spark)).count() == 0


def test_next_ids_with_far_apart_keys(spark):
    keys = [-(2**62), -5, 0, 1, 2, 3, 10**6, 10**12, 2**62]
    got = dict(minhash.next_ids(spark.createDataFrame([(k,) for k in keys], "k bigint"), "k").collect())
    assert got == dict(zip(keys, [*keys[1:], keys[0]]))


def slow_print(text, words):
    found = [w.translate({c: c + 32 for c in range(65, 91)}) for w in cases.WORD.findall(text or "")]
    if not found:
        return 0
    some = [" ".join(found[at: at + words]) for at in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in some]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("distance", [0, 4, 7])
def test_simhash_groups(spark, distance):
    rows = cases.rows()
    got = simhash.near_duplicates(cases.documents(spark), words=4, distance=distance).collect()
    prints = [slow_print(r[1], 4) for r in rows]
    root = cases.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= distance)
    smallest = {}
    for at, row in enumerate(rows):
        if row[0] is not None:
            smallest[root[at]] = min(row[0], smallest.get(root[at], row[0]))
    want = sorted((repr(r[0]), prints[at], repr(smallest.get(root[at]))) for at, r in enumerate(rows))
    assert sorted((repr(r["id"]), r["fp"] % 2**64, repr(r["component_id"])) for r in got) == want
    assert simhash.near_duplicates(cases.no_documents(spark)).count() == 0


def test_simhash_search_finds_every_link_and_deals_out_crowds(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)  # crowds of a few hundred then go over a grid
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 40, dtype=np.int64)
    found = {int(x) for x in centres}
    for centre in centres[:3]:
        for _ in range(150):
            flips = rng.choice(63, rng.integers(1, 4), replace=False)
            found.add(int(centre) ^ int(sum(1 << int(bit) for bit in flips)))
    prints = np.array(sorted(found), dtype=np.int64)
    edges = simhash.link_edges(spark.createDataFrame([(int(x),) for x in prints], "fp bigint"), 4)
    got = graph.components(edges).collect()
    near = np.bitwise_count((prints[:, None] ^ prints[None, :]).view(np.uint64)) <= 4
    label = np.arange(len(prints))
    while not np.array_equal(new := np.where(near, label[None, :], len(label)).min(axis=1), label):
        label = new
    want = {}
    for at, value in enumerate(prints):
        if near[at].sum() > 1:
            want.setdefault(label[at], set()).add(int(value))
    by_root = {}
    for row in got:
        by_root.setdefault(row["root"], set()).add(row["node"])
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_stars(spark):
    chain = [(at, at + 1) for at in range(100, 400)]
    star = [(0, at) for at in range(1, 60)]
    rows = graph.components(spark.createDataFrame([*chain, *star, (7, 7)], "a bigint, b bigint")).collect()
    by_root = {}
    for row in rows:
        by_root.setdefault(row["root"], set()).add(row["node"])
    assert sorted(map(len, by_root.values())) == [60, 301]


def check_copies(spark, found):
    docs = spark.createDataFrame(found, "doc_id bigint, text string")
    got = {(r["doc_id"], r["text"]): r for r in suffixes.remove_copies(docs).collect()}
    for doc, data, gone in cases.later_bytes(found):
        row = got[(doc, dict(found).get(doc))] if doc is not None else next(v for k, v in got.items() if k[0] is None)
        assert bytes(row["kept"]) == bytes(b for b, flag in zip(data, gone) if not flag), doc
        edges = [at for at in range(len(gone) + 1) if (at < len(gone) and gone[at]) != (at > 0 and gone[at - 1])]
        assert [x for span in row["spans"] for x in span] == edges


def test_later_copies(spark):
    found = [(r[0], r[1]) for r in cases.rows()]
    check_copies(spark, found)


def test_later_copies_in_crowds_and_small_steps(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWDED", 300)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 500)
    monkeypatch.setattr(suffixes, "KEPT_RUNS", 50)
    monkeypatch.setattr(suffixes, "SORTED_WINDOWS", 100)
    passage = cases.prose(1, 25)
    found = [(at, f"{cases.prose(10 + at, 12)} {passage[at % 3:]} {cases.prose(60 + at, 12)}") for at in range(40)]
    found += [(100 + at, "ab" * at) for at in range(20, 60, 7)] + [(200, "x" * 49), (201, "x" * 49), (202, "x" * 50), (203, "x" * 51)]
    check_copies(spark, found)


def test_one_group_of_dashes_is_cut_by_windows(spark):
    """Long lines of one character, each a byte longer than the one before, form one anchor group of millions of windows."""
    found = [(at, "-" * (3000 + at)) for at in range(60)] + [(100 + at, f"{'-' * 200}{at}{'=-' * 300}") for at in range(40)]
    check_copies(spark, found)
    text = pa.array([x.encode() for _, x in found], pa.binary())
    wanted = pa.array([[{"anchor": 1, "start": 0, "n": len(x), "crowded": True}] for _, x in found])
    batch = pa.RecordBatch.from_arrays([pa.array([doc for doc, _ in found], pa.int64()), text, wanted], ["id", "text", "wanted"])
    sent = list(suffixes._cut(iter([batch])))
    assert sum(len(x) for x in sent) < 5000  # 180,000 windows: of equal ones one row and of copies one stretch a document


def test_judging_goes_on_across_batches():
    rows = [(5, b"x" * 50, 3, [0, 7], 50), (5, b"x" * 50, 4, [1], 50), (5, b"y" * 50, 5, [2], 50), (5, b"x" * 50, 5, [9], 50), (6, None, 8, [3], 70)]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.int32()]
    for limit in (10, 10**6):
        for size in (1, 2, 5):
            batches = [pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows[at: at + size]), kinds)], ["a", "b", "c", "d", "e"])
                       for at in range(0, len(rows), size)]
            suffixes.SORTED_WINDOWS, before = limit, suffixes.SORTED_WINDOWS
            try:
                got = {tuple(r.values()) for batch in suffixes._sort_suffixes(iter(batches)) for r in pa.Table.from_batches([batch]).to_pylist()}
            finally:
                suffixes.SORTED_WINDOWS = before
            assert got == {(4, 1, 51), (5, 9, 59), (8, 3, 73)}


def test_previous_smaller_positions():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        doc, shared = rng.integers(0, 6, n), rng.choice([50, 50, 50, 20], n)
        shared[0] = 0
        got = suffixes._previous_smaller(doc, shared) >= 50
        for at in range(n):
            before = [j for j in range(at) if doc[j] < doc[at]]
            assert got[at] == (bool(before) and shared[max(before) + 1: at + 1].min() >= 50)


def test_meeting_runs_across_batches():
    rows = [(1, 1, 5, 0, 60, False), (1, 1, 7, 0, 60, False), (1, 2, 6, 0, 60, False), (2, 9, 1, 0, 60, False), (2, 9, 1, 70, 60, False)]
    for size in (1, 2, 5):
        batches = [
            suffixes._batch(*(np.array(x) for x in zip(*rows[at: at + size]))) for at in range(0, len(rows), size)
        ]
        got = [tuple(r.values()) for batch in suffixes._meet(iter(batches)) for r in pa.Table.from_batches([batch]).to_pylist()]
        assert sorted(got) == [(1, 1, 5, 0, 60, False), (1, 1, 7, 0, 60, True), (1, 2, 6, 0, 60, False)]


def test_no_documents_no_copies(spark):
    assert suffixes.remove_copies(cases.no_documents(spark)).count() == 0


def test_trimmed_texts_are_whole_characters(spark):
    shared = "é" * 60
    found = [(1, shared), (2, "a" + shared), (3, "x" * 10 + shared + "tail"), (4, None), (5, ""), (6, shared)]
    got = dict(suffixes.trim_texts(spark.createDataFrame(found, "doc_id bigint, text string")).select("doc_id", "text").collect())
    assert got == {1: shared, 2: "a", 3: "x" * 10 + "tail", 4: None, 5: ""}


def test_pieces_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    found = [*cases.texts(), "a  b\tc\n d ", "  ", "▁", "\x00a \x00", "<s> </s> <0x41>", "ﬁ ① Å", "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(found)), "i int, text string")
    encoded = pieces.tokenize(docs, PIECE_MODEL, "i").withColumn("back", pieces.decode(F.col("ids"), PIECE_MODEL)).collect()
    assert sorted(row["i"] for row in encoded) == list(range(len(found)))
    for row in encoded:
        want = library.encode(found[row["i"]] or "")
        assert row["ids"] == want and row["decoded"] == row["back"] == library.decode(want), found[row["i"]]
    table = pieces.ChunkTable(PIECE_MODEL)
    for text in found:  # the table forgets in between
        ids, _ = table.encode([text or "", "", text or ""])
        assert ids.tolist() == library.encode(text or "") * 2
        table.clear()


def test_digests_of_an_empty_text(spark):
    from tabload.llm.queries import token_digests

    docs = spark.createDataFrame([(1, "")], "doc_id bigint, text string")
    row = token_digests(pieces.tokenize(docs, PIECE_MODEL)).first()
    nothing = hashlib.sha256(b"").hexdigest()
    assert tuple(row) == (1, 0, nothing, nothing)
