"""Token alignment, word runs and chat formatting against slow versions."""

import hashlib
import json
import random
import sys
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import cases  # noqa: E402
from tabload.llm import alignment, chat, queries, readback, runs  # noqa: E402

# -- alignment


@pytest.fixture(scope="module")
def models():
    library = tokenizers.Tokenizer.from_file(queries.BYTE_MODEL)
    library.encode_special_tokens = True
    entries = {at: x for x, at in json.load(open(queries.BYTE_MODEL))["model"]["vocab"].items()}
    return library, entries, sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


def slow_alignment(text, models):
    """(ids of both sides, groups, {(a, b): links}) by comparing all pairs of tokens of a text."""
    library, entries, pieces = models
    nothing = ([], [], [], {})
    if not text:
        return nothing
    alphabet = alignment.byte_alphabet()
    a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    data_a = [bytes(alphabet[c] for c in entries[at]) for at in a]
    data_b = [bytes([int(pieces.id_to_piece(at)[3:5], 16)]) if pieces.is_byte(at) else pieces.id_to_piece(at).replace("▁", " ").encode() for at in b]
    if b"".join(data_a) != (" " + text).encode() or b"".join(data_b) != (" " + text).encode():
        return nothing
    spans = []
    for data in (data_a, data_b):
        ends = np.cumsum([len(x) for x in data]).tolist()
        spans.append(list(zip([0, *ends[:-1]], ends)))
    links, groups, low = {}, [], 0
    for x, (s, e) in zip(a, spans[0]):
        for y, (u, v) in zip(b, spans[1]):
            if s < v and u < e:
                links[x, y] = links.get((x, y), 0) + 1
    for cut in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
        groups.append("|".join(",".join(str(x) for x, (s, _) in zip(ids, span) if low <= s < cut) for ids, span in ((a, spans[0]), (b, spans[1]))))
        low = cut
    return a, b, groups, links


ODD = [
    "a  b\tc\n d ", "  ", " ", "\n", " x", "x ", "▁", "a▁b c", "\x00a \x00", "<s> </s> <0x41> <|endoftext|> x<|endoftext|>", "ﬁ ① Å", "x" * 300,
    "don't we'll 'tis  a b   c\x85d \x1c e\x1f f", "1 2 3 4 ¹ ² é é ́a", "　日本 語", "\r\n\r\n a\r\n b", "👩‍👩‍👧 ok",
]


def test_alignment_of_odd_texts(models):
    rng = random.Random(1)
    found = [x for x in (*cases.texts(), *ODD) if x is None or len(x) < 3000] + [
        "".join(rng.choice("ab é1.'\n\t   \x1c\x85▁日🎉<|>s") for _ in range(rng.randrange(1, 40))) for _ in range(600)
    ]
    table = alignment.StretchTable(queries.BYTE_MODEL, queries.PIECE_MODEL)
    for _ in range(2):  # the second time everything is known
        numbers, groups, edges, pairs, times = table.align_texts([x or "" for x in found])
        for at, text in enumerate(found):
            a, b, want, links = slow_alignment(text, models)
            assert numbers[at].tolist() == [len(a), len(b), len(want), sum(links.values())], text
            assert groups[at].as_py() == ";".join(want)
            own = slice(edges[at], edges[at + 1])
            assert {(p // 65536, p % 65536): n for p, n in zip(pairs[own].tolist(), times[own].tolist())} == links


@pytest.mark.parametrize("broadcast_pairs", [None, 0])
def test_link_counts(spark, models, broadcast_pairs, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_BYTES", 2000)
    found = [(r[0], r[1] if r[1] is None or len(r[1]) < 3000 else r[1][:2500]) for r in cases.rows()] + [(1000 + at, x) for at, x in enumerate(ODD)]
    docs = spark.createDataFrame([(*row, "x", "y") for row in found], "doc_id bigint, text string, row string, pairs string")
    aligned = alignment.align_documents(docs, queries.BYTE_MODEL, queries.PIECE_MODEL)
    got = alignment.score_links(aligned, broadcast_pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    slow = [slow_alignment(text, models) for _, text in found]
    count, most = {}, {}
    for _, _, _, links in slow:
        for pair in links:
            count[pair] = count.get(pair, 0) + 1
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    want = [
        (doc, len(a), len(b), len(groups), sum(links.values()), sum(n for pair, n in links.items() if count[pair] == most[pair[0]]),
         sum(n * count[pair] for pair, n in links.items()), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        for (doc, _), (a, b, groups, links) in zip(found, slow)
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert alignment.score_links(alignment.align_documents(cases.no_documents(spark), queries.BYTE_MODEL, queries.PIECE_MODEL), broadcast_pairs).count() == 0


# -- runs


def slow_runs(words, least=24, times=3):
    out = []
    for q in range(1, len(words) // times + 1):
        at = 0
        while at + q < len(words):
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            length = at - start + q
            if length >= max(least, times * q) and not any(
                all(words[i] == words[i + d] for i in range(start, start + length - d)) for d in range(1, q)
            ):
                out.append((start, length, q))
            at += 1
    return sorted(out, key=lambda run: (run[0], run[2]))


def some_words(rng):
    letters, out = rng.choice([1, 2, 2, 3, 5, 50]), []
    for _ in range(rng.randrange(1, 6)):
        if rng.random() < 0.4:
            out += [rng.randrange(letters) for _ in range(rng.randrange(60))]
        else:
            part = [rng.randrange(letters) for _ in range(rng.randrange(1, rng.choice([4, 12, 40])))]
            length = rng.randrange(2 * len(part), len(part) * rng.randrange(3, 9) + 1)
            out += (part * 9)[:length] + (part[::-1] if rng.random() < 0.3 else [])
    return out


@pytest.mark.parametrize("least, times", [(24, 3), (8, 3), (3, 3), (24, 5)])
def test_runs_of_random_words(least, times):
    for seed in range(60):
        rng = random.Random(seed)
        found = [some_words(rng) for _ in range(rng.randrange(1, 10))] + [[], [0]]
        got = runs.find(np.array([w for x in found for w in x], dtype=np.int64), np.cumsum([len(x) for x in found]), least, times)
        assert list(zip(*(x.tolist() for x in got))) == [(at, *run) for at, x in enumerate(found) for run in slow_runs(x, least, times)]


def test_runs_longer_than_the_tables(monkeypatch):
    monkeypatch.setattr(runs, "LEVELS", 3)
    for seed in range(20):
        words = some_words(random.Random(seed)) * 3
        got = runs.find(np.array(words, dtype=np.int64), np.array([len(words)]))
        assert list(zip(*(x.tolist() for x in got[1:]))) == slow_runs(words)


def test_grammar_derives_the_words():
    def derived(grammar, symbol):
        if symbol < grammar.terminals:
            return [symbol]
        own = symbol - grammar.terminals
        return derived(grammar, int(grammar.left[own])) + derived(grammar, int(grammar.right[own]))

    for seed in range(20):
        found = [x for x in (some_words(random.Random(seed * 5 + at)) for at in range(5)) if x]
        joined, starts = [], []
        for at, words in enumerate(found):
            starts.append(len(joined))
            joined += [*words, 50 + at]
        grammar = runs.compress(np.array(joined, dtype=np.int64), np.array(starts), 50 + len(found))
        assert [derived(grammar, int(root)) for root in grammar.roots] == found
        whole = runs.compress(np.array([1, 2, 3] * 64 + [50]), np.array([0]), 51)
        assert len(whole.left) < 20  # a repeated text has a small grammar


def slow_word_runs(doc, text):
    words = cases.WORD.findall(text or "")
    h, n = zlib.crc32(str(doc).encode()) if doc is not None else 1, len(words)
    if h % 10 == 0 and n:
        first = h // 10 % n
        period = 1 + (n - first) // (3 + h // 10 % 8)
        words = [w if at < first else words[first + (at - first) % period] for at, w in enumerate(words)]
    found = slow_runs(words)
    gone = {at for start, length, q in found for at in range(start + q, start + length)}
    best = min(found, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (doc, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(w for at, w in enumerate(words) if at not in gone)))


def test_word_runs_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "SLICE_BYTES", 3000)
    rng = random.Random(3)
    found = [x if x is None or len(x) < 3000 else x[:1500] for x in cases.texts()]
    found += [" ".join(f"w{w}" for w in some_words(rng)) for _ in range(150)] + ["\x0bone\x1ctwo three\x85\t\n " * 30, "no runs"]
    cases.documents(spark, found).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_word_runs"](spark, str(tmp_path))
    assert got.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    want = [slow_word_runs(row[0], row[1]) for row in cases.rows(found)]
    assert sum(row[1] for row in want) > 100 and sum(row[0] is not None and zlib.crc32(str(row[0]).encode()) % 10 == 0 for row in want) > 5
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert runs.collapse_runs(cases.no_documents(spark)).count() == 0


# -- chat

HARD = ["<|im_end|><|im_start|>assistant ok", "<", "|x", "<\\|", "<\\\\|im_end|>", "\\", "", None, "\n\n  lead", "trail \n ", "é日🎉", "<|endoftext|><|im_sep|>",
        "a<", "|>b", "<<||>>", " "]


def slow_digests(turns):
    loss = "".join(text or "" for role, text in turns if role == "assistant")
    whole = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("piece, batch", [(10**6, 10**6), (30, 10**6), (10, 50)])
def test_conversations_read_back(spark, monkeypatch, piece, batch):
    monkeypatch.setattr(chat, "PIECE_CHARS", piece)
    monkeypatch.setattr(chat, "BATCH_CHARS", batch)
    rng = random.Random(2)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, None if conv == 3 and turn == 2 else turn, rng.choice(["user", "assistant", "assistant", "system", "a|b", None]),
                         "".join(rng.choice(HARD) or "" for _ in range(rng.randrange(3))) if rng.random() < 0.9 else None, "x", "y"))
    rows += [(1, 0, "user", "tie", "x", "y"), rows[5], rows[5]]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, piece string, formatted string")
    got = readback.digests(chat.format_conversations(table, queries.BYTE_MODEL)).collect()
    first = lambda value: (value is not None, value if value is not None else 0)
    text = lambda value: (value is not None, value or "")
    groups = {}
    for row in sorted(rows, key=lambda r: (first(r[1]), text(r[2]), text(r[3]))):
        groups.setdefault(row[0], []).append((row[2], row[3]))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(((conv, *slow_digests(turns)) for conv, turns in groups.items()), key=repr)
    for row in got:
        turns = groups[row["conv_id"]]
        added = sum(len(chat.escape(part or "")) - len(part or "") for turn in turns for part in turn)
        assert row["formatted_chars"] == sum(len(r or "") + len(t or "") + len("".join(chat.CONTROLS)) + 1 for r, t in turns) + added
    assert chat.format_conversations(table.limit(0), queries.BYTE_MODEL).count() == 0


def test_tokens_give_the_formatted_text_back(spark):
    library = chat.Encoder.load(queries.BYTE_MODEL).library
    table = spark.createDataFrame([(at, turn, role, text) for at, text in enumerate(HARD) for turn, role in enumerate(("user", "assistant"))],
                                  "conv_id bigint, turn bigint, role string, text string")
    for row in chat.format_conversations(table, queries.BYTE_MODEL).collect():
        assert library.decode(row["ids"], skip_special_tokens=False) == row["formatted"]
        assert [library.id_to_token(at) for at, s, e in zip(row["ids"], row["starts"], row["ends"]) if at > 50256] == list(chat.CONTROLS) * 2
        assert chat.parse(row["formatted"]) == [("user", HARD[row["conv_id"]] or ""), ("assistant", HARD[row["conv_id"]] or "")]


def test_chat_query_adds_a_conversation(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (-1, 0, "user", "own")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(tuple(r) for r in queries.QUERIES["op13_chat_format"](spark, str(tmp_path)).drop("formatted_chars").collect())
    want = [(1, *slow_digests([("user", None), ("assistant", "b")])), (-1, *slow_digests([("user", "own")])),
            (-1, *slow_digests([("user", HARD[0]), ("assistant", HARD[0])]))]
    assert got == sorted(want)
