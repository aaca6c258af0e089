"""Mixing, classifiers, URL rules and embeddings."""

import re
import sys
import tracemalloc
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import cases  # noqa: E402
from tabload.llm import language, mixing, quality, toxicity, urlfilter, vectors  # noqa: E402
from tabload.llm.urlfilter import HostWord, Rule  # noqa: E402

DATA = "/root/testdata/sf0.1"


def test_budgets_share_the_excess():
    budget = mixing.share_out({"a": 100, "b": 10, "c": 1000, None: 0}, (1, 2, 3), 3)
    assert budget["b"] == 30 and budget[None] == 0 and abs(sum(budget.values()) - 1110) < 1e-6
    assert abs(budget["c"] - 3 * budget["a"]) < 1e-6 or budget["a"] == 300
    assert mixing.share_out({}, (1, 2, 3), 3) == {}


def test_mix_comes_near_its_targets(spark):
    found = [(at, cases.prose(at, 5 + at % 40), f"s{min(at % 9, 4)}" if at % 11 else None) for at in range(2000)]
    docs = spark.createDataFrame(found, "doc_id bigint, text string, source string")
    plan = mixing.plan_mix(docs)
    got = mixing.apply_mix(docs, plan).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.apply_mix(docs, mixing.plan_mix(docs)).collect()))
    for source in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == source]
        taken = sum(r["copies"] * len(r["text"].split()) for r in own)
        assert abs(taken - own[0]["target"]) <= 45 and max(r["copies"] for r in own) <= 3
    repeated = mixing.repeat_copies(mixing.apply_mix(docs, plan), "copies")
    assert repeated.count() == sum(r["copies"] for r in got)


def test_mix_of_odd_rows(spark):
    docs = cases.documents(spark)
    got = mixing.apply_mix(docs, mixing.plan_mix(docs), copies_col="times")
    assert got.count() == docs.count() and set(docs.columns) <= set(got.columns)
    sizes = {r[0]: r[1] for r in docs.select("doc_id", mixing.word_count(F.col("text"))).collect()}
    assert all(size == len(cases.WORD.findall(text or "")) for doc, text, *_ in cases.rows() for size in [sizes[doc]])
    empty = cases.no_documents(spark)
    assert mixing.apply_mix(empty, mixing.plan_mix(empty)).count() == 0
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert mixing.apply_mix(blank, mixing.plan_mix(blank)).agg(F.sum("copies")).first()[0] == 0


def held(doc, folds):
    return zlib.crc32(str(doc).encode()) % folds


def documents_and(spark, name):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/{name}.parquet")


def test_language_of_held_out_documents(spark):
    from tabload.llm.queries import language_id

    found = language_id(spark, DATA).join(documents_and(spark, "labels")[0].select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert all(held(r["doc_id"], 4) == 2 for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98


def test_language_of_odd_rows(spark):
    docs = cases.documents(spark)
    model = language.train(docs)
    got = docs.withColumn("judged", language.predict(spark, model, F.col("text"))).collect()
    for row in got:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["judged"]["lang"] == "und") == (not letters) and 0 <= row["judged"]["score"] <= 1
    for nothing in (cases.no_documents(spark), docs.withColumn("lang", F.lit(None).cast("string"))):
        untaught = language.train(nothing)
        assert {r[0]["lang"] for r in docs.select(language.predict(spark, untaught, F.col("text"))).collect()} == {"und"}


def test_language_score_is_that_of_the_whole_formula():
    rng = np.random.default_rng(1)
    table = np.log(rng.random((language.BUCKETS, 3)))
    model = language.Model(["a", "b", "c"], table, np.log([0.5, 0.3, 0.2]))
    texts = ["Ab c", "", "12", "é" * 400, "xyz. Xyz"]
    best, score = model.score(texts)
    for at, text in enumerate(texts):
        total, seen = np.zeros(3), 0
        for buckets, _ in language.ngrams([text]):
            total += table[buckets].sum(axis=0)
            seen += len(buckets)
        if not seen:
            assert best[at] == -1 and score[at] == 0
            continue
        joint = total + model.log_prior
        chance = np.exp((joint - joint.max()) * min(1, language.WEIGHT_OF / seen))
        assert best[at] == joint.argmax() and score[at] == pytest.approx((chance / chance.sum()).max())


def test_language_does_not_depend_on_the_length_of_the_text():
    """A common language does not win against the evidence of a long text: each n-gram speaks a little for the rare one."""
    table = np.tile(np.log([1.0, np.exp(0.03)]), (language.BUCKETS, 1))
    model = language.Model(["common", "rare"], table, np.log([0.98, 0.02]))
    texts = ["ab" * n for n in (3, 100, 1000, 100_000)]
    best, score = model.score(texts)
    assert best.tolist() == [0, 1, 1, 1]
    assert (score[1:] < 0.999).all() and (score >= 0.5).all()


def test_quality_of_held_out_documents(spark):
    from tabload.llm.queries import quality_scores

    found = quality_scores(spark, DATA).join(documents_and(spark, "labels")[1].select("doc_id", "quality"), "doc_id")
    rows = found.filter("held_out").collect()
    assert all(held(r["doc_id"], 3) == 1 for r in rows)
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.97
    assert min(np.mean([r["predicted"] == k for r in rows if r["quality"] == k]) for k in (0, 1)) > 0.9


def slow_features(text):
    """The features of a text, character by character."""
    data, kind = text.encode(), []
    for byte in data:
        c = chr(byte) if byte < 128 else ""
        kind.append("lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "line" if c == "\n"
                    else "space" if c in set(" \t\x0b\x0c\r") else "stop" if c in set(".,;:'\"()-") else "loud" if c in set("!?")
                    else "bar" if c == "|" else "symbol" if c and c.isprintable() else "other")
    words, lines = data.split(), data.split(b"\n")
    n = max(1, len(words))
    loud = sum(a in ("loud", "bar", "symbol") and b in ("space", "line") for a, b in zip(kind, kind[1:]))
    return [
        *(kind.count(name) / max(1, len(data)) for name in quality._CLASSES), loud / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(words)) / n, (len(set(zip(words, words[1:]))) + 1) / n, len(set(lines)) / len(lines), np.log(1 + len(data)), np.log(1 + len(words)),
        min(50.0, len(data) / n), np.log(1 + len(words) / len(lines)),
    ]


def test_quality_against_slow_features_and_pairs():
    rng = np.random.default_rng(4)
    texts = [cases.prose(at, 20 + at) for at in range(40)] + [f"{cases.prose(at, 15).upper()}!!! | x|y ? \n\n" * 2 for at in range(40)] + [
        x[:3000] for x in cases.texts() if x] + ["", "a", "\x00é"]
    slow = np.array([slow_features(x) for x in texts])
    assert np.allclose(quality.describe([x.encode() for x in texts]), slow)
    labels = np.array([1] * 40 + [0] * 40)
    model = quality.fit(slow[:80], labels, 0.5)
    x = [[min(8.0, max(-8.0, (v - c) / s)) for v, c, s in zip(row, model.centre, model.spread)] for row in slow]
    strength = [sum(a * w for a, w in zip(row, model.weights)) for row in x]
    want = [1 / (1 + np.exp(-min(60.0, max(-60.0, s - model.threshold)))) for s in strength]
    assert np.allclose(model.scores([t.encode() for t in texts]), want)
    # no step in any direction makes the pairs likelier: the penalised loss of all pairs of the two classes, drawn as the fit draws them
    high, low = range(40), range(40, 80)
    draw = np.random.default_rng(quality.SEED)
    better = [*np.repeat(high, quality.PARTNERS), *draw.choice(high, quality.PARTNERS * 40)]
    worse = [*draw.choice(low, quality.PARTNERS * 40), *np.repeat(low, quality.PARTNERS)]

    def loss(weights):
        ahead = np.array([np.dot(np.subtract(x[a], x[b]), weights) for a, b in zip(better, worse)])
        return np.log1p(np.exp(-ahead)).mean() + quality.RIDGE / 2 * np.dot(weights, weights)

    least = loss(model.weights)
    for _ in range(20):
        assert loss(model.weights + rng.normal(0, 0.05, len(model.weights))) > least
    assert min(strength[:40]) > model.threshold > max(strength[40:80])


def test_quality_learns_from_all_labelled_documents(spark):
    """More documents of each class than a sample once held: centre, pairs and threshold come from every one, however they are dealt."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["one", "Two", "three!", "4", "fives |"], 3 + at % 7)) + ("!!" if at % 2 and at % 11 else "") for at in range(18_500)]
    labels = np.array([0 if at % 2 else 1 for at in range(len(texts))])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    known = spark.createDataFrame([(at, int(x)) for at, x in enumerate(labels)], "doc_id bigint, quality int")
    model = quality.train(docs, known)
    x = quality.describe([t.encode() for t in texts])
    assert np.allclose(model.centre, x.mean(axis=0), rtol=1e-12, atol=1e-12)
    assert np.allclose(model.spread, np.maximum(x.std(axis=0), 1e-6))
    strength = np.sort(model.strengths(x))
    low = int((labels == 0).sum())
    inside = strength[low - 2: low + 1]
    assert inside[0] <= model.threshold <= inside[2] and np.isclose(model.threshold, quality._middle(inside))
    assert np.corrcoef(model.strengths(x), quality.fit(x, labels, low / len(labels)).strengths(x))[0, 1] > 0.99
    again = quality.train(docs.repartition(7), known.repartition(3))
    assert np.allclose(again.weights, model.weights) and np.isclose(again.threshold, model.threshold)


def slow_toxicity(model, text):
    """1 - product over sentences of 1 - p, sentence by sentence."""
    clean_chance = 1.0
    for sentence in re.split(r"[.!?\n]", text.lower()):
        words = re.findall(r"[^\W_]+", sentence)
        if words:
            logit = model.bias + sum(model.weights[b] for word in words for b in toxicity.features_of(word))
            clean_chance *= 1 - 1 / (1 + np.exp(-logit))
    odds = max(1 - clean_chance, 1e-12) / clean_chance
    return odds / np.exp(model.shift) / (1 + odds / np.exp(model.shift))


def test_toxicity_against_a_slow_noisy_or():
    rng = np.random.default_rng(6)
    model = toxicity.Model(rng.normal(0, 0.3, toxicity.BUCKETS), -2.0, 0.7)
    texts = ["", "one", "One two. THREE_four!? \n five", "...!", "é ü. 日本 語", *(f"{cases.prose(at, 12)}. {cases.prose(at + 50, 7)}!" for at in range(30))]
    got = model.scores(toxicity.Tokens(), texts)
    assert np.allclose(got, [slow_toxicity(model, x) for x in texts], atol=1e-9)
    bad = [f"{cases.prose(at, 9)}. you vile{at % 5} wretch. {cases.prose(at + 300, 9)}" for at in range(120)]
    good = [f"{cases.prose(at + 600, 9)}. {cases.prose(at + 900, 9)}. you there" for at in range(120)]
    labels = np.array([1] * 120 + [0] * 120)
    fitted = toxicity.fit(bad + good, labels, (120, 120))
    scores = np.array([slow_toxicity(fitted, x) for x in bad + good])
    assert ((scores >= 0.5) == (labels == 1)).mean() > 0.97


def test_toxicity_of_held_out_documents(spark):
    from tabload.llm.queries import toxicity_scores

    found = toxicity_scores(spark, DATA).join(documents_and(spark, "labels")[1].select("doc_id", "toxic"), "doc_id")
    rows = found.filter("held_out").collect()
    assert all(held(r["doc_id"], 5) == 0 for r in rows)
    assert np.mean([r["toxic"] == r["predicted"] for r in rows]) > 0.95
    assert np.mean([r["predicted"] == 1 for r in rows if r["toxic"] == 1]) > 0.75


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_rows(spark, module, label):
    docs = cases.documents(spark)
    marks = [(r[0], at % 2) for at, r in enumerate(cases.rows())] + [(None, 1), (1, None), (1, 0), (1, 1), (99_999, 1)]
    labels = spark.createDataFrame(marks, f"doc_id bigint, {label} int")
    model = module.train(docs, labels)
    got = docs.withColumn("judged", module.score(spark, model, F.col("text"))).collect()
    assert all(0 <= r["judged"] <= 1 for r in got)
    by_text = {}
    for row in got:
        by_text.setdefault(row["text"] or "", set()).add(row["judged"])
    assert all(len(scores) == 1 for scores in by_text.values())
    for marks, constant in (([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0), ([(-1, 0), (-2, 1)], 0.5)):
        known = spark.createDataFrame(marks, f"doc_id bigint, {label} int")
        assert {r[0] for r in docs.select(module.score(spark, module.train(docs, known), F.col("text"))).collect()} == {constant}
    empty = cases.no_documents(spark)
    assert empty.select(module.score(spark, model, F.col("text"))).count() == 0


def test_offending_sentences_are_located(spark):
    rng = np.random.default_rng(2)
    found, labels = [], []
    for at in range(400):
        parts = [cases.prose(1000 + 7 * at + k, 8, 60) for k in range(6)]
        if at % 4 == 0:
            parts[rng.integers(6)] += " nasty insult"
        found.append(". ".join(parts) + ".")
        labels.append(int(at % 4 == 0))
    model = toxicity.fit(found, np.array(labels), (300, 100))
    docs = spark.createDataFrame([(found[at],) for at in range(0, 40)], "text string")
    for row in docs.select("text", toxicity.locate(spark, model, F.col("text")).alias("bad")).collect():
        sentences = [row["text"][x["start"]: x["stop"]] for x in row["bad"]]
        assert all("nasty" in s for s in sentences) and bool(sentences) == ("nasty" in row["text"])


def test_quality_describes_in_little_memory():
    rng = np.random.default_rng(5)
    some = [bytes(rng.choice(np.frombuffer(b"aA1 \n.!|#\xc3", np.uint8), 4_000)) for _ in range(50)]
    long = b"".join(some)
    assert (quality.describe([b"", long, *some]) == np.concatenate([quality.describe([x]) for x in (b"", long, *some)])).all()
    assert np.allclose(quality.describe([long])[0, : len(quality._CLASSES)], np.mean([quality.describe([x])[0, : len(quality._CLASSES)] for x in some], axis=0))
    for texts in ([b"a" * 2_000_000], [b"a" * 4_000] * 250):
        tracemalloc.start()
        quality.describe(texts)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 8 * sum(map(len, texts))


URLS = [
    "https://a.COM/x", "http://com/", "http://com", "ftp://www.example.com/en/y?q#f", "http://example.com/en/1", "http://m.example.com/en/",
    "http://notexample.com/en/", "http://example.com/en", "http://x.net/es/", "http://net/fr/z", "http://casino.net/de/", "http://free-casino.com/",
    "http://casinos.org/", "no scheme", "", None, "://", "http://a.org?x=://b.com/", "http://A.É.Org/Ü#x", "http://a b.com/\nq", "http://ads.example.org/ads/1.gif",
    "http://q.org/ads/deep/1.gif", "http://q.org/adsx/1.gif", "http://x.net/es/", "http://x.net/es/",
]
RULES = [
    Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"), Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"), Rule("", "/ads/*.gif", "block"), Rule("org", "", "allow"), HostWord("casino", "block"),
]


def slow_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in rules:
        if isinstance(rule, HostWord):
            if rule.word in "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in host).split():
                fits.append((0, None, rule.verdict))
            continue
        before, star, after = rule.path.partition("*")
        if (not rule.host or host == rule.host or host.endswith("." + rule.host)) and path.startswith(before) and (
            not star or after in path[len(before):]
        ):
            fits.append((len(rule.name), rule.name, rule.verdict))
    best = max(fits, key=lambda x: x[0], default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("rules", [RULES, RULES[:5], []])
def test_url_rules(spark, rules):
    pages = spark.createDataFrame([(at, url, "h", "r") for at, url in enumerate(URLS)], "page_id bigint, url string, best string, _best string")
    got = urlfilter.judge_urls(pages, rules).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == [
        (at, *slow_verdict(url, rules)) for at, url in enumerate(URLS)
    ]
    assert urlfilter.judge_urls(pages.limit(0), rules).count() == 0
    clashing = pages.selectExpr("*", "'h' as _host", "'p' as _path", "'b' as best", "'f' as fits_host", "'x' as rule", "'t' as token")
    again = urlfilter.judge_urls(clashing, rules)
    assert again.select("_host", "_path", "best", "fits_host", "token").distinct().collect() == [("h", "p", "b", "f", "t")]
    assert sorted(map(tuple, again.select(*pages.columns, "host", "path", "rule", "verdict").collect()), key=repr) == sorted(
        ((*(r[c] for c in pages.columns), r["host"], r["path"], r["rule"], r["verdict"]) for r in got), key=repr)


def test_rarest_token_files_a_rule(spark):
    urls = spark.createDataFrame([("a.example.com", "/en/"), ("b.example.com", "/en/x"), ("b.org", "/")], "host string, path string")
    filed = {r["rule"]: r["filed"] for r in urlfilter.index_rules(urls, [Rule("a.example.com", "/en/", "block"), Rule("", "/*", "allow")]).collect()}
    assert filed == {"a.example.com/en/": "a", "/*": ""}


def slow_links(found, threshold=0.9):
    good = [
        x is not None and len(x) > 0 and all(v is not None and np.isfinite(v) for v in x) and any(v != 0 for v in x) for x in found
    ]
    units = [np.array(x, float) / np.linalg.norm(np.array(x, float)) if ok else None for x, ok in zip(found, good)]
    near = [[a != b and good[a] and good[b] and len(found[a]) == len(found[b]) and units[a] @ units[b] >= threshold
             for b in range(len(found))] for a in range(len(found))]
    return near


def embeddings():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 8))
    found = [list(map(float, np.float32(c + rng.normal(0, 0.1, 8)))) for c in centres for _ in range(8)]
    found += [found[0]] * 40 + [None, [0.0] * 8, [float("nan")] * 8, [None] + [1.0] * 7, [float("inf")] + [1.0] * 7, [-0.0] * 8, [], [1.0]]
    return found


@pytest.mark.parametrize("leaf, block", [(400, 1000), (20, 1000), (20, 4)])
def test_embedding_groups(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(vectors, "LEAF", leaf)
    monkeypatch.setattr(vectors, "BLOCK", block)
    found = embeddings()
    rows = spark.createDataFrame(list(enumerate(found)), "vec_id bigint, embedding array<float>")
    got = {r["id"]: r for r in vectors.near_duplicates(rows).collect()}
    near = slow_links(found)
    links = sum(map(sum, near))
    assert len(got) == len(found)
    assert all(got[at]["n_links"] <= sum(near[at]) for at in range(len(found)))
    assert sum(r["n_links"] for r in got.values()) >= (links if leaf == 400 else 0.95 * links)
    if leaf == 400:
        root = cases.groups(found, lambda a, b: near[a][b])
        assert all(got[at]["component_id"] == root[at] and got[at]["kept"] == (root[at] == at) for at in range(len(found)))
    assert vectors.near_duplicates(rows.limit(0)).count() == 0
    assert vectors.near_duplicates(rows.filter("vec_id >= 280").limit(2)).count() == 2


def test_forest_recall(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet")
    table = duckdb.sql(f"select vec_id, embedding from '{DATA}/embeddings.parquet' order by vec_id").fetchnumpy()
    units = np.stack(table["embedding"]).astype(float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    links = int((units @ units.T >= 0.9).sum()) - len(units)
    found = vectors.near_duplicates(rows).agg(F.sum("n_links")).first()[0]
    assert 0.9 * links <= found <= links


def planted(n, size=64, crowd=3):
    """Unit-like vectors: a third (one of ``crowd``) distinct near copies of one, the rest in pairs at a cosine of 0.9 to 0.95."""
    rng = np.random.default_rng(11)

    def unit(rows):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    centre = unit(rng.standard_normal((1, size)))
    hot = unit(centre + rng.standard_normal((n // crowd, size)) * 0.31 / np.sqrt(size))
    first = unit(rng.standard_normal(((n - len(hot)) // 2, size)))
    other = rng.standard_normal(first.shape)
    other = unit(other - (other * first).sum(axis=1, keepdims=True) * first)
    cosine = rng.uniform(0.901, 0.95, (len(first), 1))
    found = np.concatenate((hot, first, cosine * first + np.sqrt(1 - cosine**2) * other))
    return found[rng.permutation(len(found))].astype(np.float32)


def true_links(found):
    """Links and smallest reachable position of each vector, compared in blocks."""
    units = found.astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    links, near = np.zeros(len(units), np.int64), [[np.empty(0, np.int64)], [np.empty(0, np.int64)]]
    for start in range(0, len(units), 1000):
        a, b = np.nonzero(units[start: start + 1000] @ units.T >= 0.9)
        a += start
        links += np.bincount(a[a != b], minlength=len(units))
        for held, side in zip(near, vectors.forest(a[a < b], b[a < b])):
            held.append(side)
    low, high = vectors.forest(*(np.concatenate(x) for x in near))
    root = np.arange(len(units))
    root[high] = low
    return links, root


def test_a_crowd_of_near_copies_keeps_its_links(spark):
    found = planted(24_000)
    links, root = true_links(found)
    rows = spark.createDataFrame(pa.table({"vec_id": np.arange(len(found)), "embedding": pa.array(list(found), pa.list_(pa.float32()))}))
    got = vectors.near_duplicates(rows).toPandas().sort_values("id")
    assert len(got) == len(found) and links.sum() > 40_000_000
    assert (got["n_links"].to_numpy() <= links).all()
    assert got["n_links"].sum() >= 0.999 * links.sum()
    assert (got["component_id"].to_numpy() == root).all()


@pytest.mark.parametrize("size", [64, 256])
def test_further_levels_are_fitted_in_tasks(spark, monkeypatch, size):
    """A driver sample of some hundred vectors tells 5 levels; the others come from histograms, and find as much."""
    monkeypatch.setattr(vectors, "SAMPLE", 600)
    monkeypatch.setattr(vectors, "LEAF", 60)
    found = planted(6000, size, crowd=6)
    links, root = true_links(found)
    rows = spark.createDataFrame(pa.table({"vec_id": np.arange(len(found)), "embedding": pa.array(list(found), pa.list_(pa.float32()))}))
    assert vectors.levels(6000) == 7
    got = vectors.near_duplicates(rows).toPandas().sort_values("id")
    assert (got["n_links"].to_numpy() <= links).all()
    assert got["n_links"].sum() >= 0.995 * links.sum()
    assert (got["component_id"].to_numpy() == root).mean() >= 0.98


def test_a_vector_near_every_cut_is_filed_on_all_sides():
    trees = vectors.Forest(np.ones((vectors.TREES, 6, 1)), np.zeros((vectors.TREES, 63)), 0.1)
    row, leaf = trees.leaves(np.array([[0.05], [1.0], [-1.0]]), 0)
    assert sorted(leaf[row == 0].tolist()) == list(range(64)) and leaf[row == 1].tolist() == [63] and leaf[row == 2].tolist() == [0]


def test_cuts_of_histograms_are_those_of_sorted_projections():
    rng = np.random.default_rng(2)
    for off in (rng.standard_normal(4000), np.concatenate((rng.normal(0.5, 0.05, 3000), rng.standard_normal(1000))), np.full(100, 0.3)):
        bins, n = np.unique(np.searchsorted(vectors.BINS, off), return_counts=True)
        one, other = vectors.best_cut(np.sort(off), 0.2), vectors.best_bin(bins, n, 0.2)
        if np.isinf(one):
            assert np.isinf(other)
            continue
        pairs = [(off <= cut + 0.2).mean() ** 2 + (off >= cut - 0.2).mean() ** 2 for cut in (one, other)]
        assert pairs[1] <= pairs[0] + 0.05


def test_every_vector_length_has_links(spark):
    rng = np.random.default_rng(5)
    found = [list(map(float, np.float32(c + rng.normal(0, 0.1, size)))) for size in (8, 5, 3) for c in rng.standard_normal((4, size)) for _ in range(size)]
    found += [[1.0, 2.0], [2.0, 4.0], [1.0, 2.0], [2.0, 1.0, 0.0, 0.0], [7.0], None, [0.0, 0.0]]
    rows = spark.createDataFrame(list(enumerate(found)), "vec_id bigint, embedding array<float>")
    got = {r["id"]: r for r in vectors.near_duplicates(rows).collect()}
    near = slow_links(found)
    root = cases.groups(found, lambda a, b: near[a][b])
    assert [(got[at]["n_links"], got[at]["component_id"]) for at in range(len(found))] == [(sum(near[at]), root[at]) for at in range(len(found))]
