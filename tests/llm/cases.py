"""Rows that every operator of the training-data subpackage must cope with, and slow versions to compare with."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor sit amet " * 4000

# columns that are no business of the operators, with names they use themselves
CLASHING = ["id", "fp", "found", "copies", "size", "score", "mix", "target", "spans", "kept", "host", "of", "source_size"]

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *(T.StructField(name, T.StringType()) for name in CLASHING),
])


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary)}" for _ in range(words))


def texts():
    """Distinct prose, exact and near copies, shared passages, and the odd cases."""
    passage = prose(99, 60)
    base = [prose(seed, 80) for seed in range(12)]
    near = [f"{base[3]} end", base[3].replace(" ", "  ", 1), base[3] + "."]
    shared = [f"{prose(50 + at, 30)} {passage} {prose(80 + at, 30)}" for at in range(4)]
    odd = [None, "", " ", "\n\t", "a", "é" * 70, "日本語 テスト 🎉", "▁ ▁▁x", "12 34", "the the the the " * 30, LONG, LONG]
    return base + base[:2] + near + shared + odd


def rows(found=None):
    out = []
    for at, text in enumerate(texts() if found is None else found):
        lang = None if at % 7 == 5 else ["en", "fr"][at % 2]
        source = None if at % 5 == 4 else f"s{at % 3}"
        out.append((at * 3 + 1, text, lang, source, len(text or ""), *(f"x{at}" for _ in CLASHING)))
    out.append(out[4])  # a repeated row
    out.append((None, "a row without an id, with a text of its own", "en", "s0", 3, *("y" for _ in CLASHING)))
    return out


def documents(spark, found=None):
    return spark.createDataFrame(rows(found), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(keys, linked):
    """Smallest reachable key of each position, by plain search."""
    root = list(range(len(keys)))
    changed = True
    while changed:
        changed = False
        for a in range(len(keys)):
            for b in range(len(keys)):
                if linked(a, b) and root[b] > root[a]:
                    root[b] = root[a]
                    changed = True
    return root


def later_bytes(found, length=50):
    """(id, text) to removed flags per byte, by looking up every string of so many bytes."""
    first = {}
    encoded = [(doc, (text or "").encode()) for doc, text in found]
    for doc, data in encoded:
        if doc is not None:
            for at in range(len(data) - length + 1):
                key = data[at: at + length]
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, data in encoded:
        gone = [False] * len(data)
        if doc is not None:
            for at in range(len(data) - length + 1):
                if first[data[at: at + length]] < doc:
                    gone[at: at + length] = [True] * length
        out.append((doc, data, gone))
    return out
