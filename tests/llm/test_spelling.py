import random
import re
import zlib
from collections import Counter

import pytest

from tidewatt.llm import spelling
from tidewatt.llm.queries import op13_spelling_variants

LETTERS = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]


def brute(rows):
    """By looking up every text at one edit of every word."""
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w if h % 199 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in LETTERS} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in LETTERS}
        near[w] = sorted((-n[e], e) for e in edits if e in n and e != w)
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 5 * n[w] else None for w in n}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def rows_of(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def test_the_query_equals_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op13_spelling_variants(spark, sf)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(got) == brute(docs)


@pytest.mark.parametrize("pairs", [1, 6, 1024])
def test_crowded_keys_lose_nothing(spark, monkeypatch, pairs):
    monkeypatch.setattr(spelling, "PAIRS", pairs)
    rng = random.Random(pairs)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(6, 10))) for _ in range(260)} | {"stemstemstem" + "".join(rng.choice("xyz") for _ in range(4)) for _ in range(60)}
    words = sorted(words) + ["a" * k for k in (6, 7, 8, 40, 41)] + ["étéété", "étéétê", "étéeté"]
    docs = [(i, " ".join([w] * rng.choice([4, 5, 6, 30, 200]))) for i, w in enumerate(words)]
    assert rows_of(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    long = "colour " * 60_000 + "b" * 100_000 + " COLOR1colors"
    docs = [(1, None), (2, ""), (None, "Harbour harbour HARBOUR harbours,harbour harbour"), (3, long), (4, "colors " * 6 + "short Short"), (4, "colors " * 6 + "short Short"), (5, "ÉTÉÉTÉ " * 7 + "éTÉÉTÉ " * 40 + "中colourĀcolour"), (6, "abcdef abcdeg " * 5 + "abcdeh " * 25)]
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, word string, n int, g int")
    assert rows_of(spelling.variants(df)) == brute(docs)
    assert spelling.variants(df.limit(0)).collect() == [] and spelling.variants(df.where("doc_id = 2")).collect() == []
