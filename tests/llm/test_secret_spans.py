import hashlib
import itertools
import re

import numpy as np
import pytest

from tidewatt.llm import secret_spans as ss
from tidewatt.llm.queries import op11_secret_spans


def base(text):
    """The contract's patterns, as written; what fails is dropped after matching."""
    found = [("assign", m) for m in re.finditer(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 8]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


written = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def best(field, scores):
    """By trying every sequence of tags."""
    return max(sum(scores[i][t] for i, t in enumerate(tags)) + sum(field.moves[a][b] for a, b in itertools.pairwise(tags)) for tags in itertools.product(range(3), repeat=len(scores)))


def test_the_query_keeps_base_spans_and_adds(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_secret_spans(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        want = base(docs[r["doc_id"]] or "")
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(written(want).encode()).hexdigest()
        assert set(written(want).split(",")) - {""} <= set(r["spans"].split(","))


def test_base_spans_are_those_of_the_contract():
    rng = np.random.default_rng(0)
    parts = ["token", "SECRET", "passwd", "api_key", "ApiKey", "AKIA", "=", ":", " ", "'", '"', "0123456789abcdef" * 2, "abc123", "ABCDEFGH1234", "ſecret", "toKen", "\U0001f511", "\n", "x", "_", "pass", "word", "é"]
    for _ in range(3000):
        text = "".join(parts[i] for i in rng.integers(0, len(parts), 14))
        assert ss.base_spans(text) == base(text), text


@pytest.fixture(scope="module")
def field():
    rng = np.random.default_rng(5)
    words = ["the", "river", "and", "house", "over", "green", "walks", "under", "seven", "ways"]
    said = lambda n: " ".join(words[i] for i in rng.integers(0, len(words), n))
    value = lambda n: "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, n))
    marked = [f'{said(9)} token = "{value(40)}" {said(8)}' for _ in range(40)] + [f"{said(9)} password={value(18)} {said(8)}" for _ in range(40)]
    return ss.learn(ss.examples(marked, [said(40) + ". " + str(k * 7919) for k in range(80)]))


def test_paths_are_the_best_ones(field):
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 7):
        for _ in range(40):
            scores = rng.normal(0, 2, (n, 3)) + [rng.choice([0, 1, 4]), 0, 0]
            tags = field.path(scores)
            own = sum(scores[i][t] for i, t in enumerate(tags)) + sum(field.moves[a][b] for a, b in itertools.pairwise(tags))
            assert np.isclose(own, best(field, scores))


def test_the_field_finds_what_patterns_do_not(field):
    text = 'under seven ways auth: "Zx81kd02Lq9mmP0w4R" and the house over 20240131 green walks'
    assert ss.base_spans(text) == []
    assert [text[a:b] for a, b in field.spans(text)] == ["Zx81kd02Lq9mmP0w4R"]
    assert field.spans("the token is over the house, and the password under seven ways.") == []


def test_likelihood_has_its_gradient():
    """One step's direction against differences of the likelihood by all paths."""
    seqs = [(["a", "b9", "b9"], [0, 1, 2], ["f"]), (["b9", "a"], [1, 0], ["f"])]
    field = ss.learn(seqs, steps=300, ridge=0.5)

    def loss(weights, moves):
        f, out = ss.Field(weights, moves), 0.0
        for words, tags, _ in seqs:
            scores = np.zeros((len(words), 3))
            for i, w in enumerate(words):
                scores[i] = f._sum(ss.own_features(ss.traits(w)) + ["f"])
                for p, j in zip(("p1", "p2", "n1"), (i - 1, i - 2, i + 1)):
                    if 0 <= j < len(words):
                        scores[i] += f._sum([ss.near_shape(p, ss.traits(words[j])), ss.near_word(p, words[j])])
            worth = lambda t: sum(scores[i][x] for i, x in enumerate(t)) + sum(moves[a][b] for a, b in itertools.pairwise(t))  # noqa: E731, B023
            out += worth(tags) - np.log(sum(np.exp(worth(t)) for t in itertools.product(range(3), repeat=len(words))))
        return out - 0.25 * (sum(x * x for w in weights.values() for x in w) + (moves**2).sum())

    at = loss(field.weights, field.moves)
    for f in list(field.weights)[::3]:
        for k in range(3):
            for d in (-0.05, 0.05):
                other = dict(field.weights)
                other[f] = tuple(x + d * (i == k) for i, x in enumerate(other[f]))
                assert loss(other, field.moves) <= at + 1e-4


def test_awkward_rows(spark):
    long = "the river " * 40_000 + "token=abcdefgh12 " + "0" * 300_000 + "é🔑 secret: 'ABCDEFGHIJ'"
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "passwd = short"), (4, "AKIA" + "A" * 12 + " token=token=12345678")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_hex int, spans string")
    field = ss.train(df)
    got = df.select("doc_id", ss.scan(field, "text").alias("s")).select("doc_id", "s.*").collect()
    assert [r["base_sha256"] for r in got] == [hashlib.sha256(written(base(t or "")).encode()).hexdigest() for _, t in rows]
    assert got[0]["spans"] == got[1]["spans"] == "" and got[2] == got[3] and got[2]["n_hex"] == 1 and got[2]["n_assign"] == 2
    empty = df.limit(0)
    assert empty.select(ss.scan(ss.train(empty), "text")).collect() == []
    assert ss.train(df.where("doc_id is null")).spans('auth: "Zx81kd02Lq9mmP0w4R"') == []
