import hashlib
import random

import numpy as np
import pytest

from tidewatt.llm import codes
from tidewatt.llm.queries import op12_vector_codes


def brute(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label) -> vec_id: (code, error, label_error), and the digest."""
    kept = [(i, [int(np.floor(4096 * float(x))) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = len(kept[0][1]) // parts
    cut = lambda v: [v[p * size : p * size + size] for p in range(parts)]
    least = sorted(kept, key=lambda r: (r[0], r[1]))[:entries]
    books = [[list(cut(v)[p]) for _, v, _ in least] for p in range(parts)]

    def assigned(v):
        out = []
        for p, own in enumerate(cut(v)):
            far = [sum((a - b) ** 2 for a, b in zip(own, e)) for e in books[p]]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = [assigned(v) for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), f in zip(kept, found) if f[p][0] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = [assigned(v) for _, v, _ in kept]
    error = [sum(x[1] for x in f) for f in found]
    total = {}
    for (_, _, c), e in zip(kept, error):
        total[c] = total.get(c, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, "".join("%02x" % x[0] for x in f), e, total[c]) for (i, _, c), f, e in zip(kept, found, error)), digest


def test_the_query_equals_plain_rounds(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = op12_vector_codes(spark, sf).collect()
    want, digest = brute(rows)
    assert sorted(tuple(r)[:4] for r in got) == want and {r["codebooks_sha256"] for r in got} == {digest}


def test_the_query_equals_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    q = con.execute(codes.oracle())
    names = [d[0] for d in q.description]
    assert sorted(tuple(r[n] for n in names) for r in op12_vector_codes(spark, sf).collect()) == sorted(q.fetchall())


@pytest.mark.parametrize("block", [7, 4096])
def test_codes_of_awkward_rows(spark, monkeypatch, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0, 0.0]) + rng.randrange(3) / 4096 for _ in range(16)], rng.choice(["a", "b", None])) for i in range(5, 120)]
    rows += [(i, rows[0][1], "a") for i in range(130, 260)] + [(5, rows[3][1], "b"), (6, rows[1][1], None), rows[9]]
    rows += [(300, None, "a"), (301, [float("nan")] * 16, "a"), (302, [float("-inf")] + [0.0] * 15, None), (303, [None] + [0.0] * 15, "b")]
    odd = [(400, [1.0] * 8, "a"), (401, [], "b"), (402, [40000.0] * 16, None)]
    kind = "vec_id long, embedding array<double>, label string, code int, id int, _l int"
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows + odd], kind).repartition(3)
    order = lambda rows: sorted(tuple(r)[:4] for r in rows)
    got = codes.compress(df).collect()
    want, digest = brute(rows)
    assert order(r for r in got if r["code"] is not None) == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
    assert sorted(r["vec_id"] for r in got if r["code"] is None) == [400, 401, 402] and all(r["error"] is None for r in got if r["vec_id"] >= 400)
    few = codes.compress(df.where("vec_id between 7 and 9")).collect()
    assert order(few) == brute([r for r in rows if 7 <= r[0] <= 9])[0]
    assert codes.compress(df.limit(0)).collect() == [] and codes.compress(df.where("vec_id = 401")).first()["code"] is None


def test_trees_cover_and_assign_exactly():
    rng = np.random.default_rng(1)
    x = rng.integers(-900, 900, (700, 4)) * (rng.random((700, 1)) < 0.8)
    tree = codes.Tree.of(x)
    assert (tree.points[tree.at] == x).all() and tree.count[-1] == len(x)
    for (centre, start, end, child, last), r in zip(tree.nodes, tree.radius):
        assert np.sqrt(((tree.points[start:end] - tree.points[centre]) ** 2).sum(axis=1)).max() <= r + 1e-9
        inner = tree.nodes[child:last]
        if len(inner):
            assert inner[0][1] == start and inner[-1][2] == end and (inner[1:, 1] == inner[:-1, 2]).all()
            apart = np.sqrt(((tree.points[inner[:, 0]][:, None] - tree.points[inner[:, 0]][None]) ** 2).sum(axis=2))
            assert (apart[~np.eye(len(inner), dtype=bool)] > r / 2).all()
    for entries in (rng.integers(-900, 900, (16, 4)), np.repeat(rng.integers(-9, 9, (4, 4)), 4, axis=0)):
        far = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        found = tree.assign(entries)
        assert (found[tree.at] == far.argmin(axis=1)).all()
        n, total = tree.gathered(found, 16)
        assert all(n[e] == (far.argmin(axis=1) == e).sum() and (total[e] == x[far.argmin(axis=1) == e].sum(axis=0)).all() for e in range(16))
