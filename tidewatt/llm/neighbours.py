"""Nearest neighbours by inner product with randomly rotated one-bit codes (operator 4).

Vectors are scaled to length one and turned by a fixed random rotation; the code of a vector is one
sign bit for each dimension, packed, with two correction scalars: its length, and the inner product
of the scaled, turned vector with its code. For a query q of length one and a candidate o with code
x, <q, x> / <o, x> estimates <q, o>, and with high probability errs by at most
``EPSILON * sqrt((1 - <o, x>^2) / (<o, x>^2 (d - 1)))``. In each block of candidates the
most promising are scored first, which gives a threshold; of the others, only those whose upper
bound reaches it are reranked. Scores are the inner products of the original vectors in double
precision, and rows and ranks come from them alone. A neighbour is missed where its bound fails;
the tests measure recall.

Every vector is encoded once. Candidates are cut into blocks of bounded size by a hash, queries
likewise; every pair of blocks is one group that is dealt by key, and gives k rows for each query.
Those are merged in two steps, so no task and no group grows with the input. Every row is indexed
and compared: a query set against all rows, in blocks. The work is queries times rows, and each
vector is sent once for each block of queries.

Vectors that are null, zero or hold null or non-finite components take no part; neither do rows
without an id. A vector meets those of its own length. Where the product of two vectors may leave
the range of doubles, the candidate is reranked whatever its bound; a score that over- or underflows
ranks as it is, one that is not a number last. Repeated vectors tie and go to the smaller id; a row
that is repeated with its id is one candidate for each time, but one query: of the vectors that
share an id the least, compared in order of components, is searched for. With fewer candidates than
k all are returned. Tables without rows give none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.lasting import lasting

#: Standard deviations of the estimate that the bound allows. It never errs by more than
#: sqrt(d - 1), which is used where dimensions are few and tails heavy.
EPSILON = 3.0
FEW = 16
#: Times k candidates whose scores set the threshold.
FIRST = 4
#: Bytes of doubles in a block of candidates and of queries.
BLOCK_BYTES = 4 << 20
QUERY_BYTES = 8 << 20
#: Products of lengths outside of this are reranked without a bound.
SAFE = (1e-290, 1e300)


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix, the same for each dimension everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and their lengths; squares neither over- nor underflow."""
    most = np.abs(vectors).max(axis=1)
    part = vectors / most[:, None]
    length = np.sqrt((part * part).sum(axis=1))
    with np.errstate(over="ignore"):
        return part / length[:, None], most * length


class Codes:
    """Packed sign bits of turned vectors, with their lengths and inner products with the codes."""

    def __init__(self, d: int, bits: np.ndarray, inner: np.ndarray, length: np.ndarray):
        self.d, self.bits, self.inner, self.length = d, bits, inner, length

    @classmethod
    def of(cls, vectors: np.ndarray) -> Codes:
        unit, length = scaled(vectors)
        d = vectors.shape[1]
        turned = unit @ rotation(d)
        return cls(d, np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(d), length)

    def estimates(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines of the candidates (columns) with turned queries of length one (rows),
        and how far each candidate's may be from the true ones."""
        signs = np.unpackbits(self.bits, axis=1, count=self.d).astype(np.float32)
        signs = (signs * 2 - 1) / (self.inner * np.sqrt(self.d)).astype(np.float32)[:, None]
        epsilon = np.sqrt(max(1, self.d - 1)) if self.d <= FEW else EPSILON
        error = epsilon * np.sqrt(np.maximum(0, 1 - self.inner**2) / (self.inner**2 * max(1, self.d - 1)))
        return turned.astype(np.float32) @ signs.T, error.astype(np.float32)


def nearest_in_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, codes: Codes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, candidate ids, scores): the k best of the block for each query."""
    out = []
    unit, long = scaled(q)
    turned = unit @ rotation(q.shape[1])
    by_id = np.argsort(cid, kind="stable")
    low, high = (np.searchsorted(cid[by_id], qid, side=s) for s in ("left", "right"))
    first = min(FIRST * k, len(cid))
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        for i in range(0, len(q), 128):
            estimate, error = codes.estimates(turned[i : i + 128])
            n = len(estimate)
            upper = (estimate + error).astype(np.float64) * codes.length
            estimate = estimate * codes.length
            product = long[i : i + 128, None] * codes.length
            wide = ~((product > SAFE[0]) & (product < SAFE[1]) & (codes.length < SAFE[1])[None, :] & np.isfinite(upper))
            estimate[wide] = -np.inf
            own = np.zeros(estimate.shape, bool)
            for j in range(n):
                own[j, by_id[low[i + j] : high[i + j]]] = True
            estimate[own] = -np.inf
            # The k-th score among the most promising is a threshold that the k best of all reach.
            top = np.argpartition(estimate, len(cid) - first, axis=1)[:, len(cid) - first :]
            row, at = np.repeat(np.arange(n), first), top.ravel()
            score = np.where(estimate[row, at] > -np.inf, (unit[row + i] * c[at]).sum(axis=1), -np.inf).reshape(n, -1)
            threshold = np.partition(score, first - k, axis=1)[:, first - k] if first >= k else np.full(n, -np.inf)
            slack = np.where(np.isfinite(threshold), np.abs(threshold) * 1e-5, 0)
            reach = ((upper >= (threshold - slack)[:, None]) | wide) & ~own
            for j in range(n):
                a = np.flatnonzero(reach[j])
                v = q[i + j]
                if len(a) > k and not wide[j, a].any():
                    # The k best of those, with whatever rounding could hide; their scores are then summed alike for equal vectors.
                    rough = c[a] @ unit[i + j]
                    a = a[rough >= np.partition(rough, len(a) - k)[len(a) - k] - 1e-9 * codes.length[a].max()]
                out.append((np.full(len(a), i + j), a, (v * c[a]).sum(axis=1)))
    row, at, score = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    order = np.lexsort((cid[at], -np.where(np.isnan(score), -np.inf, score), row))
    row, at, score = row[order], at[order], score[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return qid[row[best]], cid[at[best]], score[best]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v) of the rows that take part; v is an array of float where it was one, else of double."""
    kind = "array<float>" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast(kind).alias("v")).where("id is not null and v is not null")
    return rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))


def encoded(rows: DataFrame) -> DataFrame:
    """Adds the code of v: bits, inner, length."""

    @F.pandas_udf("bits binary, inner double, length double")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vs in batches:
            out = pd.DataFrame({"bits": pd.Series([b""] * len(vs), dtype=object), "inner": 0.0, "length": 0.0})
            for d, own in vs.groupby(vs.map(len).to_numpy()):
                codes = Codes.of(np.stack(own).astype(float))
                at = own.index
                out.loc[at, "inner"], out.loc[at, "length"] = codes.inner, codes.length
                out.loc[at, "bits"] = pd.Series([b.tobytes() for b in codes.bits], at, dtype=object)
            yield out

    return rows.withColumn("_code", code("v")).select("id", "v", "_code.*")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k candidates with the largest inner products. is_query:
    of the column ``id``."""
    # A stored number deals candidates out, so that very many rows of one id don't meet in one block.
    rows = lasting(encoded(usable(vectors, vec_id, embedding)).withColumn("_row", F.monotonically_increasing_id()))
    n, nq, longest = rows.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v"))).first()
    room = lambda m, size: max(1, -(-m * 8 * (longest or 1) // size))
    blocks, query_blocks = room(n, BLOCK_BYTES), room(nq, QUERY_BYTES)
    number = lambda m, what, by: F.pmod(F.xxhash64(F.lit(what), by), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = rows.withColumn("b", number(blocks, "c", "_row")).select(F.size("v").alias("d"), "b", every(query_blocks).alias("qb"), F.col("id").alias("cid"), F.col("v").alias("cv"), "bits", "inner", "length")
    asked = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    queries = asked.withColumn("qb", number(query_blocks, "q", "id")).select(F.size("v").alias("d"), every(blocks).alias("b"), "qb", "id", "v")

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            got = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            bits = np.frombuffer(b"".join(right["bits"]), np.uint8).reshape(len(right), -1)
            codes = Codes(int(key[0]), bits, right["inner"].to_numpy(), right["length"].to_numpy())
            got = nearest_in_block(left["id"].to_numpy(), np.stack(left["v"]).astype(float), right["cid"].to_numpy(), np.stack(right["cv"]).astype(float), codes, k)
        return pd.DataFrame({"query_id": got[0], "vec_id": got[1], "score": got[2], "b": key[1]})

    found = queries.groupBy("d", "b", "qb").cogroup(candidates.groupBy("d", "b", "qb")).applyInPandas(search, "query_id long, vec_id long, score double, b int")
    # A score that is not a number comes last.
    best = lambda keys: Window.partitionBy(*keys).orderBy(F.isnan("score"), F.desc("score"), "vec_id")
    found = found.withColumn("_g", (F.col("b") / 32).cast("int"))
    found = found.withColumn("_r", F.row_number().over(best(["query_id", "_g"]))).where(F.col("_r") <= k)
    ranked = found.withColumn("rank", F.row_number().over(best(["query_id"]))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
