"""Best-fit packing (operator 2): few sequences of bounded length from documents of any length.

Documents are tokenised and cut into pieces where Spark has them. Only the histogram of the piece
lengths, at most ``limit`` counts, reaches the driver. There, patterns of few lengths are
enumerated, non-negative least squares fits how often each repeats, the fits are rounded down to
what the histogram can give, and the residual is packed best fit first, lengths in descending
order, runs of like sequences at a time. The result is a plan of a few slots per length. In Spark
each piece gets its number among the pieces of its length, counted within random groups so that a
length, an id or a piece that a third of all rows share is no hot spot, and takes its place from the
plan. The random numbers are written with the pieces, so they stay.

Null texts count as empty: one piece that holds the separator only. Rows are told apart by content
and number, so repeated rows and null ids are packed like any others. Tables without rows give no
sequences. Columns other than doc_id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.bpe import transducer
from tidewatt.llm.lasting import lasting

#: Rows that one hashed group of one length should have about.
GROUP_ROWS = 4_000


def token_pieces(docs: DataFrame, tokenizer: str, limit: int = 2048, separator: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's ids with the separator behind
    them, cut every ``limit`` ids."""

    @F.pandas_udf("array<struct<piece int, start long, length long, ids_crc32 long>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = transducer(tokenizer)
        for texts in batches:
            rows = []
            for ids in bpe.encode_batch(texts):
                raw = np.append(ids, separator).astype("<u4")
                rows.append([{"piece": k, "start": at, "length": min(limit, len(raw) - at), "ids_crc32": zlib.crc32(raw[at : at + limit].tobytes())} for k, at in enumerate(range(0, len(raw), limit))])
            yield pd.Series(rows, dtype=object)

    return docs.select("doc_id", F.explode(cut(F.col("text"))).alias("_p")).select("doc_id", "_p.*")


def enumerate_patterns(histogram: np.ndarray, depth: int = 4, spread: int = 6) -> np.ndarray:
    """Rows of at most ``depth`` lengths, 0 for none, that fill a sequence: every length as often
    as it fits, every pair that fits exactly, and for each length up to a third of the limit
    triples and quadruples that fit exactly, spread over the lengths that occur."""
    limit = len(histogram) - 1
    there = np.flatnonzero(histogram)
    if not len(there):
        return np.zeros((0, depth), np.int64)
    found = {(int(a),) * max(1, min(depth, limit // int(a))) for a in there}
    found |= {(limit - int(a), int(a)) for a in there if a <= limit - a and histogram[limit - a]}
    mass = np.cumsum(histogram[there]) / histogram.sum()
    for k in (3, 4)[: max(0, depth - 2)]:
        for a in there[there <= limit // k].tolist():
            middle = there[(there >= a) & (there <= (limit - a * (k - 2)) // 2)]
            if len(middle):
                for b in np.unique(middle[np.searchsorted(m := mass[np.isin(there, middle)], np.linspace(m[0], m[-1], spread))].clip(0, limit)).tolist():
                    rest = limit - a * (k - 2) - b
                    if rest >= b and histogram[rest]:
                        found.add((rest, b, *[a] * (k - 2)))
    patterns = sorted(found, reverse=True)
    return np.array([p + (0,) * (depth - len(p)) for p in patterns], np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Non-negative least squares of pattern counts against the histogram, by projected gradient
    with momentum; longer lengths weigh more, as they are harder to place later."""
    limit = len(histogram) - 1
    weight = np.sqrt(np.arange(limit + 1) / limit)
    weight[0] = 0
    used = patterns > 0
    target = histogram * weight
    x = y = np.zeros(len(patterns))
    gather = lambda v: (np.where(used, (v * weight)[patterns], 0)).sum(axis=1)
    spread = lambda v: np.bincount(patterns.ravel(), np.repeat(v, patterns.shape[1]), limit + 1) * weight
    v = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue, for the step
        v = gather(spread(v))
        v /= max(np.linalg.norm(v), 1e-300)
    step = 1 / max(np.linalg.norm(gather(spread(v))), 1e-12)
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * gather(spread(y) - target))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def pack_histogram(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, how many such sequences), covering the histogram exactly. Its cost
    depends on the number of lengths, not on the number of pieces."""
    limit = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    packed: Counter = Counter()
    patterns = enumerate_patterns(left)
    if len(patterns):
        fitted = fit_counts(patterns, left)
        for k in np.argsort(-fitted, kind="stable"):
            need = Counter(int(a) for a in patterns[k] if a)
            n = min(int(fitted[k]), *(int(left[a]) // m for a, m in need.items()))
            # a pattern of one length that leaves much room is better left to the residual
            if n > 0 and sum(a * m for a, m in need.items()) >= 0.98 * limit:
                packed[tuple(sorted(need.elements(), reverse=True))] += n
                for a, m in need.items():
                    left[a] -= n * m
    room: dict[int, Counter] = {}
    for a in range(limit, 0, -1):
        n = int(left[a])
        while n:
            space = min((r for r in room if r >= a), default=None) if a <= limit // 2 or room else None
            if space is None:
                each = limit // a
                full, rest = divmod(n, each)
                for m, times in ((each, full), (rest, 1)):
                    if m and times:
                        room.setdefault(limit - m * a, Counter())[(a,) * m] += times
                break
            held = room[space]
            lengths, times = next(iter(held.items()))
            each = min(space // a, max(1, n // times), n)
            take = min(times, n // each)
            held[lengths] -= take
            if not held[lengths]:
                del held[lengths]
            if not held:
                del room[space]
            if space - each * a >= 0:
                room.setdefault(space - each * a, Counter())[lengths + (a,) * each] += take
            n -= take * each
    for held in room.values():
        packed.update(held)
    return list(packed.items())


def slots(packed: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """The plan: pieces of ``length`` numbered from ``first`` on, ``count`` of them, go to the
    sequences from ``sequence`` on, at ``offset``."""
    rows, used, sequence = [], Counter(), 0
    for lengths, times in packed:
        offset = 0
        for a in lengths:
            rows.append((a, used[a], times, sequence, offset))
            used[a] += times
            offset += a
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "count", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)


def pack(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32)."""
    spark = pieces.sparkSession
    pieces = lasting(pieces.withColumn("_salt", F.rand(42)))
    counts = pieces.groupBy("length").count().collect()  # at most ``limit`` rows
    histogram = np.zeros(limit + 1, np.int64)
    for r in counts:
        histogram[r["length"]] = r["count"]
    plan = slots(pack_histogram(histogram))
    groups = max(1, int(histogram.sum()) // GROUP_ROWS)
    grouped = pieces.withColumn("_g", F.floor(F.col("_salt") * groups).cast("int"))
    before = grouped.groupBy("length", "_g").agg(F.count("*").alias("_n"))
    before = before.select("length", "_g", (F.sum("_n").over(Window.partitionBy("length").orderBy("_g")) - F.col("_n")).alias("_before"))
    within = Window.partitionBy("length", "_g").orderBy("_salt", "doc_id", "piece", "ids_crc32")
    numbered = grouped.withColumn("_k", F.row_number().over(within) - 1).join(before, ["length", "_g"]).withColumn("_k", F.col("_k") + F.col("_before"))

    # Bounded by the number of lengths, whatever the number of pieces.
    shared = spark.sparkContext.broadcast({int(a): tuple(d[c].to_numpy(np.int64) for c in ("first", "sequence", "offset")) for a, d in plan.groupby("length")})

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        a, k = lengths.to_numpy(), numbers.to_numpy()
        for length in np.unique(a).tolist():
            which = np.flatnonzero(a == length)
            first, sequences, offsets = shared.value[length]
            at = np.searchsorted(first, k[which], side="right") - 1
            sequence[which], offset[which] = sequences[at] + k[which] - first[at], offsets[at]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return numbered.withColumn("_at", place("length", "_k")).select("doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    return pack(token_pieces(docs.select("doc_id", "text"), tokenizer, limit), limit)
