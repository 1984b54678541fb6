"""SimHash near-duplicates (operator 3) over tables of distances to reference fingerprints.

A fingerprint has a bit set if it is set in over half of the XXH64 hashes (seed 42) of the text's
3-word shingles, A-Z in lower case. Equal fingerprints are joined first, so copies cost one row.
For every distinct fingerprint the distances to many fixed references are precomputed: a common
origin, for each of five parts of the 64 bits references that differ from the origin in that part
only, and some that differ anywhere. Two facts use the table:

* Fingerprints at 2 bits or fewer agree in three whole parts at least, so there their distances to
  the parts' references, taken relative to the origin's, are equal: candidates are found by equality
  of those coordinates, one key for each three of the parts, without losing a link.
* Distances to any reference differ by 2 at most: candidates whose largest coordinate difference is
  over 2 are discarded, and the survivors are verified bit by bit.

A key shared by more than ``BLOCK`` distinct fingerprints is split by the distances to further
references, one after the other: cells of 3 distances, each fingerprint in its own cell and, where
it is near, in the next one, so that two within 2 always meet. What is still crowded after
``SPLITS`` of them lies close together; it is compared in pairs of tiles of bounded size. Of each
block only the links of every fingerprint to the least of its component there are returned, so what
comes out is linear in what went in.

A null text counts as empty: it has no words, and fingerprint zero, which is linked like any other.
A null doc_id keeps its row; it never is a component's id. Repeated rows each keep theirs. Tables
without rows give none; columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.components import components
from tidewatt.llm.lasting import lasting, written

#: Bits by which linked fingerprints may differ. The parts rest on it: two bits leave three of five parts alone.
DISTANCE = 2
PARTS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
KEYS = tuple(itertools.combinations(range(len(PARTS)), len(PARTS) - DISTANCE))
#: References of each part, and over all bits.
PART_REFERENCES = 16
WIDE_REFERENCES = 16
#: Distinct fingerprints that are compared in one block, coordinates that split a crowded key, and
#: fingerprints in a tile of what they leave crowded.
BLOCK = 256
SPLITS = 3
TILE = 256

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    words = [w.encode("utf-8", "surrogatepass") for w in words]
    hash_ = xxhash.xxh64_intdigest
    if len(words) < 3:
        hashes = [hash_(b" ".join(words), 42)]
    else:
        hashes = [hash_(b"%b %b %b" % s, 42) for s in zip(words, words[1:], words[2:])]
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[i : i + (1 << 16)], "<u8")
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (total * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", carried: list[str] | None = None) -> DataFrame:
    """docs' doc_id, or the columns carried, with fp, the fingerprint as a signed long; no shuffle."""

    @F.pandas_udf("long")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return docs.select(*(["doc_id"] if carried is None else carried), made(F.col(text)).alias("fp"))


def references() -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The origin, each part's references and the wide ones, from a fixed seed."""
    rng = np.random.default_rng(42)
    random = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    origin = random(1)[0]
    parts = [origin ^ (random(PART_REFERENCES) & np.uint64(((1 << (high - low)) - 1) << low)) for low, high in PARTS]
    return origin, parts, random(WIDE_REFERENCES)


def pivot_table(distinct: DataFrame) -> DataFrame:
    """fp, pivots (distances to the wide references, a byte each), part (a number of KEYS) and key
    (a hash of the relative coordinates of its parts), a row for each of KEYS."""
    origin, parts, wide = references()
    factors = np.random.default_rng(7).integers(0, 1 << 63, (len(PARTS), PART_REFERENCES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @F.pandas_udf("keys array<long>, pivots binary")
    def measured(fps: pd.Series) -> pd.DataFrame:
        x = fps.to_numpy(np.int64).view(np.uint64)[:, None]
        base = np.bitwise_count(x ^ origin).astype(np.int64)
        hashes = []
        for references_, f in zip(parts, factors):
            relative = (np.bitwise_count(x ^ references_[None, :]).astype(np.int64) - base).view(np.uint64)
            h = (relative * f[None, :]).sum(axis=1, dtype=np.uint64)
            hashes.append((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15))
        keys = np.stack([np.bitwise_xor.reduce([hashes[p] * np.uint64(2 * k + 3) for k, p in enumerate(three)]) for three in KEYS], axis=1).view(np.int64)
        return pd.DataFrame({"keys": list(keys), "pivots": [d.tobytes() for d in np.bitwise_count(x ^ wide[None, :]).astype(np.uint8)]})

    return distinct.select("fp", measured("fp").alias("_m")).select("fp", "_m.pivots", F.posexplode("_m.keys").alias("part", "key"))


def block_links(fps: np.ndarray, pivots: np.ndarray) -> list[tuple[int, int]]:
    """(fingerprint, least of its component) in a block, for all but the least themselves. Pairs
    are discarded by their largest coordinate difference, the others verified bit by bit."""
    n = len(fps)
    near = np.zeros((n, n), bool)
    for i in range(0, n, 64):
        far = pivots[i : i + 64, None, 0] - pivots[None, :, 0]
        row, at = np.nonzero(np.abs(far) <= DISTANCE)
        close = np.abs(pivots[row + i] - pivots[at]).max(axis=1) <= DISTANCE
        row, at = row[close] + i, at[close]
        sure = np.bitwise_count((fps[row] ^ fps[at]).view(np.uint64)) <= DISTANCE
        near[row[sure], at[sure]] = True
    # The least label spreads along links until it stays.
    label = np.argsort(np.argsort(fps, kind="stable"), kind="stable")
    while True:
        least = np.where(near, label[None, :], n).min(axis=1)
        if (least == label).all():
            break
        label = least
    least = np.sort(fps)[label]
    return [(a, b) for a, b in zip(fps.tolist(), least.tolist()) if a != b]


def _linked(groups: DataFrame, *keys: str) -> DataFrame:
    """(a, b): links within each group of fp and pivots; groups are of bounded size."""

    @F.pandas_udf("array<struct<a long, b long>>")
    def verified(blocks: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for fps, pivots in blocks:
            out = []
            for own, far in zip(fps, pivots):
                own = np.asarray(own, np.int64)
                found = block_links(own, np.frombuffer(b"".join(far), np.uint8).reshape(len(own), -1).astype(np.int16))
                out.append([{"a": a, "b": b} for a, b in found])
            yield pd.Series(out, dtype=object)

    blocks = groups.groupBy(*keys).agg(F.collect_list(F.struct("fp", "pivots")).alias("_block"))
    return blocks.select(F.explode(verified(F.col("_block.fp"), F.col("_block.pivots"))).alias("_e")).select("_e.a", "_e.b")


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints whose components are those of all pairs at 2
    bits or fewer."""
    def sized(cells: DataFrame) -> DataFrame:
        shared = cells.groupBy("g").agg(F.count("*").alias("_n")).where("_n > 1")
        return cells.join(shared, "g")

    groups = written(sized(pivot_table(distinct).select(F.xxhash64("part", "key").alias("g"), "fp", "pivots")))
    out = _linked(groups.where(F.col("_n") <= BLOCK), "g")
    for k in range(SPLITS):
        crowded = groups.where(F.col("_n") > BLOCK)
        if crowded.isEmpty():
            return out
        d = F.conv(F.hex(F.substring("pivots", k + 1, 1)), 16, 10).cast("int")
        cell = F.explode(F.array_distinct(F.array(F.floor(d / 3), F.floor((d + DISTANCE) / 3))))
        cells = crowded.select("g", cell.alias("_cell"), "fp", "pivots").select(F.xxhash64("g", "_cell").alias("g"), "fp", "pivots")
        groups = written(sized(cells))
        out = out.unionByName(_linked(groups.where(F.col("_n") <= BLOCK), "g"))
    crowded = groups.where(F.col("_n") > BLOCK)
    tiles = F.ceil(F.col("_n") / TILE).cast("int")
    own = F.pmod(F.xxhash64(F.lit("tile"), "fp"), F.col("_tiles")).cast("int")
    placed = crowded.withColumn("_tiles", tiles).withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    placed = placed.select("g", F.least("_own", "_other").alias("_a"), F.greatest("_own", "_other").alias("_b"), "fp", "pivots")
    return out.unionByName(_linked(placed, "g", "_a", "_b"))


def _roots(distinct: DataFrame) -> DataFrame:
    """fp, root of the fingerprints that have links."""
    return components(links(distinct.select("fp")), "a", "b").withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fp, component_id for every row: the least doc_id that links reach, itself included."""
    marked = lasting(fingerprints(docs, text))
    distinct = lasting(marked.groupBy("fp").agg(F.min("doc_id").alias("_least")))
    found = _roots(distinct)
    linked = distinct.join(found, "fp")
    roots = linked.groupBy("root").agg(F.min("_least").alias("_reached"))
    label = linked.join(roots, "root").select("fp", "_reached")
    # Written, so that the last join has a plain exchange on either side and a crowded fingerprint can be split.
    labels = lasting(distinct.join(label, "fp", "left").select("fp", F.coalesce("_reached", "_least").alias("component_id")))
    return marked.join(labels, "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def kept(docs: DataFrame) -> DataFrame:
    """docs with one row for each component: of its rows that of the least doc_id, rows without one
    last; of rows that share it, the one whose text has the least hash, and of those with the same
    text the least by the other columns as text."""
    identity = [F.col("doc_id").isNull().alias("_sd_null"), F.col("doc_id").alias("_sd_id"), F.xxhash64("text").alias("_sd_h1"), F.xxhash64(F.lit("again"), "text").alias("_sd_h2")]
    names = ["_sd_null", "_sd_id", "_sd_h1", "_sd_h2"]
    marked = lasting(fingerprints(docs.select("doc_id", "text", *identity), "text", names))
    found = _roots(lasting(marked.select("fp").distinct()))
    rooted = marked.join(found, "fp", "left").select(F.coalesce("root", "fp").alias("root"), *names)
    stay = rooted.groupBy("root").agg(F.min(F.struct(*names)).alias("_sd_m")).select("_sd_m.*")
    stay = lasting(stay.withColumn("_sd_id", F.coalesce("_sd_id", F.lit(0).cast(docs.schema["doc_id"].dataType))))
    keyed = docs.select(*docs.columns, *identity).withColumn("_sd_id", F.coalesce("_sd_id", F.lit(0).cast(docs.schema["doc_id"].dataType)))
    rows = keyed.join(stay, names, "left_semi")
    repeats = marked.groupBy(*names).count().where("count > 1").limit(1)
    if not repeats.isEmpty():
        order = [F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0)]
        rows = rows.withColumn("_sd_r", F.row_number().over(Window.partitionBy(*names).orderBy(*order))).where("_sd_r = 1")
    return rows.select(*docs.columns)
