"""Vector code compression by Lloyd's rounds over cover trees (operator 12).

Components become integers, floor(4096 x), and vectors are cut into equal parts, each with a
codebook of its own. Every partition of the table is turned once into blocks of bounded size; of each
part of a block a cover tree is built: a node's points lie within its radius of its centre, the
centres of its children are more than half of that apart, and the sums of all points of a node are
two entries of one array of cumulative sums. In a round, a node whose centre is nearer to one entry
than to any other by over twice the radius goes to it whole, by the triangle inequality, its sum and
count with it; only the others descend, at last to exact comparisons of integers. So nothing is
estimated: codes, errors and codebooks are those of plain rounds over all vectors.

The blocks are written to the shared folder; a round reads them, and each task returns one sum for
each entry. Only these, aggregated, and the codebooks reach the driver: their size is parts times
entries times components, whatever the rows.

Vectors that are null or hold null or non-finite components are dropped. Vectors of another length
than the commonest one (of equally common ones the longest) that the parts divide, and those with a
component of 32,768 or more either way, whose error would leave the range of a long, teach nothing
and have null code and error; other rows of their label are not affected. The first entries are of
the least ids, of rows that share an id the lesser vectors first, null ids last; with fewer rows than
entries there are as many entries as rows. Equal entries tie and the first one takes all. Rows that
repeat each keep theirs. A table without rows gives none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.lasting import written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors in a block, distinct points in a leaf, and the range of components.
BLOCK = 4096
LEAF = 12
LIMIT = 32768


class Tree:
    """A cover tree over the rows of integers x, its nodes in breadth-first order."""

    def __init__(self, points: np.ndarray, at: np.ndarray, count: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        #: Distinct points in tree order, the point of each row, repeats before each point.
        self.points, self.at, self.count = points, at, count
        #: Of each node: centre, first and end point, first and end child.
        self.nodes, self.radius = nodes, radius
        weights = np.diff(count)[:, None]
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), (points * weights).cumsum(axis=0)])

    @classmethod
    def of(cls, x: np.ndarray) -> Tree:
        distinct, at, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
        place = distinct.astype(np.float64)
        order = np.arange(len(distinct))
        nodes, radius, i = [[0, 0, len(distinct), 0, 0]], [], 0
        members = [order]
        while i < len(nodes):
            own, centre = members[i], nodes[i][0]
            members[i] = None
            apart = np.sqrt(((place[own] - place[centre]) ** 2).sum(axis=1))
            radius.append(float(apart.max()))
            nodes[i][3] = nodes[i][4] = len(nodes)
            start = nodes[i][1]
            if len(own) <= LEAF:
                order[start : start + len(own)] = own
                i += 1
                continue
            half = radius[-1] / 2
            while len(own):
                near = apart <= half
                child = own[near]
                nodes.append([centre, start, start + len(child), 0, 0])
                members.append(child)
                start += len(child)
                own, apart = own[~near], apart[~near]
                if len(own):
                    centre = own[0]
                    apart = np.sqrt(((place[own] - place[centre]) ** 2).sum(axis=1))
            nodes[i][4] = len(nodes)
            i += 1
        nodes = np.array(nodes, np.int64)
        placed = np.empty_like(order)
        placed[order] = np.arange(len(order))
        nodes[:, 0] = placed[nodes[:, 0]]
        return cls(distinct[order], placed[at.reshape(-1)], np.concatenate([[0], n[order].cumsum()]), nodes, np.array(radius))

    def assign(self, entries: np.ndarray) -> np.ndarray:
        """The nearest entry of each distinct point, the first of equally near ones."""
        out = np.empty(len(self.points), np.int64)
        first = np.sort(np.unique(entries, axis=0, return_index=True)[1])
        entries = entries[first]

        def distances(points: np.ndarray) -> np.ndarray:
            return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)

        front = np.zeros(1, np.int64)
        while len(front):
            centre, start, end, child, last = self.nodes[front].T
            far = np.sqrt(distances(self.points[centre]).astype(np.float64))
            best = far.argmin(axis=1)
            least = far[np.arange(len(far)), best]
            far[np.arange(len(far)), best] = np.inf
            sure = far.min(axis=1) - least > 2 * self.radius[front] * (1 + 1e-9) + 1e-6
            whole = _ranges(start[sure], end[sure])
            out[whole] = np.repeat(first[best[sure]], (end - start)[sure])
            leaf = ~sure & (child == last)
            exact = _ranges(start[leaf], end[leaf])
            out[exact] = first[distances(self.points[exact]).argmin(axis=1)] if len(exact) else 0
            inner = ~sure & ~leaf
            front = _ranges(child[inner], last[inner])
        return out

    def gathered(self, codes: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """(counts, sums) of the rows of each code, from the cumulative sums where codes change."""
        edges = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)]])
        n, total = np.zeros(entries, np.int64), np.zeros((entries, self.points.shape[1]), np.int64)
        np.add.at(n, codes[edges[:-1]], np.diff(self.count[edges]))
        np.add.at(total, codes[edges[:-1]], np.diff(self.sums[edges], axis=0))
        return n, total


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    size = end - start
    return np.repeat(start - np.concatenate([[0], size.cumsum()[:-1]]), size) + np.arange(size.sum()) if len(size) else np.zeros(0, np.int64)


def _packed(trees: list[Tree]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{name}{i}": getattr(t, name) for i, t in enumerate(trees) for name in ("points", "at", "count", "nodes", "radius")})
    return out.getvalue()


def _unpacked(raw: bytes, parts: int) -> list[Tree]:
    held = np.load(io.BytesIO(raw))
    return [Tree(*(held[f"{name}{i}"] for name in ("points", "at", "count", "nodes", "radius"))) for i in range(parts)]


def _blocks(rows: DataFrame, d: int, parts: int) -> DataFrame:
    """ids, labels and the trees of each block; no shuffle."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                own = batch.slice(i, BLOCK)
                x = np.floor(own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d) * SCALE).astype(np.int64)
                trees = [Tree.of(x[:, j : j + d // parts]) for j in range(0, d, d // parts)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), own.column(c)) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([_packed(trees)], pa.binary())], names=["ids", "labels", "trees"])

    kind = lambda c: rows.schema[c].dataType.simpleString()
    return rows.mapInArrow(built, f"ids array<{kind('id')}>, labels array<{kind('label')}>, trees binary")


def _round(blocks: DataFrame, books: np.ndarray) -> list:
    """part, entry, n and the sums of components of all entries that are used."""
    parts, entries, size = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), object), np.zeros((parts, entries, size), object)
        for batch in batches:
            for raw in batch.column(0):
                for p, tree in enumerate(_unpacked(raw.as_py(), parts)):
                    more = tree.gathered(tree.assign(books[p]), entries)
                    n[p] += more[0]
                    total[p] += more[1]
        used = [(p, e) for p in range(parts) for e in range(entries) if n[p, e]]
        columns = [[p for p, _ in used], [e for _, e in used], [int(n[u]) for u in used], [[str(s) for s in total[u]] for u in used]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "entry", "n", "s"])

    found = blocks.select("trees").mapInArrow(summed, "part int, entry int, n long, s array<string>")
    sums = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()


def _coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """id, label, code and error of every vector."""
    parts = len(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in enumerate(batch.column(2)):
                codes, error = [], 0
                for p, tree in enumerate(_unpacked(raw.as_py(), parts)):
                    code = tree.assign(books[p])
                    error = error + ((tree.points - books[p][code]) ** 2).sum(axis=1)[tree.at]
                    codes.append(code[tree.at])
                text = ["".join("%02x" % c for c in row) for row in np.stack(codes, axis=1).tolist()]
                own = [batch.column(j).slice(i, 1).flatten() for j in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(text), pa.array(error, pa.int64())], names=["id", "label", "code", "error"])

    kind = lambda c: blocks.schema[c].dataType.elementType.simpleString()
    return blocks.mapInArrow(coded, f"id {kind('ids')}, label {kind('labels')}, code string, error long")


def _finite(v: str) -> Column:
    return F.col(v).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that is not dropped."""
    if parts < 1 or not 1 <= entries <= 256:
        raise ValueError("compress: one part at least, and 1 to 256 entries")
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v")).where(_finite("v"))
    length = F.size("v")
    common = rows.where((length > 0) & (length % parts == 0)).groupBy(length.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else parts
    fits = (length == d) & F.forall("v", lambda x: F.abs(x) < LIMIT)
    blocks = written(_blocks(rows.where(fits), d, parts))
    first = rows.where(fits).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    start = np.floor(np.array([r["v"] for r in first], np.float64).reshape(-1, d) * SCALE).astype(np.int64)
    books = np.stack(np.split(start, parts, axis=1))
    for _ in range(rounds if len(first) else 0):
        books = books.copy()
        for r in _round(blocks, books):
            books[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(d // parts)]
    coded = _coded(blocks, books).unionByName(rows.where(~fits).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")))
    coded = written(coded)
    # Written, so that the rows of a label that has very many can be split in the join.
    totals = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_l"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("_l")), "left")
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The query over ``embeddings`` as DuckDB SQL, by plain rounds over all vectors."""
    far = "cast(list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint)"
    tables = []
    for k in range(rounds + 1):
        tables.append(f"a{k} as (select r, part, any_value(x) x, arg_min(entry, d * {entries} + entry) entry, min(d) d from (select p.r, p.part, p.x, b.entry, {far} d from p join b{k} b on b.part = p.part) group by r, part)")
        if k < rounds:
            tables.append(f"s{k} as (select part, entry, i, cast(sum(x[i]) as bigint) s, count(*) n from a{k}, (select unnest(range(1, len(any_value(x)) + 1)) i from p) group by part, entry, i)")
            tables.append(f"b{k + 1} as (select b.part, b.entry, coalesce(m.c, b.c) c from b{k} b left join (select part, entry, list((s - ((s % n) + n) % n) // n order by i) c from s{k} group by part, entry) m on m.part = b.part and m.entry = b.entry)")
    return f"""with e as (select row_number() over (order by vec_id, v) - 1 r, * from (select vec_id, label, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)),
 p as (select r, cast(k.range as int) part, v[k.range * (len(v) // {parts}) + 1 : (k.range + 1) * (len(v) // {parts})] x from e cross join range({parts}) k),
 b0 as (select part, r entry, x c from p where r < {entries}), {", ".join(tables)},
 o as (select r, string_agg(printf('%02x', entry), '' order by part) code, cast(sum(d) as bigint) error from a{rounds} group by r),
 h as (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, i)) digest from (select part, entry, unnest(c) x, unnest(range(len(c))) i from b{rounds}))
 select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, digest codebooks_sha256 from e join o on o.r = e.r cross join h"""
