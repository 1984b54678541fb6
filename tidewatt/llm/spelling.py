"""Spelling variants by asymmetric q-chunks (operator 13).

The words of all texts are counted. To find the words at one edit from each other, a word
contributes disjoint chunks, its halves, and a word that is as long or longer by one contributes its
positional grams: those of the lengths of such chunks at the places where the shift of the lengths,
none or one, allows them. One edit leaves one of two chunks as it is, so two near words meet there. What
is left of the word, the half with the edit, is cut into two chunks again, one of which is
preserved, and so on: after ``DEPTH`` cuts two words meet in what lies before and what lies behind a
quarter of the shorter one. A key that many words share is cut further, until the part with the edit is one
letter, so no group is compared in all pairs. All candidates are verified by their edit distance.

Each word points to its form, the commonest near word if that is commoner by ``RATIO``, and to its
root at the end of the forms, found by doubling pointers; counts grow along forms, so there is no
ring.

Null and empty texts have no words; a null doc_id is written as the empty text where a run is
hashed. Texts may be of any length. Of near words that are equally common the form is the first in the
order of code points. Rows that repeat count each time. A table without rows gives none. Other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.lasting import forget, written

#: Code points and occurrences of a word, and how much commoner a form is.
SHORTEST = 6
FEWEST = 5
RATIO = 5
#: Runs that lose a code point: one of so many.
EDITED = 199
#: Cuts of a word, and pairs under one key beyond which it is cut again.
DEPTH = 2
PAIRS = 1024
#: Words that a task counts before it hands on what it has.
HELD = 500_000

_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(doc_id: str, text: str, shortest: int = SHORTEST) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of a text, repeats possible; runs that are too short are left out."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(re.findall(r"[A-Za-zÀ-ÿ]{%d,}" % shortest, text)).items():
        word = run.lower() if run.isascii() else run.translate(_LOWER)
        h = zlib.crc32(word.encode(), seed)
        if h % EDITED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < shortest:
                continue
        yield word, n


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """word, n of all texts; counted in each task before the shuffle."""

    def batch_of(n: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                for word, k in words_of(i.as_py(), t.as_py(), shortest):
                    n[word] += k
                if len(n) > HELD:
                    yield batch_of(n)
                    n.clear()
        yield batch_of(n)

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).where(F.length("t") >= shortest)
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def _keyed(rows: DataFrame) -> DataFrame:
    """rows: word, n, long (of the word with the chunks), shift, depth, i -> with g, the key: all
    but the i-th part of long letters in 2^depth parts, shifted behind it."""
    cut = lambda i: F.floor(i * F.col("long") / F.pow(F.lit(2.0), F.col("depth"))).cast("int")
    start, end = cut(F.col("i")), cut(F.col("i") + 1)
    behind = F.substring(F.col("word"), end + F.col("shift") + 1, F.length("word"))
    return rows.withColumn("left", end - start).withColumn("g", F.xxhash64("long", "depth", "i", F.substring(F.col("word"), F.lit(1), start), behind))


def _within_one(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): words at one inserted, deleted or replaced code point, each pair once."""
    size = F.length("word")
    grams = F.array(F.struct(size.alias("long"), F.lit(0).alias("shift")), F.struct((size - 1).alias("long"), F.lit(1).alias("shift")))
    side = lambda chunk, kinds: words.select("word", "n", F.lit(chunk).alias("chunk"), F.explode(kinds).alias("_k")).select("word", "n", "chunk", "_k.*")
    rows = side(True, F.array(F.struct(size.alias("long"), F.lit(0).alias("shift")))).unionByName(side(False, grams))
    rows = _keyed(rows.withColumn("depth", F.lit(DEPTH)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2**DEPTH - 1)))))
    found, old = [], []
    while True:
        met = rows.groupBy("g").agg(F.count_if("chunk").alias("nc"), F.count_if(~F.col("chunk")).alias("ng")).where("nc > 0 and ng > 0")
        level = written(rows.join(met.select("g", (F.col("nc") * F.col("ng") > PAIRS).alias("many")), "g"))
        old.append(level)
        split = F.col("many") & (F.col("left") > 1)
        ready = level.where(~split)
        own = ready.where("chunk").select("g", F.col("word").alias("a"), F.col("n").alias("a_n"))
        other = ready.where(~F.col("chunk")).select("g", "shift", F.col("word").alias("b"), F.col("n").alias("b_n"))
        pairs = own.join(other, "g").where("shift = 1 or a < b").where(_within_one("a", "b"))
        found.append(written(pairs.select("a", "a_n", "b", "b_n").distinct()))
        crowded = level.where(split)
        if crowded.isEmpty():
            break
        parts = crowded.select("word", "n", "chunk", "long", "shift", (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("i") * 2, F.col("i") * 2 + 1)).alias("i"))
        rows = _keyed(parts.distinct())
    for table in old:
        forget(table)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct() if len(found) > 1 else out


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form), by doubling pointers."""
    at = written(forms.select("word", F.col("form").alias("root")))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = written(at.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        forget(at)
        if further.where("moved").isEmpty():
            return further.select("word", "root")
        at = further.drop("moved")
        at.written_at = further.written_at


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = written(vocabulary(docs, doc_id, text))
    pairs = near_words(words)
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("w")).alias("_o")).unionByName(pairs.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("m"), F.col("a").alias("w")).alias("_o")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("_o").alias("_o")).select("word", "n_near", (-F.col("_o.m")).alias("form_n"), F.col("_o.w").alias("form"))
    out = words.join(near, "word", "left").withColumn("_far", F.col("form_n") >= RATIO * F.col("n"))
    out = written(out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("_far"), F.col("form")).alias("form"), F.when(F.col("_far"), F.col("form_n")).alias("form_n")))
    roots = _roots(out.where("form is not null"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
