"""Document fingerprints by spot signatures (operator 6), with DataFrame functions only.

The words of a text in lower case are read once. A common word, from a fixed list or of up to
``SHORT`` letters, is an anchor; of a run of anchors the last one counts. The two content words
that follow it, anchors between them left out, are its chain, and anchor and chain are a signature.
A text without any chain has one signature, the hash of all its words; a text without a word has
none. The fingerprint is the sorted set of the signatures' 32-bit hashes, 8 hexadecimal digits each.

Fingerprints are compared by the Jaccard likeness of their sets; two empty ones are alike. For the
search of near duplicates, sets are partitioned by length so that two sets whose lengths alone
forbid the likeness never meet, and candidates must share one of a set's rarest signatures, as many
as the likeness leaves without one in common. Every link is exact.

Nulls count as empty texts. Rows are ordered by doc_id, nulls first, and rows that share an id by a
hash of the text; the next document of a row is the next one in that order with another id or
text, and the last one's is the first. Rows that repeat id and text get equal results. A single row
follows itself. Tables without rows give none; columns other than doc_id and text are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.lasting import lasting

#: Frequent function words of English, French, German and Spanish.
COMMON = tuple(
    "the and that this with from for are was were been have has had not but you all can will they their there which when what who how "
    "les des une dans est que qui pour par sur pas plus avec sont mais nous vous elle ils "
    "der die das und ist von mit den dem des ein eine einen einer für auf nicht auch sich als war sind wird "
    "los las una del que con por para como más pero sus fue son está".split()
)
SHORT = 2
MARK = "§"


def words(text: Column) -> Column:
    """Words in lower case, anchors marked; of a run of anchors the last only."""
    every = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    anchor = lambda w: (F.length(w) <= SHORT) | w.isin(*COMMON)
    marked = F.transform(every, lambda w: F.when(anchor(w), F.concat(F.lit(MARK), w)).otherwise(w))
    return marked


def signatures(text: Column) -> Column:
    """The sorted set of 32-bit signatures, as longs, of a text without nulls."""
    is_anchor = lambda w: F.startswith(w, F.lit(MARK))

    def chains(w: Column) -> Column:
        # No anchor is followed by another: behind an anchor is content, behind content at most one anchor.
        follows = lambda i, k: F.get(w, i + k)
        second = lambda i: F.when(is_anchor(follows(i, 2)), follows(i, 3)).otherwise(follows(i, 2))
        hashed = F.transform(w, lambda x, i: F.when(is_anchor(x) & second(i).isNotNull(), F.xxhash64(x, follows(i, 1), second(i))))
        return F.filter(hashed, lambda h: h.isNotNull())

    def of(marked: Column) -> Column:
        single = F.filter(marked, lambda x, i: ~(is_anchor(x) & F.coalesce(is_anchor(F.get(marked, i + 1)), F.lit(False))))
        return _let(single, lambda w: _let(chains(w), lambda c: F.when(F.size(c) > 0, c).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<long>"))))

    low = F.lit(0xFFFFFFFF)
    return F.array_sort(F.array_distinct(F.transform(_let(words(text), of), lambda h: h.bitwiseAND(low))))


def compact(signature: Column) -> Column:
    """The same 32 bits as integers."""
    return F.transform(signature, lambda h: F.shiftright(F.shiftleft(h, 32), 32).cast("int"))


def _let(value: Column, body) -> Column:
    """body(value), evaluating value once for each row."""
    return F.transform(F.array(value), body)[0]


def written(signature: Column) -> Column:
    """A set of compact signatures as a string."""
    return F.array_join(F.transform(signature, lambda h: F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets."""
    def by(common: Column) -> Column:
        return common / (F.size(a) + F.size(b) - common)

    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(_let(F.size(F.array_intersect(a, b)).cast("double"), by))


def placed(keyed: DataFrame) -> DataFrame:
    """Distinct doc_id, _h, _g and _half with _b, a bucket of the order; Spark samples its bounds, and the
    hashes split rows that share an id."""
    keys = keyed.select("doc_id", "_h", "_g", "_half").distinct()
    return lasting(keys.repartitionByRange("doc_id", "_h", "_g").withColumn("_b", F.spark_partition_id()))


def next_keys(keyed: DataFrame) -> DataFrame:
    """_h, _g of the next document of that with _ph, _pg and _half."""
    keys = placed(keyed)
    order = Window.partitionBy("_b").orderBy("doc_id", "_h", "_g")
    seen = keys.withColumn("_next", F.lead(F.struct("_h", "_g")).over(order))
    # One row for each bucket, of which there are as many as shuffle partitions.
    firsts = keys.groupBy("_b").agg(F.min(F.struct("doc_id", "_h", "_g")).alias("_f")).select("_b", F.struct("_f._h", "_f._g").alias("_f"))
    chain = Window.orderBy("_b")
    after = firsts.select("_b", F.coalesce(F.lead("_f").over(chain), F.first("_f").over(chain)).alias("_over"))
    over = seen.join(after, "_b").withColumn("_next", F.coalesce("_next", "_over"))
    return over.select(F.col("_next._h").alias("_h"), F.col("_next._g").alias("_g"), F.col("_h").alias("_ph"), F.col("_g").alias("_pg"), "_half")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, the
    sets' length, n_signatures, and next_id. Signatures are made once, before one shuffle that both
    roles of a document, as itself and as the next one, read; of the next one's text only what the
    edited text takes moves on."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    keyed = rows.select("*", F.xxhash64("doc_id", "text").alias("_h"), F.xxhash64(F.lit(1), "doc_id", "text").alias("_g"), half.alias("_half"))
    follow = next_keys(keyed)
    signed = keyed.withColumn("sig", compact(signatures(F.col("text"))))
    # The same columns on both sides, so that Spark reuses the exchange.
    own = signed.select("_h", "_g", "doc_id", "text", "sig")
    following = own if follow.count() == keyed.count() else own.dropDuplicates(["_h", "_g"])
    nexts = following.join(follow, ["_h", "_g"]).select(F.col("_ph").alias("_h"), F.col("_pg").alias("_g"), F.col("doc_id").alias("next_id"), F.substring(F.col("text"), F.lit(1), F.col("_half")).alias("next_text"), F.col("sig").alias("next_sig"))
    both = own.join(nexts, ["_h", "_g"])
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.col("next_text"))
    both = both.withColumn("edited", edited).withColumn("edited_sig", compact(signatures(F.col("edited"))))
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("sig")).alias("fingerprint"), written(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
        F.size("sig").alias("n_signatures"), "next_id",
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, likeness): pairs of distinct sets, named by their least doc_id, at the threshold or
    above. Equal sets are one; their membership is that of the fingerprint."""
    sets = docs.select("doc_id", signatures(F.coalesce("text", F.lit(""))).alias("sig")).where("size(sig) > 0")
    sets = lasting(sets.groupBy("sig").agg(F.min("doc_id").alias("id")).where("id is not null"))
    n = F.size("sig")
    # Of two sets this alike, the ratio of lengths is at least the threshold: they lie in one
    # partition of lengths or in neighbouring ones.
    partition = F.floor(F.log(n.cast("double")) / -float(_log(threshold))).cast("int") if threshold < 1 else n
    uses = sets.select(F.explode("sig").alias("s")).groupBy("s").agg(F.count("*").alias("uses"))
    listed = sets.select("id", "sig", n.alias("n"), partition.alias("p"))
    ranked = listed.select("id", "n", "p", F.explode("sig").alias("s")).join(uses, "s")
    ranked = ranked.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("uses", "s")))
    prefix = ranked.where(F.col("k") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).where("uses > 1")
    left = prefix.select("s", "p", F.col("id").alias("a"), F.col("n").alias("na"))
    right = prefix.select("s", F.explode(F.array(F.col("p"), F.col("p") - 1)).alias("p"), F.col("id").alias("b"), F.col("n").alias("nb"), F.col("p").alias("pb"))
    fits = (F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9) & ((F.col("p") != F.col("pb")) | (F.col("a") < F.col("b")))
    pairs = left.join(right, ["s", "p"]).where(fits).select("a", "b").distinct()
    one, other = listed.select(F.col("id").alias("a"), F.col("sig").alias("sa")), listed.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    scored = pairs.join(one, "a").join(other, "b").withColumn("likeness", likeness(F.col("sa"), F.col("sb"))).where(F.col("likeness") >= threshold)
    return scored.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")


def _log(x: float) -> float:
    import math

    return math.log(x)
