"""URL filters: allow and block rules, and boosted trees on lexical features (operator 5).

Rules name a host suffix and a path prefix; the longest one that fits decides. URLs without a rule
are judged by gradient-boosted trees (Spark ML) on features of the URL as text: lengths, depth,
digit ratio, entropy of the host's characters, counts of parameters, hyphens and dots, and
statistics of the host's last two and three labels and of the path's beginning, to the end of its
first segment and one sign into the second: the smoothed share of blocked URLs among the labelled
ones with that suffix or prefix. The statistics are of one half of the labelled URLs, by a hash, and
the trees learn from the other, so that no URL's own label is in its features.

Labelled URLs are an argument. Where no table of them is at hand, :func:`rule_labels` takes those
that the rules decide, so that the trees carry the rules over to URLs without one. At most about
``SAMPLE`` labelled URLs are learned from, chosen by a hash, so the statistics are bounded by it and
broadcast.

A null URL, or one without ``://``, has an empty host and path, no rule, and is judged by the trees
like any other. Where only one label occurs, that label is the verdict. Repeated rows are judged
alike; columns are only added.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.lasting import lasting

ALLOW, BLOCK = "allow", "block"
SAMPLE = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("url_length", "host_length", "path_length", "depth", "digits", "host_digits", "entropy", "parameters", "hyphens", "dots", "longest_label", "secure", "suffix2", "suffix3", "prefix1", "prefix2")
#: What the statistics are of.
ENDS = {
    "suffix2": lambda: F.substring_index("host", ".", -2), "suffix3": lambda: F.substring_index("host", ".", -3),
    "prefix1": lambda: F.regexp_extract("path", "^/[^/]*", 0), "prefix2": lambda: F.regexp_extract("path", "^/[^/]*/?.?", 0),
}


def host(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, with A-Z in lower case."""
    rest = F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(rest, UPPER, LOWER)).otherwise("")


def path(url: Column) -> Column:
    """What follows the host up to ? or #."""
    rest = F.substring_index(F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "?", 1), "#", 1)
    return F.when((F.instr(url, "://") > 0) & (F.instr(rest, "/") > 0), F.substring(rest, F.instr(rest, "/"), F.length(rest))).otherwise("")


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))


def rule_for(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of columns host and path, null where none fits. rules: (verdict, rule), a
    list short enough to be part of the plan."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        suffix, _, prefix = text.partition("/")
        fits = ((F.col("host") == suffix) | F.endswith(F.col("host"), F.lit(f".{suffix}"))) & F.startswith(F.col("path"), F.lit(f"/{prefix}"))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def rule_labels(urls: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """(url, blocked 0/1) of the URLs that the rules decide."""
    _, verdict = rule_for(rules)
    decided = with_parts(urls.select(F.col(url).alias("url"))).select("url", verdict.alias("verdict")).where("verdict is not null")
    return decided.select("url", (F.col("verdict") == BLOCK).cast("double").alias("blocked"))


def lexical(rows: DataFrame, url: str = "url") -> DataFrame:
    """Adds the features other than suffix statistics; needs host and path."""
    u, h = F.coalesce(F.col(url), F.lit("")), F.col("host")
    ratio = lambda c: F.length(F.regexp_replace(c, "[^0-9]", "")) / F.greatest(F.length(c), F.lit(1))
    counts = F.transform(F.array_distinct(F.split(h, "")), lambda c: F.length(h) - F.length(F.replace(h, c, F.lit(""))))
    share = F.transform(F.filter(counts, lambda n: n > 0), lambda n: n / F.length(h))
    entropy = F.aggregate(share, F.lit(0.0), lambda s, p: s - p * F.log2(p))
    count = lambda c, x: (F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))).cast("double")
    query = F.when(F.instr(u, "?") > 0, F.substring_index(F.substring_index(F.substring(u, F.instr(u, "?") + 1, F.length(u)), "#", 1), "?", -1)).otherwise("")
    return rows.withColumns({
        "url_length": F.length(u).cast("double"), "host_length": F.length(h).cast("double"), "path_length": F.length("path").cast("double"),
        "depth": count(F.col("path"), "/"), "digits": ratio(u), "host_digits": ratio(h), "entropy": F.coalesce(entropy, F.lit(0.0)),
        "parameters": F.when(query == "", 0.0).otherwise(count(query, "&") + 1), "hyphens": count(h, "-"), "dots": count(h, "."),
        "longest_label": F.array_max(F.transform(F.split(h, r"\."), lambda x: F.length(x))).cast("double"), "secure": F.startswith(u, F.lit("https:")).cast("double"),
    })


class UrlTrees:
    """Learns from (url, blocked); judges rows that have url, host and path."""

    def __init__(self, labelled: DataFrame, sample: int = SAMPLE, trees: int = 12, depth: int = 5, step: float = 0.3):
        known = labelled.where("url is not null and blocked is not null")
        # One row for a URL: a page that is there many times would else fill the sample.
        known = known.groupBy("url").agg(F.max("blocked").cast("double").alias("blocked"))
        n = known.count()
        chance = F.pmod(F.xxhash64(F.lit("label"), "url"), F.lit(1 << 30)) / float(1 << 30)
        known = lasting(with_parts(known.where(chance < sample / max(1, n))).coalesce(4))
        sums = known.agg(F.sum("blocked"), F.count("*")).first()
        blocked, n = sums[0] or 0.0, sums[1]
        self.only = ALLOW if not n or not blocked else BLOCK if blocked == n else None
        if self.only:
            return
        self.prior = blocked / n
        counted = F.pmod(F.xxhash64(F.lit("half"), "url"), F.lit(2)) == 0
        self.shares = {k: lasting(known.where(counted).groupBy(end().alias(f"_s_{k}")).agg(F.sum("blocked").alias(f"_b_{k}"), F.count("*").alias(f"_n_{k}"))) for k, end in ENDS.items()}
        rows = self._statistics(lexical(known.where(~counted)))
        assembled = lasting(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("features", "blocked"))
        if assembled.isEmpty():  # of a handful of URLs, none for the trees
            self.only = BLOCK if self.prior >= 0.5 else ALLOW
            return
        self.model = GBTClassifier(labelCol="blocked", maxIter=trees, maxDepth=depth, stepSize=step, seed=42).fit(assembled)

    def _statistics(self, rows: DataFrame) -> DataFrame:
        for k, table in self.shares.items():
            b, n = F.coalesce(f"_b_{k}", F.lit(0.0)), F.coalesce(f"_n_{k}", F.lit(0))
            rows = rows.withColumn(f"_s_{k}", ENDS[k]()).join(F.broadcast(table), f"_s_{k}", "left")
            rows = rows.withColumn(k, (b + 2 * self.prior) / (n + 2)).drop(f"_s_{k}", f"_b_{k}", f"_n_{k}")
        return rows

    def judge(self, rows: DataFrame) -> DataFrame:
        """Adds blocked_score, 0 to 1, to rows with url, host and path."""
        if self.only:
            return rows.withColumn("blocked_score", F.lit(float(self.only == BLOCK)))
        full = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(self._statistics(lexical(rows)))
        model = self.model.setFeaturesCol("_features").setProbabilityCol("_p").setRawPredictionCol("_r").setPredictionCol("_l")
        return model.transform(full).withColumn("blocked_score", vector_to_array("_p")[1]).drop("_features", "_p", "_r", "_l", *FEATURES)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, blocked_score of every row."""
    rows = with_parts(pages.select("page_id", "url"))
    rule, verdict = rule_for(rules)
    judged = UrlTrees(labelled).judge(rows)
    guess = F.when(F.col("blocked_score") >= 0.5, BLOCK).otherwise(ALLOW)
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, guess).alias("verdict"), "blocked_score")
