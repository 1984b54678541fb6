"""Language identification by compression (operator 1).

For each language a raw-content zstandard dictionary is filled with bounded snippets of labelled
texts. A text, lower-cased and encoded, is cut into blocks; every block is compressed once with
each dictionary, and the language whose dictionary gives the fewest bytes over the whole text is
chosen. The margin is the share of bytes saved against the second smallest; the text is rejected
where that is narrow, as a mixture or an unknown language would be.

A null text, or one without any letter, is ``und`` with score 0 and is rejected. So is every text
where no language was learned. With a single learned language the margin is taken against no
dictionary. Labels that are null, and null or empty texts, teach nothing. Repeated rows and ids are
judged alike; texts that two languages make equally small go to the one that sorts first, and are
rejected. Columns are only added.

Sizes in whole bytes tell long texts' languages apart, but not those of short ones: these are cut into
``WINDOWS`` overlapping windows, whose sizes together resolve fractions of a byte, and are compressed
with a finer parser. For long texts neither changes the outcome, and the parser takes four times as long.

Every language is learned. The sample has ``SNIPPETS`` snippets of each, or fewer where there are so
many languages that all would have more than ``SAMPLE``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: The training sample: about so many snippets of each language, of so many characters.
SNIPPETS = 512
SNIPPET_CHARACTERS = 384
#: Snippets of all languages, about; more languages than that are an error in the labels.
SAMPLE = 131_072
#: Bytes compressed at a time.
BLOCK = 4096
LEVEL = 3
#: Below this margin a text is rejected; a margin of SURE scores 1.
NARROW = 0.002
SURE = 0.08

#: Texts up to so many bytes are compressed with an optimal parser, which finds matches from 3 bytes on.
SHORT = 384
LEAD = 512
#: Windows of a short text, about, and the bytes of one where all windows fit in.
WINDOWS = 48
WINDOW = 12

_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_REPEATED = regex.compile(r" (\p{L}++)(?: \1(?= ))++")


def letters(text: str) -> str:
    """The words of a text in lower case between single spaces, without signs, digits and
    immediate repeats, which say nothing about the language."""
    return _REPEATED.sub(r" \1", " " + _OTHER.sub(" ", text.lower()).strip() + " ")


def learn_dictionaries(docs: DataFrame, snippets: int = SNIPPETS, characters: int = SNIPPET_CHARACTERS) -> dict[str, bytes]:
    """language -> content, from rows (doc_id, text, lang).
    The sample is chosen by a hash of id and text at a rate set by each language's count, so it is
    bounded, evenly spread and repeatable; a snippet starts at a hashed place in its text. Rows that
    repeat id and text give one snippet."""
    rows = docs.where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(SAMPLE + 1).collect()}
    if not counts:
        return {}
    if len(counts) > SAMPLE:
        raise ValueError(f"more than {SAMPLE} languages")
    snippets = max(1, min(snippets, SAMPLE // len(counts)))
    rate = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, snippets / n))])
    h = F.xxhash64(F.lit("snippet"), "doc_id", "text")
    chance = F.pmod(h, F.lit(1 << 30)) / float(1 << 30)
    start = F.pmod(F.shiftright(h, 30), F.greatest(F.lit(1), F.length("text") - characters + 1)).cast("int") + 1
    sample = rows.where(chance < rate[F.col("lang")]).select("lang", h.alias("h"), F.substring(F.col("text"), start, F.lit(characters)).alias("s")).distinct()
    content: dict[str, list[str]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["h"], r["s"])):
        if _LETTER.search(r["s"]):
            content.setdefault(r["lang"], []).append(letters(r["s"]))
    return {lang: "".join(own).encode("utf-8", "surrogatepass") for lang, own in sorted(content.items())}


class Compressors:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, content: dict[str, bytes]):
        self.languages = sorted(content)
        # No checksum, size or id, whose bytes would be alike for all languages and blur short texts.
        plain = dict(format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
        wide = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK, dict_size=max(map(len, content.values()), default=0), **plain)
        near = zstandard.ZstdCompressionParameters(window_log=18, chain_log=18, hash_log=17, search_log=6, min_match=3, target_length=256, strategy=zstandard.STRATEGY_BTOPT, **plain)
        self._each = [[self._compressor(content[lang], p) for lang in self.languages] for p in (near, wide)]
        self._bare = zstandard.ZstdCompressor(compression_params=wide).compress

    @staticmethod
    def _compressor(content: bytes, parameters: zstandard.ZstdCompressionParameters):
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=parameters)
        compress = zstandard.ZstdCompressor(dict_data=data, compression_params=parameters).compress
        # A lead that the dictionary holds costs a few bytes, and keeps short blocks from being stored as they are.
        lead = content[-LEAD:]
        alone = len(compress(lead))
        return lambda block: len(compress(lead + block)) - alone

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)"""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        raw = letters(text).encode("utf-8", "surrogatepass")
        if len(raw) <= SHORT:
            step = -(-len(raw) // WINDOWS)
            blocks = [raw[max(0, i - WINDOW * step) : i] for i in range(min(4 * step, len(raw)), len(raw) + 1, step)]
        else:
            blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = [sum(map(size, blocks)) for size in self._each[len(raw) > SHORT]]
        best = min(sizes)
        rest = sorted(sizes)[1] if len(sizes) > 1 else sum(len(self._bare(b)) for b in blocks)
        margin = max(0.0, (rest - best) / max(1, rest))
        return self.languages[sizes.index(best)], min(1.0, margin / SURE), margin < NARROW


def identify(content: dict[str, bytes], text: Column | str) -> Column:
    """struct(lang_pred, score, rejected) of whole texts."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = Compressors(content)
        for texts in batches:
            yield pd.DataFrame([compressors.judge(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return judged(F.col(text) if isinstance(text, str) else text)


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows whose crc32(doc_id as text) mod 4 is not 2; a null id is none of them."""
    return docs.where(~held_out())


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
