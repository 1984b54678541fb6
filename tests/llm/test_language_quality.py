import zlib

import numpy as np

from tidewatt.llm import language, quality
from tidewatt.llm.queries import op1_language_id, op9_quality_ranking


def test_held_out_language_accuracy(spark, sf):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    own = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in own]) > 0.95
    assert np.mean([r["rejected"] for r in rows]) < 0.02


def test_language_edge_cases(spark):
    rows = [(i, "the end of the road and the river " * 3, "en") for i in range(20)] + [(100 + i, "der und die nicht das auch ein haus " * 3, "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "123 %% !", "en"), (203, "the river and the road " * 5000, None), (None, "nicht das haus", "de"), (0, rows[0][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    content = language.learn_dictionaries(docs)
    assert sorted(content) == ["de", "en"]
    got = [(r["doc_id"], r["j"]["lang_pred"], r["j"]["score"]) for r in docs.select("doc_id", language.identify(content, "text").alias("j")).collect()]
    assert [x[1] for x in got[:40]] == ["en"] * 20 + ["de"] * 20
    assert [x[1:] for x in got[40:43]] == [("und", 0.0)] * 3
    assert got[43][1] == "en" and got[44][1] == "de" and got[45] == got[0]
    assert language.learn_dictionaries(docs.limit(0)) == {}
    assert language.Compressors({}).judge("text")[0] == "und"
    assert language.Compressors({"en": content["en"]}).judge("the river")[0] == "en"


def test_held_out_quality(spark, sf):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op9_quality_ranking(spark, sf).collect()
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    own = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in own]) > 0.95


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (3, "word " * 50_000, 3.0), (None, "A text.", 4.0), (4, "A text.", 5.0), (4, "A text.", 5.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([(1, None), (2, 1)], "doc_id long, quality int")
    for labels in (none, none.limit(0)):
        r = quality.learn(docs, labels)
        assert [x[0] for x in docs.select(quality.score(r, "text")).collect()] == [0.5] * 6
    r = quality.learn(docs, spark.createDataFrame([(3, 0), (4, 1)], "doc_id long, quality int"))
    s = [x[0] for x in docs.select(quality.score(r, "text")).collect()]
    assert s[2] < s[3] == s[4] == s[5]


def test_every_labelled_document_is_in_a_pair():
    better, worse = quality.pairs(np.array([1] * 70 + [0] * 9))
    assert set(better) == set(range(70)) and set(worse) == set(range(70, 79))


def slow_judge(content, text):
    """Every block compressed anew under every dictionary, sizes summed, the smallest taken."""
    import zstandard

    raw = language.letters(text).encode()
    step = -(-len(raw) // language.WINDOWS)
    if len(raw) <= language.SHORT:
        blocks = [raw[max(0, i - language.WINDOW * step) : i] for i in range(min(4 * step, len(raw)), len(raw) + 1, step)]
        plain = dict(window_log=18, chain_log=18, hash_log=17, search_log=6, min_match=3, target_length=256, strategy=zstandard.STRATEGY_BTOPT)
        made = zstandard.ZstdCompressionParameters(format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False, **plain)
    else:
        blocks = [raw[i : i + language.BLOCK] for i in range(0, len(raw), language.BLOCK)]
        made = zstandard.ZstdCompressionParameters.from_level(language.LEVEL, source_size=language.BLOCK, dict_size=max(map(len, content.values())), format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    sizes = {}
    for lang, own in content.items():
        lead = own[-language.LEAD :]
        size = lambda data: len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=made).compress(data))  # noqa: E731, B023
        sizes[lang] = sum(size(lead + b) - size(lead) for b in blocks)
    return min(sorted(sizes), key=sizes.get), sizes


def test_languages_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    content = language.learn_dictionaries(language.training_rows(docs))
    compressors = language.Compressors(content)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(12).collect()]
    for text in [*texts, *[t[50:90] for t in texts], *[t[50:250] for t in texts[:6]]]:
        if language._LETTER.search(text):
            want, sizes = slow_judge(content, text)
            got, _, rejected = compressors.judge(text)
            low, high = sorted(sizes.values())[:2]
            assert got == want and rejected == ((high - low) / max(1, high) < language.NARROW)


def test_every_language_is_learned(spark):
    import random

    rng = random.Random(3)
    words = {f"l{k:03}": ["".join(chr(97 + rng.randrange(26)) for _ in range(6)) for _ in range(8)] for k in range(300)}
    docs = spark.createDataFrame([(i, " ".join(own * 4), lang) for i, (lang, own) in enumerate(words.items())], "doc_id long, text string, lang string")
    content = language.learn_dictionaries(docs)
    assert sorted(content) == sorted(words)
    compressors = language.Compressors(content)
    assert all(compressors.judge(" ".join(words[k][::-1]))[0] == k for k in ("l000", "l256", "l299"))


def test_ties_of_languages_go_to_the_first():
    same = b" the river and the road " * 30
    assert language.Compressors({"b": same, "a": same}).judge("the river and the road")[::2] == ("a", True)


def test_ranking_has_the_least_loss():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (80, 4))
    label = (x[:, 0] + rng.normal(0, 1, 80) > 0).astype(int)
    ranking = quality.Ranking(x, label)
    better, worse = quality.pairs(label)
    z = np.clip((x - ranking.middle) / ranking.scale, -6, 6)
    z = np.concatenate([z, z**2 - 1], axis=1)

    def loss(w):
        return np.log1p(np.exp(-(z[better] - z[worse]) @ w)).sum() + quality.RIDGE / 2 * (w**2).sum()

    at = loss(ranking.weights)
    for k in range(8):
        for d in (-1e-2, 1e-2):
            assert loss(ranking.weights + d * np.eye(8)[k]) > at
    scores = ranking.scores(x)
    assert np.isclose(np.quantile(scores, np.mean(label == 0)), quality.CUT, atol=0.02)
