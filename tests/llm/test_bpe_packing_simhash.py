import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tidewatt.llm import packing, simhash
from tidewatt.llm.bpe import Decoder, Transducer, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [None, "", " \n ", "a", "It's THE  end. The end.", "ÉTÉ ΑΣ Ünïcode 漢字 1234 €", "<|endoftext|>x<|startoftext|>", "ha" * 4000, "=-" * 2500, "x\x1cy\x85z", "é ö"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_librarys(library):
    ours, rng = Transducer(PATH), random.Random(5)
    parts = ["th", "er", "on", "'s", "é", "ü", " ", "\n", ".", "1", "ing", "Ab", "''", "!!"]
    texts = AWKWARD + ["".join(rng.choices(parts, k=rng.randint(1, 900))) for _ in range(60)] + ["".join(rng.choices(parts[:5], k=3000)) for _ in range(4)]
    for text, ids in zip(texts, ours.encode_batch(texts)):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_long_words_come_in_portions(library):
    ours, rng = Transducer(PATH), random.Random(6)
    word = "".join(rng.choices("etaoinshrdlu", k=9000)).encode()
    ids = np.concatenate(list(ours.long_word(word[i : i + 100] for i in range(0, len(word), 100))))
    assert ids.tolist() == library.encode(word.decode(), add_special_tokens=False).ids


def test_every_code_point(library):
    """Alone between letters, and after a mark, which shows its class in normal form."""
    ours = Transducer(PATH)
    points = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    for form in ("a{0}b 1{0}", "e\u0345{0}\u0301"):
        texts = [" ".join(map(form.format, points[i : i + 512])) for i in range(0, len(points), 512)]
        for text, ids, want in zip(texts, ours.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
            assert ids.tolist() == want.ids, text


def test_the_whole_table(library, sf):
    import pandas as pd

    for name, column in (("documents", "text"), ("pages", "html"), ("conversations", "text")):
        texts = pd.read_parquet(f"{sf}/{name}.parquet")[column].fillna("").tolist()
        for ids, want in zip(Transducer(PATH).encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
            assert ids.tolist() == want.ids


@pytest.mark.parametrize("portion", [1, 2, 3, 7, 50])
def test_runs_without_spaces_are_streamed(library, monkeypatch, portion):
    from tidewatt.llm import bpe

    monkeypatch.setattr(bpe, "PORTION", portion)
    ours, rng = Transducer(PATH), random.Random(portion)
    parts = ["'", "s", "re", "'ve", "l", "'ll", "a", "é", "e\u0301", "\u0345", "1", "ᄀ", "ᅡ", "ᆨ", "!!", "-", "が", "か\u3099", "Σ", " ", "\t", "\u3000", "\n", "\x1f", "İ", "𑤸", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts[: rng.choice((4, 16, 20, len(parts)))], k=rng.randint(1, 60))) for _ in range(300)] + ["x" * 3000 + "1" + "=" * 2500 + "'s"]
    for text, ids, want in zip(texts, ours.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == want.ids, text


def test_memory_stays_bounded_on_one_long_word(library):
    import tracemalloc

    rng = random.Random(9)
    text = "".join(rng.choices("abcdefghijklmnop", k=1 << 19)) + "=" * 100_000
    ours, count = Transducer(PATH), 0
    ours.encode("x" * 5000)
    tracemalloc.start()
    for _, ids in ours.stream([text]):
        count += len(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == len(library.encode(text, add_special_tokens=False).ids) and peak < 8 * (1 << 20)


def test_decoding_in_portions(library):
    ours = Transducer(PATH)
    ids = ours.encode("Été, 漢字 and the end €5")
    for words in (False, True):
        d = Decoder(ours, words)
        text = "".join(d.feed(ids[i : i + 1]) for i in range(len(ids))) + d.finish()
        assert text == ("été , 漢字 and the end € 5 " if words else library.decode(ids.tolist(), skip_special_tokens=False))


def test_encode_documents(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(AWKWARD + ["a"])] + [(None, "a", "y")], "doc_id long, text string, n_tokens string")
    rows = {r["doc_id"]: r for r in encode_documents(docs, PATH).collect()}
    for i, t in enumerate(AWKWARD):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert None in rows
    assert encode_documents(docs.limit(0), PATH).count() == 0


def test_packing_covers_every_piece_without_gaps(spark, library):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(AWKWARD * 3)] + [(1, "", 7), (None, None, 7)], "doc_id long, text string, offset int")
    rows = packing.pack_documents(docs, PATH, limit=256).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, t in enumerate(AWKWARD * 3):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted((r for r in by_doc[i]), key=lambda r: r["piece"])[-(-(-len(ids) // 256)) :]
        assert [r["start"] for r in own] == list(range(0, len(ids), 256))
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(ids[k : k + 256].tobytes()) for k in range(0, len(ids), 256)]
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= -(-total // 256) + 1
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_histograms_pack_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    h = np.bincount(np.clip(rng.lognormal(5 + seed / 2, 1, 20_000).astype(int), 1, 2048), minlength=2049)
    got, n = np.zeros(2049, int), 0
    for lengths, times in packing.pack_histogram(h):
        assert sum(lengths) <= 2048
        n += times
        for a in lengths:
            got[a] += times
    assert (got == h).all()
    assert n <= 1.01 * (h * np.arange(2049)).sum() / 2048 + 1


def slow_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\x09\x0a\x0b\x0c\x0d":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps):
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randint(40, 200))) for _ in range(25)]
    texts = [None, "", "One", "one", "Two Words", "a\x0bb\x0cc d"] + base + base[:5]
    for t in base[:12]:
        for _ in range(4):
            w = t.split(" ")
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    rows = [(i * 3, t, "z") for i, t in enumerate(texts)] + [(None, base[0], "z"), (9, texts[3], "z")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    fps = [slow_fingerprint(t) for _, t, _ in rows]
    expected = sorted(zip([r[0] is None for r in rows], [r[0] or 0 for r in rows], [f - (1 << 64) if f >> 63 else f for f in fps], slow_components([r[0] for r in rows], fps)))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == [tuple(x) for x in expected]
    stay = simhash.kept(docs)
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted({x[3] for x in expected})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("splits", [3, 0])
def test_crowded_keys_lose_no_link(spark, monkeypatch, splits):
    monkeypatch.setattr(simhash, "BLOCK", 3)
    monkeypatch.setattr(simhash, "TILE", 4)
    monkeypatch.setattr(simhash, "SPLITS", splits)
    rng = random.Random(2)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    from tidewatt.llm.components import components

    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    roots = {r["node"]: r["root"] for r in components(edges, "a", "b").collect()}
    assert [roots.get(f, f) for f in fps] == slow_components(fps, [f % (1 << 64) for f in fps])


def test_one_row_stays_whatever_the_ids(spark):
    """Ids that repeat with other texts, and null ids, neither lose a text nor keep a copy."""
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"{x}{rng.randint(0, 99)}" for _ in range(60)) for x in "abcd")
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "x"), (1, b, "w"), (2, a, "x"), (None, a, "x"), (None, c, "x"), (None, c, "x"), (None, d, "x"), (3, d, "y"), (4, None, "x"), (5, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    want = [(1, a, "x"), (1, b, "w"), (3, d, "y"), (4, None, "x"), (None, c, "x")]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(map(tuple, simhash.kept(docs).collect()), key=key) == sorted(want, key=key)
