"""Secret scans with a linear-chain conditional random field (operator 11).

Three patterns give the base spans: assigned values, access keys and long hexadecimal runs. A
conditional random field over the tags outside, begin and inside then tags all tokens of the text;
its features are a token's shape, its neighbours' words and shapes, and features of the whole text.
Its best path is found by Viterbi's algorithm, and what it marks beyond the base spans is added as
kind ``model``.

The field learns from a bounded sample: snippets around base spans, and snippets from any places.
Values of the former are also replaced by random ones of other alphabets and lengths, and the words
before them by others, so that shape and place are learned and not the patterns again; ordinary words
and numbers in the same places are learned to be outside.

Where the score of outside leads by more than transitions can make up for, a token is outside on
every best path. These are found for all tokens at once, and only the runs between them are
searched; the path is the one that a search over the whole text finds.

A null text counts as empty and has no spans. Texts may be of any length. Positions are code points.
Repeated rows get equal results. Where no text has a base span nothing is learned, and only base spans,
of which there are none, are given. A span of the field that lies within a base span is left out; one
that overlaps some is kept. Tables without rows give none; columns other than those named are
ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "model")
#: Texts with base spans, and texts of any kind, that are learned from at most; snippets of each of the former, code points around.
SAMPLE = 240
SNIPPETS = 3
AROUND = 160
#: Code points of a value that a snippet keeps at most, and of a span of the field at least.
VALUE = 192
LEAST = 8
#: Tokens whose scores a task remembers.
REMEMBERED = 200_000

_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: What the learning rows have, for Spark; every base span is found by it.
LIKELY = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}|AKIA[A-Z0-9]{12}|(?-i:[0-9a-f]{32})"

_STEPS = (2, 4, 8, 12, 16, 20, 24, 32, 48)
_PLACES = ("p1", "p2", "n1")
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
OUTSIDE, BEGIN, INSIDE = range(3)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by start and then kind."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def values(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves stand, without the names that they are assigned to; joined where they overlap."""
    found = [m.span(1) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    found += [m.span() for p in (_ACCESS, _HEX) for m in p.finditer(text)]
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


Traits = tuple[str, int, bool | None, int, int]


def traits(word: str) -> Traits:
    """A token's shape: the kinds of its characters with their changes, its length by steps, and of
    ASCII letters and digits whether all are hexadecimal, and how many vowels and different ones."""
    size = len(word)
    steps = bisect.bisect_right(_STEPS, size)
    if not word.isascii():
        return ("w" if word[0].isalnum() else word[0]), steps, None, 0, 0
    if not word.isalnum():
        return word, steps, None, 0, 0
    if word.islower() and word.isalpha():
        kinds = "l0"
    else:
        head = ["d" if c.isdigit() else "l" if c.islower() else "u" for c in word[:128]]
        changes = sum(map(str.__ne__, head, head[1:])) * 16
        kinds = "".join(sorted(set(head))) + str(sum(changes >= n * len(head) for n in (1, 2, 4, 7)))
    low = word.lower()
    vowels = low.count("a") + low.count("e") + low.count("i") + low.count("o") + low.count("u")
    return kinds, steps, not low.strip("0123456789abcdef"), 8 * vowels // size, 8 * len(set(word)) // size


def own_features(t: Traits) -> list[str]:
    kinds, steps, hex_, vowels, kinds_of = t
    out = ["bias", f"k={kinds}", f"n={steps}", f"kn={kinds},{steps}"]
    return out if hex_ is None else [*out, f"x={hex_},{steps}", f"v={vowels},{steps}", f"c={kinds_of},{steps}"]


def near_shape(place: str, t: Traits) -> str:
    """Of a neighbour: place is p1, p2 or n1."""
    return f"{place}s={t[0]},{t[1]}"


def near_word(place: str, word: str) -> str:
    return f"{place}={word[:24].lower()}"


def file_features(text: str, words: list[str]) -> list[str]:
    """Of a whole text."""
    size = max(1, len(text))
    signs = sum(text.count(c) for c in "={}();")
    return [f"f.signs={min(6, int(np.log2(1 + 1000 * signs / size)))}", f"f.tokens={min(6, len(words) * 16 // size)}"]


class Field:
    """Weights of features and transitions, and the search for the best path."""

    def __init__(self, weights: dict[str, tuple[float, float, float]], moves: np.ndarray):
        self.weights, self.moves = weights, moves
        #: By how much a token's outside score must lead for it to be outside on every best path.
        ways = moves[:, :, None] + moves[None, :, :]  # before, at, after
        around = (ways - ways[:, OUTSIDE : OUTSIDE + 1, :]).max(axis=(0, 2))
        one = np.maximum((moves - moves[OUTSIDE : OUTSIDE + 1]).max(axis=1), (moves - moves[:, OUTSIDE : OUTSIDE + 1]).max(axis=0))
        self.lead = np.maximum(np.maximum(around, one), 0)[1:] + 1e-6
        self._ids: dict[str, int] = {}
        self._shapes: dict[Traits, np.ndarray] = {}
        self._table = np.zeros((1024, 12))
        self._known = {f.partition("=")[2] for f in weights if f[:3] in {f"{p}=" for p in _PLACES}}

    def _sum(self, features: list[str]) -> np.ndarray:
        return sum((np.array(self.weights[f]) for f in features if f in self.weights), np.zeros(3))

    def _of(self, word: str) -> int:
        """The row of a token's own scores and of those that it lends its neighbours."""
        i = self._ids[word] = len(self._ids)
        if i == len(self._table):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
        t = traits(word)
        if t not in self._shapes:
            self._shapes[t] = np.concatenate([self._sum(own_features(t)), *(self._sum([near_shape(p, t)]) for p in _PLACES)])
        self._table[i] = self._shapes[t]
        if word[:24].lower() in self._known:
            for k, place in enumerate(_PLACES, 1):
                self._table[i, 3 * k : 3 * k + 3] += self.weights.get(near_word(place, word), 0.0)
        return i

    def scores(self, text: str, words: list[str]) -> np.ndarray:
        """Scores of the tags of each token."""
        if len(self._ids) > REMEMBERED:
            self._ids.clear()
        ids = self._ids
        at = np.array([i if (i := ids.get(w)) is not None else self._of(w) for w in words], np.int64)
        each = self._table[at]
        out = each[:, 0:3] + self._sum(file_features(text, words))
        out[1:] += each[:-1, 3:6]
        out[2:] += each[:-2, 6:9]
        out[:-1] += each[1:, 9:12]
        return out

    def path(self, scores: np.ndarray) -> np.ndarray:
        """The best tags: Viterbi's algorithm on each run between tokens that are outside for sure."""
        tags = np.zeros(len(scores), np.int64)
        open_ = ~((scores[:, OUTSIDE, None] - scores[:, 1:]) > self.lead).all(axis=1)
        at = np.flatnonzero(open_)
        if len(at):
            cuts = np.flatnonzero(np.diff(at) > 1) + 1
            for run in np.split(at, cuts):
                first, last = run[0], run[-1] + 1
                tags[first:last] = self._viterbi(scores[first:last], first > 0, last < len(scores))
        return tags

    def _viterbi(self, scores: np.ndarray, before: bool, after: bool) -> list[int]:
        """before, after: whether a token that is outside stands there."""
        moves, n = self.moves.tolist(), len(scores)
        best = [s + (moves[OUTSIDE][t] if before else 0.0) for t, s in enumerate(scores[0].tolist())]
        back = []
        for row in scores[1:].tolist():
            came = [max(range(3), key=lambda a, t=t: best[a] + moves[a][t]) for t in range(3)]
            best = [best[a] + moves[a][t] + row[t] for t, a in enumerate(came)]
            back.append(came)
        at = max(range(3), key=lambda t: best[t] + (moves[t][OUTSIDE] if after else 0.0))
        out = [at]
        for came in reversed(back):
            at = came[at]
            out.append(at)
        return out[::-1]

    def spans(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of what the best path marks."""
        words = _TOKEN.findall(text)
        if not words or not self.weights:
            return []
        tags = self.path(self.scores(text, words))
        if not tags.any():
            return []
        out: list[list[int]] = []
        last = OUTSIDE
        for tag, m in zip(tags.tolist(), _TOKEN.finditer(text)):
            if tag == BEGIN or (tag == INSIDE and last == OUTSIDE):
                out.append([m.start(), m.end()])
            elif tag == INSIDE:
                out[-1][1] = m.end()
            last = tag
        return [(a, b) for a, b in out if b - a >= LEAST]

    def all_spans(self, text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans, and all spans."""
        base = base_spans(text or "")
        more = [("model", a, b) for a, b in self.spans(text or "") if not any(s <= a and b <= e for _, s, e in base)]
        return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def _snippets(text: str) -> list[str]:
    """Around some base spans, in equal steps among all; very long values are cut in their middle."""
    found = values(text)
    out = []
    for start, end in found[:: max(1, len(found) // SNIPPETS)][:SNIPPETS]:
        cut = min(end, start + VALUE)
        out.append(text[max(0, start - AROUND) : cut] + text[end : end + AROUND])
    return out


def learning_snippets(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> tuple[list[str], list[str]]:
    """Snippets around base spans, and from hashed places of any texts, of at most ``sample`` texts
    each, chosen by a hash of the text; no whole text leaves its task."""

    @F.pandas_udf("array<string>")
    def around(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_snippets(t) for t in texts], dtype=object)

    t = F.col(text)
    rows = docs.select(F.xxhash64(F.lit("secrets"), t).alias("h"), t.alias("t")).where("t is not null and t <> ''")
    start = F.pmod(F.shiftright("h", 20), F.greatest(F.lit(1), F.length("t") - 2 * AROUND)).cast("int") + 1
    plain = rows.select("h", F.array(F.substring(F.col("t"), start, F.lit(2 * AROUND))).alias("s"))
    marked = rows.where(F.col("t").rlike(LIKELY)).select("h", around("t").alias("s"))
    out = []
    for kind in (marked, plain):
        first = kind.groupBy("h").agg(F.min("s").alias("s")).orderBy("h").limit(sample).collect()
        out.append([s for r in sorted(first, key=lambda r: r["h"]) for s in r["s"]])
    return out[0], out[1]


def _tagged(text: str, marked: list[tuple[int, int]]) -> tuple[list[str], list[int], list[str]]:
    """Words, tags and features of the whole."""
    words, tags, i, last = [], [], 0, None
    for m in _TOKEN.finditer(text):
        while i < len(marked) and marked[i][1] <= m.start():
            i += 1
        own = i if i < len(marked) and m.end() > marked[i][0] else None
        words.append(m.group())
        tags.append(OUTSIDE if own is None else INSIDE if own == last else BEGIN)
        last = own
    return words, tags, file_features(text, words)


_ALPHABETS = ("0123456789abcdef", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def examples(marked: list[str], plain: list[str]) -> list[tuple[list[str], list[int], list[str]]]:
    """Tagged token sequences: the snippets as they are, with other values and names, and with
    ordinary words in the values' places."""
    rng = np.random.default_rng(42)
    out = [_tagged(s, values(s)) for s in plain]
    ordinary = sorted({w for words, tags, _ in out for w, t in zip(words, tags) if not t and w.isalpha() and len(w) > 3}) or ["word"]
    pick = lambda: ordinary[rng.integers(len(ordinary))]
    for s in marked:
        found = values(s)
        if not found:
            continue
        out.append(_tagged(s, found))
        for secret in (True, True, False):
            text, spans, end = "", [], 0
            for a, b in found:
                before = s[end:a]
                names = list(_TOKEN.finditer(before))
                word = next((m for m in reversed(names) if m.group().isalnum()), None)
                if word is not None:  # another name
                    before = before[: word.start()] + pick() + before[word.end() :]
                if secret:
                    letters = _ALPHABETS[rng.integers(len(_ALPHABETS))]
                    value = "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(14, 48)))
                    value = value if any(c.isdigit() for c in value) else value + "7"
                else:
                    value = pick() if rng.random() < 0.7 else str(rng.integers(10**3, 10 ** rng.integers(4, 17)))
                text += before
                if secret:
                    spans.append((len(text), len(text) + len(value)))
                text += value
                end = b
            out.append(_tagged(text + s[end:], spans))
    return [x for x in out if x[0]]


def learn(sequences: list[tuple[list[str], list[int], list[str]]], steps: int = 60, ridge: float = 0.1) -> Field:
    """Weights of the largest likelihood with a ridge, by forward and backward sums over all
    sequences at once and Adam's steps. Features met once are left out."""
    if not any(any(tags) for _, tags, _ in sequences):
        return Field({}, np.zeros((3, 3)))
    features = []
    for words, _, whole in sequences:
        for i, w in enumerate(words):
            own = own_features(traits(w)) + whole
            for place, j in zip(_PLACES, (i - 1, i - 2, i + 1)):
                if 0 <= j < len(words):
                    own += [near_shape(place, traits(words[j])), near_word(place, words[j])]
            features.append(own)
    counts = Counter(f for own in features for f in own)
    ids = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n > 1))}
    pairs = [(i, ids[f]) for i, own in enumerate(features) for f in own if f in ids]
    token, feature = np.array(pairs, np.int64).T
    size = np.array([len(w) for w, _, _ in sequences])
    longest, many = int(size.max()), len(sequences)
    seq, place = np.repeat(np.arange(many), size), np.concatenate([np.arange(n) for n in size])
    tags = np.concatenate([t for _, t, _ in sequences])
    there = np.zeros((many, longest), bool)
    there[seq, place] = True
    gold = np.zeros((len(ids), 3))
    np.add.at(gold, (feature, tags[token]), 1.0)
    follows = place[1:] > 0
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (tags[:-1][follows], tags[1:][follows]), 1.0)
    w, moves = np.zeros((len(ids), 3)), np.zeros((3, 3))
    first = [np.zeros_like(w), np.zeros_like(moves)]
    second = [np.zeros_like(w), np.zeros_like(moves)]
    by_token = np.searchsorted(token, np.arange(len(tags)))
    for step in range(1, steps + 1):
        flat = np.add.reduceat(w[feature], by_token, axis=0)
        e = np.zeros((many, longest, 3))
        e[seq, place] = flat
        forward, shift = np.zeros_like(e), np.zeros((many, longest))
        t = np.exp(moves - moves.max())
        em = np.exp(e - e.max(axis=2, keepdims=True))
        f = em[:, 0] / em[:, 0].sum(axis=1, keepdims=True)
        forward[:, 0] = f
        for i in range(1, longest):
            f = (f @ t) * em[:, i]
            shift[:, i] = f.sum(axis=1)
            f = f / shift[:, i : i + 1]
            forward[:, i] = f
        backward = np.ones_like(e)
        expected = np.zeros((3, 3))
        for i in range(longest - 2, -1, -1):
            own = there[:, i + 1]
            right = em[:, i + 1] * backward[:, i + 1] / shift[:, i + 1 : i + 2]
            backward[:, i] = np.where(own[:, None], right @ t.T, 1.0)
            expected += (forward[own, i][:, :, None] * t[None] * right[own][:, None, :]).sum(axis=0)
        p = (forward * backward)[seq, place]
        p /= p.sum(axis=1, keepdims=True)
        model = np.stack([np.bincount(feature, p[token, k], len(ids)) for k in range(3)], axis=1)
        for x, grad, m, v in ((w, gold - model - ridge * w, *(a[0] for a in (first, second))), (moves, gold_moves - expected - ridge * moves, *(a[1] for a in (first, second)))):
            m *= 0.9
            m += 0.1 * grad
            v *= 0.99
            v += 0.01 * grad**2
            x += 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field({f: tuple(w[i]) for f, i in ids.items()}, moves)


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Field:
    return learn(examples(*learning_snippets(docs, text, sample)))


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(field: Field, text: Column | str) -> Column:
    """struct(n_assign, n_access, n_hex, base_sha256, spans) of whole texts."""

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                base, every = field.all_spans(t)
                n = Counter(k for k, _, _ in base)
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_written(base).encode()).hexdigest(), _written(every)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scanned(F.col(text) if isinstance(text, str) else text)
