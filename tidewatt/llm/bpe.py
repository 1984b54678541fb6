"""BPE encoding and decoding (operator 8).

A byte-level BPE with word ends is run as a transducer with bounded lookahead. From the merge
list :func:`sufficient_lookahead` derives how many bytes past a token can still change it. A word
is read in windows; a token is emitted as soon as that many bytes of the word, or its end, lie
behind it, so memory stays constant however long a word or a run without white space is. Decoding
is a state machine that is fed ids in any portions, turns them into bytes, and these into text,
holding back only the bytes of an unfinished character.

Merging is vectorised: all new words of a portion of text advance together, one merge a round. A
long word's windows are merged one after the other with a heap.

Letters, numbers, lower case and normal form are those of the "tokenizers" library, whose tables
are of several Unicode versions: where they depart from those of Python 3.13 (Unicode 15.1), the
fixed values below say so.

Nulls encode as the empty text: no ids, and the empty decoded text. A null doc_id is carried
along. Repeated rows give repeated results, tables without rows give none, and columns other than
the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space as Unicode's White_Space property has it. str.split() also splits at 1C-1F.
_SPACE = r"\t-\r \x85\xa0  -     　"
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WORDS = re.compile(rf"[^{_SPACE}]+")
#: Code points that the library holds for letters and for numbers, and Unicode 15.1 doesn't know.
LATER_LETTERS = "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"
LATER_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
#: Capitals that only the library lowers, and their first small letter.
LATER_CAPITALS = {"1C89": 0x1C8A, "A7CB": 0x264, "A7CC": 0xA7CD, "A7CE": 0xA7CF, "A7D2": 0xA7D3, "A7D4": 0xA7D5, "A7DA": 0xA7DB, "A7DC": 0x19B, "10D50-10D65": 0x10D70, "16EA0-16EB8": 0x16EBB}
#: Marks and one composed letter with its part that normal form does not move or compose in the library.
UNMOVED = (
    "07FD 0898-089F 08CA-08D3 09FE 0C3C 0D3B-0D3C 0EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 10F82-10F85 11070 1133B 1145E "
    "11839-1183A 11930 11938 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"
)


def _ranges(listed: str) -> list[tuple[int, int]]:
    return [(int(x.split("-")[0], 16), int(x.split("-")[-1], 16)) for x in listed.split()]


def _class(ranges: Iterable[tuple[int, int]]) -> str:
    """What stands between the brackets of a pattern."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@lru_cache(maxsize=1)
def classes() -> tuple[str, str]:
    """The letters and the numbers, as parts of a pattern's class."""
    out = []
    for kind, later in (("L", LATER_LETTERS), ("N", LATER_NUMBERS)):
        own = [i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] == kind]
        cuts = [0, *(k for k in range(1, len(own)) if own[k] != own[k - 1] + 1), len(own)]
        out.append(_class([*((own[a], own[b - 1]) for a, b in zip(cuts, cuts[1:])), *_ranges(later)]))
    return out[0], out[1]


_UNMOVED = re.compile(f"([{_class(_ranges(UNMOVED))}])")
_CAPITALS = {c: small + c - a for listed, small in LATER_CAPITALS.items() for a, b in _ranges(listed) for c in range(a, b + 1)}
_LATER = re.compile(f"[{_class((c, c) for c in _CAPITALS)}]")
_NONE = np.int32(2**30)

#: Bytes of a word that are read at a time beyond the lookahead.
WINDOW = 1024
#: Characters of text that are held at a time.
PORTION = 1 << 18
#: Characters of several texts that are held together.
HELD = 1 << 21
#: Characters of words whose ids a worker remembers, at most about, besides those of HELD.
REMEMBERED = 1 << 22


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself where it
    is printable Latin-1, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]], end: str = "</w>") -> int:
    """Bytes past a token's end that can still change that token.

    A merge of (x, y) can depend on what follows y in two ways: y may first be taken by an earlier
    merge of y with its right neighbour, or y may itself have been made depending on its right.
    Either dependence is on a merge of smaller rank, so in rank order the reach of each merge is
    the length of its right part plus the largest reach of those earlier merges.
    """
    taken: dict[str, int] = {}
    made: dict[str, int] = {}
    longest = 0
    for x, y in merges:
        behind = max(taken.get(y, 0), made.get(y, 0))
        reach = len(y.removesuffix(end)) + behind
        taken[x] = max(taken.get(x, 0), reach)
        made[x + y] = max(made.get(x + y, 0), behind)
        longest = max(longest, reach)
    return longest


class _Numbers(dict):
    """Numbers its keys as they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Transducer:
    """Encodes by a tokenizer file of the "tokenizers" library: byte-level BPE, lower case, word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        self.written = {i: t.encode() for i, t in self.tokens.items()}
        means = {c: b for b, c in enumerate(byte_characters())}
        self.meant = {i: bytes(means.get(c, 63) for c in t.removesuffix(self.end)) + b" " * t.endswith(self.end) for i, t in self.tokens.items()}
        letters = byte_characters()
        self._inner = np.array([vocab[c] for c in letters], np.int32)
        self._final = np.array([vocab[c + self.end] for c in letters], np.int32)
        self.lookahead = sufficient_lookahead(merges, self.end)
        self._bytes = np.zeros(max(self.tokens) + 1, np.int64)
        for i, t in self.tokens.items():
            self._bytes[i] = len(t.removesuffix(self.end))
        self._table(merges, vocab)
        self._merges = merges
        self._vocab = vocab
        letters_, numbers = classes()
        self._pieces = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters_}]+|[{numbers}]|[^{_SPACE}{letters_}{numbers}]+")
        self._letters, self._others = re.compile(f"[{letters_}]*"), re.compile(f"[^{_SPACE}{letters_}{numbers}]*")
        self._forget()

    def _table(self, merges: list[tuple[str, str]], vocab: dict[str, int]) -> None:
        """Pair -> (rank, product) as an open hash table in arrays."""
        pairs = np.array([(vocab[x] << 20) | vocab[y] for x, y in merges], np.int64)
        products = np.array([vocab[x + y] for x, y in merges], np.int32)
        self._shift = 64 - 18
        self._keys = np.full(1 << 18, -1, np.int64)
        self._ranks = np.full(1 << 18, _NONE, np.int32)
        self._products = np.zeros(1 << 18, np.int32)
        self._steps = 0
        home = self._slot(pairs)
        for rank, (key, at) in enumerate(zip(pairs.tolist(), home.tolist())):
            step = 0
            while self._keys[(at + step) & 0x3FFFF] != -1:
                step += 1
            at = (at + step) & 0x3FFFF
            self._steps = max(self._steps, step)
            self._keys[at], self._ranks[at], self._products[at] = key, rank, products[rank]

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self._shift)).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; symbols below 0 pair with nothing."""
        keys = (left.astype(np.int64) << 20) | right
        keys[(left < 0) | (right < 0)] = -2
        at = self._slot(keys)
        ranks, products = np.full(len(keys), _NONE, np.int32), np.zeros(len(keys), np.int32)
        open_ = np.arange(len(keys))
        for _ in range(self._steps + 1):
            there = self._keys[at]
            hit = there == keys[open_]
            ranks[open_[hit]], products[open_[hit]] = self._ranks[at[hit]], self._products[at[hit]]
            more = ~hit & (there != -1)
            open_, at = open_[more], (at[more] + 1) & 0x3FFFF
            if not len(open_):
                break
        return ranks, products

    def _merge(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols, -1 behind the last, with all merges done: the least rank first, then
        the leftmost."""
        rows, width = symbols.shape
        out = symbols.copy()
        if width < 2 or not rows:
            return out
        ranks, products = self._find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        ranks, products = ranks.reshape(rows, -1), products.reshape(rows, -1)
        live = np.arange(rows)
        column = np.arange(width)
        while len(live):
            at = ranks.argmin(axis=1)
            row = np.arange(len(live))
            going = ranks[row, at] < _NONE
            if not going.all():
                out[live[~going]] = symbols[~going]
                live, symbols, ranks, products, at = live[going], symbols[going], ranks[going], products[going], at[going]
                row = np.arange(len(live))
                if not len(live):
                    break
            symbols[row, at] = products[row, at]
            source = np.minimum(column[None, :] + (column[None, :] > at[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, source, axis=1)
            symbols[:, -1] = -1
            source = source[:, : width - 1]
            source = np.minimum(source, width - 2)
            ranks, products = np.take_along_axis(ranks, source, axis=1), np.take_along_axis(products, source, axis=1)
            ranks[:, -1] = _NONE
            right = at + 1 < width
            for where, l, r in ((at > 0, at - 1, at), (right, at, np.minimum(at + 1, width - 1))):
                i = row[where]
                pos = l[where]
                fits = pos < width - 1
                i, pos, r_ = i[fits], pos[fits], r[where][fits]
                ranks[i, pos], products[i, pos] = self._find(symbols[i, pos], symbols[i, r_])
        return out

    def _symbols(self, pieces: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pieces of like length as rows of their first symbols: (which pieces, rows)."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        groups, low = [], 0
        for high in (6, 10, 16, 32, 64, 128, 1 << 30):
            which = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(which):
                width = int(sizes[which].max())
                column = np.arange(width)
                inside = column[None, :] < sizes[which][:, None]
                at = np.where(inside, starts[which][:, None] + column[None, :], 0)
                rows = np.where(inside, self._inner[flat[at]], np.int32(-1)).astype(np.int32)
                last = sizes[which] - 1
                rows[np.arange(len(which)), last] = self._final[flat[starts[which] + last]]
                groups.append((which, rows))
        return groups

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """One row with all merges done, by a heap of pairs and links between the symbols."""
        if not hasattr(self, "_pairs"):
            self._pairs = {(self._vocab[x], self._vocab[y]): (rank, self._vocab[x + y]) for rank, (x, y) in enumerate(self._merges)}
        pairs = self._pairs.get
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i, found[1]) for i in range(n - 1) if (found := pairs((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, product = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n or pairs((symbols[i], symbols[j]), (None,))[0] != rank:
                continue
            symbols[i], symbols[j] = product, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := pairs((product, symbols[k])):
                    heapq.heappush(heap, (found[0], i, found[1]))
            if (h := before[i]) >= 0 and (found := pairs((symbols[h], product))):
                heapq.heappush(heap, (found[0], h, found[1]))
        return [x for x in symbols if x >= 0]

    def long_word(self, word: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids of one word that comes in portions of bytes, emitted once they are stable."""
        one = LongWord(self)
        for portion in word:
            yield from one.feed(portion)
        yield from one.finish()

    def pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, each a word without white space or a run of signs, one behind the
        other, and how many each has."""
        counts = np.zeros(len(pieces), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        short = np.flatnonzero(np.fromiter(map(len, pieces), np.int64, len(pieces)) <= self.lookahead + WINDOW)
        for which, rows in self._symbols([pieces[i] for i in short.tolist()]) if len(short) else []:
            merged = self._merge(rows)
            there = merged >= 0
            counts[short[which]] = there.sum(axis=1)
            done.append((short[which], merged[there]))
        for i in np.setdiff1d(np.arange(len(pieces)), short).tolist():
            ids = np.concatenate(list(self.long_word([pieces[i]])))
            counts[i] = len(ids)
            done.append((np.array([i]), ids))
        out = np.zeros(int(counts.sum()), np.int32)
        starts = np.cumsum(counts) - counts
        for which, ids in done:
            n = counts[which]
            out[np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, counts

    def _forget(self) -> None:
        self._index = _Numbers()
        self._characters = 0
        self._starts, self._counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.int32)

    def _learn(self, words: list[str]) -> None:
        """Adds the ids of words between white space to what is remembered."""
        pieces: list[bytes] = []
        owners: list[int] = []
        for k, w in enumerate(words):
            if w.isalpha():
                found = (w,)
            elif w[-1] in ".,;:!?" and w[:-1].isalpha():
                found = (w[:-1], w[-1])
            else:
                found = self._pieces.findall(w)
            for p in found:
                pieces.append(p.encode("utf-8", "surrogatepass"))
                owners.append(k)
        self._characters += sum(map(len, words))
        ids, sizes = self.pieces(pieces)
        counts = np.bincount(np.array(owners, np.int64), sizes, len(words)).astype(np.int64) if owners else np.zeros(len(words), np.int64)
        starts = len(self._flat) + np.cumsum(counts) - counts
        self._flat = np.concatenate([self._flat, ids])
        self._starts, self._counts = np.concatenate([self._starts, starts]), np.concatenate([self._counts, counts])

    def _portions(self, text: str) -> Iterator[str | int | Iterator[str]]:
        """Portions of a text in normal form, ids of special tokens, and, for runs without white
        space that are longer than a portion, iterators of their parts. Portions end before white
        space, across which neither normal form nor words reach."""
        parts = self._special.split(text) if self._special and self._special.search(text) else [text]
        for part in parts:
            if part in self.specials:
                yield self.specials[part]
                continue
            at = 0
            while at < len(part):
                stop = at + PORTION
                if stop < len(part):
                    cut = max(part.rfind(" ", at, stop), part.rfind("\n", at, stop))
                    if cut <= at:
                        cut = next((i for i in range(stop, at, -1) if not _WORDS.match(part[i])), at)
                    if cut <= at:
                        run = _WORDS.search(part, at)
                        yield self._parts_of(part, *run.span())
                        at = run.end()
                        continue
                    stop = cut
                yield normal(part[at:stop])
                at = stop

    @staticmethod
    def _parts_of(text: str, at: int, end: int) -> Iterator[str]:
        """A run without white space in parts in normal form, cut where that does not reach across."""
        while at < end:
            stop = min(end, at + PORTION)
            while stop < end and not _starts(text[stop]):
                stop += 1
            yield normal(text[at:stop])
            at = stop

    def _run(self, parts: Iterator[str]) -> Iterator[np.ndarray]:
        """Ids of a run without white space that comes in parts. The last piece of a part may go on
        in the next one; one that grows long is fed on as it comes."""
        held, word, kind = "", None, None
        for part in itertools.chain(parts, [None]):
            held += part or ""
            if word:
                more = kind.match(held).end()
                yield from word.feed(held[:more].encode("utf-8", "surrogatepass"))
                held = held[more:]
                if not held and part is not None:
                    continue
                yield from word.finish()
                word = None
            found = self._pieces.findall(held)
            rest = 0
            if part is not None and found:
                # The last piece, and an apostrophe that it may form a suffix with, wait for more.
                rest = 2 if len(found) > 1 and found[-2] == "'" and len(found[-1]) < 2 else 1
            held = "".join(found[len(found) - rest :])
            if done := found[: len(found) - rest]:
                yield self.pieces([p.encode("utf-8", "surrogatepass") for p in done])[0]
            if rest == 1 and len(held) > max(PORTION, 8):
                kind = self._letters if self._letters.match(held).end() else self._others
                word = LongWord(self)
                yield from word.feed(held.encode("utf-8", "surrogatepass"))
                held = ""

    def stream(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, some of its ids), in order; at most HELD characters are held, and
        new words of so many are merged together."""
        held: list[tuple[int, str | int]] = []
        size = 0
        for k, text in enumerate(texts):
            for portion in self._portions(text or ""):
                if not isinstance(portion, (int, str)):
                    yield from self._together(held)
                    held, size = [], 0
                    yield from ((k, ids) for ids in self._run(portion))
                    continue
                held.append((k, portion))
                size += 1 if isinstance(portion, int) else len(portion)
                if size >= HELD:
                    yield from self._together(held)
                    held, size = [], 0
        yield from self._together(held)

    def _together(self, held: list[tuple[int, str | int]]) -> Iterator[tuple[int, np.ndarray]]:
        if self._characters > REMEMBERED:
            self._forget()
        index, known = self._index, len(self._index)
        number = index.__getitem__
        units = []
        for k, portion in held:
            if isinstance(portion, int):
                units.append((k, portion))
                continue
            words = _WORDS.findall(portion) if _SEPARATORS.search(portion) else portion.split()
            units.append((k, np.fromiter(map(number, words), np.int64, len(words))))
        if len(index) > known:
            self._learn(list(itertools.islice(index, known, None)))
        for k, at in units:
            if isinstance(at, int):
                yield k, np.array([at], np.int32)
            elif len(at):
                counts = self._counts[at]
                ends = np.cumsum(counts)
                yield k, self._flat[np.repeat(self._starts[at] - (ends - counts), counts) + np.arange(ends[-1])]

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        texts = list(texts)
        done, parts = 0, []
        for k, ids in self.stream(texts):
            while done < k:
                yield np.concatenate(parts) if parts else np.zeros(0, np.int32)
                done, parts = done + 1, []
            parts.append(ids)
        while done < len(texts):
            yield np.concatenate(parts) if parts else np.zeros(0, np.int32)
            done, parts = done + 1, []

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_batch([text]))


class LongWord:
    """The transducer on one word: fed bytes, it emits ids once the lookahead lies behind them."""

    def __init__(self, transducer: Transducer):
        self._of = transducer
        self._held = b""

    def feed(self, portion: bytes) -> Iterator[np.ndarray]:
        of = self._of
        for i in range(0, len(portion), WINDOW):
            self._held += portion[i : i + WINDOW]
            if len(self._held) < of.lookahead + WINDOW:
                continue
            ids = np.array(of._merge_long(of._inner[np.frombuffer(self._held, np.uint8)].tolist()), np.int32)
            ends = np.cumsum(of._bytes[ids])
            n = int(np.searchsorted(ends, len(self._held) - 1 - of.lookahead, side="right"))
            if n:
                yield ids[:n]
                self._held = self._held[int(ends[n - 1]) :]

    def finish(self) -> Iterator[np.ndarray]:
        if self._held:
            of = self._of
            row = of._inner[np.frombuffer(self._held, np.uint8)].tolist()
            row[-1] = int(of._final[self._held[-1]])
            yield np.array(of._merge_long(row), np.int32)


def _starts(c: str) -> bool:
    """Whether normal form never changes across the place before c."""
    return c.isascii() or not (unicodedata.combining(c) or unicodedata.category(c)[0] == "M" or "\u1100" <= c <= "\u11ff")


def normal(text: str) -> str:
    """NFC, then lower case by single characters (a capital sigma has one form everywhere)."""
    if text.isascii():
        return text.lower()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        if _UNMOVED.search(text):
            text = "".join(unicodedata.normalize("NFC", x) for x in _UNMOVED.split(text))
        elif not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if _LATER.search(text):
            text = text.translate(_CAPITALS)
        text = text.replace("Σ", "σ")
    return text.lower()


class Decoder:
    """Turns ids into text as they come: each token gives bytes, and the state is the incomplete
    UTF-8 sequence at the end of what was fed.

    As the library does it (``words=False``), a token's bytes are those of its written form, with a
    space between two. With ``words=True`` they are the bytes that it stands for, and word ends are
    spaces.
    """

    def __init__(self, transducer: Transducer, words: bool = False):
        self._of = transducer.meant if words else transducer.written
        self._between = b"" if words else b" "
        self._begun = False
        self._state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        raw = self._between.join(map(self._of.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
        if raw and self._begun:
            raw = self._between + raw
        self._begun |= bool(raw)
        return self._state.decode(raw)

    def finish(self) -> str:
        return self._state.decode(b"", final=True)


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    """One for each worker process and file."""
    return Transducer(path)


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text; no shuffle."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = transducer(tokenizer)
        for texts in batches:
            rows = []
            fresh = lambda: [0, hashlib.sha256(), hashlib.sha256(), Decoder(bpe)]
            done, state = 0, fresh()

            def close(state: list) -> None:
                state[2].update(state[3].finish().encode())
                rows.append((state[0], state[1].hexdigest(), state[2].hexdigest()))

            for k, ids in bpe.stream(texts):
                while done < k:
                    close(state)
                    done, state = done + 1, fresh()
                state[0] += len(ids)
                state[1].update(ids.astype("<u4").tobytes())
                state[2].update(state[3].feed(ids).encode())
            while done < len(texts):
                close(state)
                done, state = done + 1, fresh()
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", coded(F.col(text)).alias("_coded")).select("doc_id", "_coded.*")
