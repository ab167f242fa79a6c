"""Operator 8: toxicity of restored text.

Disguised words are restored first. A token is a lattice: a leetspeak sign may
stand for a letter, a sign between letters or the repeat of a letter may stand
for nothing, and the space between two tokens is a word border or nothing, for
tokens of any length and letters of any script. Viterbi decoding finds the
reading with the best sum of channel and character language model, a trigram
model counted over all documents; once words are weighed, words of the labelled
texts are arcs of their own. Plain tokens have one path and are taken as they
are. A token whose only sign is a doubled letter, which may be its spelling
or a disguise, is decoded too and has the features of both words. A space goes to the decoder if dropping it could gain anything with some
reading of its neighbours, or if both sides are single signs or make a known
word (``Lexicon.words``); the others are borders.

Restored words are scored by their log odds between toxic and clean labelled
texts, for the word and its first four to six letters; a logistic model over
the words found in a text (how many, how strong, how dense) gives the score.

Labels are learned from all rows of the learning part: one half of them, by a
hash of the id, weighs words, the other fits the logistic model.

Defined results: a null text is empty; empty texts, and all texts without a
learned label of each kind, get the share of toxic rows (0 without any label);
a document labelled more than once is toxic if any label is, null labels are
passed over; repeated rows and null ids are scored like any other; an empty
table gives no row; other columns are left out.
"""

from __future__ import annotations

import itertools
import math
import re
import uuid
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from locusframe.llm.common import arrow_stage, crc_bucket, stored, table, utf8_or_empty, worker_cache
from locusframe.session import broadcast_if_small

#: Least share of the texts it is learned from that a word of the lexicon is in:
#: the lexicon stays bounded however many texts there are.
WORD_SHARE = 4e-4
#: Most weighted words and word starts of a model.
MAX_FEATURES = 20_000
#: Toxic texts a feature must be in, and its least log odds (lower bound).
LEAST_TEXTS, LEAST_ODDS = 4, 1.0
_STARTS = (4, 5, 6)

#: Letters that a sign may stand for (common leetspeak).
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t", "€": "e", "(": "c"}
_READINGS = [str.maketrans({sign: x[k % len(x)] for sign, x in LEET.items()}) for k in (0, 1)]
#: Signs that may stand for nothing between letters.
SEPARATORS = frozenset("-_.*~'`^,:;/\\")
#: Channel costs (natural log): a leet sign, a dropped sign, a dropped repeat.
LEET_COST, DROP_COST, REPEAT_COST = math.log(0.1), math.log(0.1), math.log(0.3)
#: Channel cost of a space that stands for nothing: between two single signs
#: (spaced-out writing), elsewhere.
SPACED_COST, SPACE_COST = math.log(0.5), math.log(0.01)

#: Character classes of the language model: 0 is a word border, 1 any other
#: sign, then small Latin letters.
_LETTERS = [chr(c) for c in range(0x61, 0x180) if chr(c).isalpha() and chr(c).islower()]
CLASSES = 2 + len(_LETTERS)
_CLASS = {c: 2 + i for i, c in enumerate(_LETTERS)}
_EDGES = ".,;:?!\"'()[]{}#%&*<>«»…-_$|"
_NOISY = "#%&*$!?|."
_NOISY_END = re.compile(rf"([{_NOISY}])\1+$")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_SUSPECT = re.compile(r"[^\W\d_][^\w\s]+[^\W_]|[\d@$!|+€(][^\W\d_]|[^\W\d_][\d@$!|+€(]|_|([^\W\d_])\1\1")
#: Edge signs that are no letters, and signs of a number beside no letter.
_PLAIN_EDGES = "".join(c for c in _EDGES if c not in LEET)
_NUMBER = re.compile(r"[\W\d_]{3,}")
#: Edge signs beside which letters never look disguised.
_SAFE = ".,;:?\"')]}>%&*#-"

#: Tokens of texts that are read together, tokens a worker remembers, bytes of
#: remembered runs and of the longest one.
BATCH_TOKENS, MEMO_TOKENS, MEMO_RUN_BYTES, LONGEST_RUN = 100_000, 300_000, 16_000_000, 4_096
#: Cores whose way through the lattice a character model remembers.
MEMO_CORES = 50_000

#: What a lexicon holds of each token, and how its weight is found: from its
#: core, from that and its words without doubled letters, or by decoding it.
_COLUMNS, PLAIN, DOUBLED, DECODED = 11, 0, 1, 2


def _class_table() -> np.ndarray:
    """Class of each code point up to 0x24F, capitals like small letters."""
    classes = np.ones(0x250, np.int64)
    for code in range(0x250):
        low = chr(code).lower()
        if len(low) == 1:
            classes[code] = _CLASS.get(low, 1)
    classes[[9, 10, 11, 12, 13, 32]] = 0
    return classes


#: Class of each small letter, 1 for anything else.
_SMALL = np.array([_CLASS.get(chr(code), 1) for code in range(0x181)], np.int32)


class CharModel:
    """Interpolated trigram model over character classes (flat log table)."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp
        # Single values are read faster through a view than from an array.
        self.view = memoryview(np.ascontiguousarray(logp))
        # Readings of signs, at first and where they repeat the sign before.
        self._single: dict[str, list[tuple[int, float]]] = {}
        self._again: dict[str, list[tuple[int, float]]] = {}
        self._straight: dict[str, tuple[int, int, float, int] | None] = {}

    @classmethod
    def counted(cls, trigrams: np.ndarray) -> CharModel:
        """Model of trigram counts."""
        counts = trigrams.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
        pairs, singles = counts.sum(0), counts.sum((0, 1))
        one = (singles + 1) / (singles.sum() + CLASSES)
        two = (pairs + 20 * one) / (pairs.sum(1, keepdims=True) + 20)
        three = (counts + 20 * two[None]) / (counts.sum(2, keepdims=True) + 20)
        return cls(np.log(three).astype(np.float32).ravel())

    def step(self, a: int, b: int, c: int) -> float:
        return self.view[(a * CLASSES + b) * CLASSES + c]

    def readings_of(self, sign: str, again: bool) -> list[tuple[int, float]]:
        """Classes that a sign may stand for, 0 for nothing, and their costs;
        ``again``: it repeats the sign before it."""
        found = [(_CLASS.get(sign, 1), 0.0)]
        found += [(_CLASS[letter], LEET_COST) for letter in LEET.get(sign, "")]
        if sign in SEPARATORS:
            found.append((0, DROP_COST))
        if again:
            found.append((0, REPEAT_COST))
        held = self._again if again else self._single
        if len(held) < 10_000:
            held[sign] = found
        return found

    def restore(self, token: str) -> str:
        """The best reading of a token (small letters)."""
        # State: the last two classes; value: log probability and reading.
        ways: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        before = ""
        for sign in token:
            readings = [(sign, 0.0)]
            readings += [(letter, LEET_COST) for letter in LEET.get(sign, "")]
            if sign in SEPARATORS:
                readings.append(("", DROP_COST))
            if sign == before:
                readings.append(("", REPEAT_COST))
            further: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (logp, text) in ways.items():
                for letter, cost in readings:
                    if letter:
                        c = _CLASS.get(letter, 1)
                        state, value = (b, c), logp + cost + self.step(a, b, c)
                    else:
                        state, value = (a, b), logp + cost
                    if state not in further or value > further[state][0]:
                        further[state] = value, text + letter
            ways, before = further, sign
        return max((logp + self.step(a, b, 0), text) for (a, b), (logp, text) in ways.items())[1]

    def straight(self, core: str) -> tuple[int, int, float, int] | None:
        """Of a core of two signs or more that has one reading (unless its first
        sign repeats the one before it): the first two classes, the log
        probability of the others after them, and the last two as one number;
        of others None."""
        found = None
        if len(core) > 1 and not any(map(str.__eq__, core, core[1:])):
            readings = [self._single.get(sign) or self.readings_of(sign, False) for sign in core]
            if all(len(x) == 1 for x in readings):
                classes = [x[0][0] for x in readings]
                state, logp = classes[0] * CLASSES + classes[1], 0.0
                for c in classes[2:]:
                    logp += self.view[state * CLASSES + c]
                    state = state % CLASSES * CLASSES + c
                found = classes[0], classes[1], logp, state
        if len(self._straight) >= MEMO_CORES:
            self._straight.clear()
        self._straight[core] = found
        return found

    def joined(self, cores: list[str], signs: list[int], known: dict[str, float], ordered: list[str]) -> list[list[int]]:
        """Numbers of the ``cores`` (small letters, no edge signs) that form
        each word of the best reading; ``signs[k]`` edge signs stand between
        core k and the next. A space is a border, or it and the signs beside it
        are dropped. A word costs its signs or, if ``known``, what that gives;
        ``ordered``: the known words in order."""
        gaps = [
            (SPACED_COST if len(x) == len(y) == 1 else SPACE_COST) + DROP_COST * n
            for x, y, n in zip(cores, cores[1:], signs, strict=False)
        ]
        nothing, logp, readings_of, single, again = (-math.inf, None), self.view, self.readings_of, self._single, self._again
        leet = [0 if x.isalpha() else sum(map(LEET.__contains__, x)) for x in cores]
        arcs: list[tuple[float, tuple | None]] = [nothing] * (len(cores) + 1)
        straight, n_known = self._straight, len(ordered)

        def begins(part: str) -> bool:
            """Whether a longer known word begins with ``part``."""
            at = bisect_right(ordered, part)
            return at < n_known and ordered[at].startswith(part)

        def closed(k: int) -> tuple[float, tuple | None]:
            """The best value with a border after core k - 1."""
            best, at = -math.inf, None
            for state, (v, cut) in ways.items():
                v += logp[state * CLASSES]
                if v > best:
                    best, at = v, cut
            return arcs[k] if arcs[k][0] > best else (best, at)

        # State: the last two classes as one number. Value: log probability and
        # the gaps that are borders (linked list).
        ways: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        border, before = ways[0], ""
        for k, core in enumerate(cores):
            if k:
                split = closed(k)
                ways = {state: (v + gaps[k - 1], cut) for state, (v, cut) in ways.items()}
                ways[0] = border = split[0], (k, split[1])
            # ``other``: the readings of ``whole``, once it has a sign with any.
            whole, cost, marks, other = "", border[0], 0, []
            for j in range(k, len(cores) if known else k):
                part = cores[j]
                if leet[j]:
                    marks += leet[j]
                    other = [x + part.translate(t) for x, t in zip(other or [whole] * len(_READINGS), _READINGS, strict=True)]
                elif other:
                    other = [x + part for x in other]
                whole += part
                value = known.get(whole)
                if value is None and marks:
                    # Words with several readings of one sign are left to the signs.
                    for x in other:
                        if x in known and (value is None or known[x] > value):
                            value = known[x]
                    if value is not None:
                        value += LEET_COST * marks
                if value is not None and cost + value > arcs[j + 1][0]:
                    arcs[j + 1] = cost + value, border[1]
                if j == len(gaps) or not (begins(whole) or other and any(map(begins, other))):
                    break
                cost += gaps[j]
            if core[0] != before and (way := straight[core] if core in straight else self.straight(core)):
                # Two signs of one reading each lead all ways to one state.
                c, d, rest, state = way
                best, at = nothing
                for x, (v, cut) in ways.items():
                    v += logp[x * CLASSES + c]
                    v += logp[(x % CLASSES * CLASSES + c) * CLASSES + d]
                    if v > best:
                        best, at = v, cut
                ways, before = {state: (best + rest, at)}, core[-1]
                continue
            i, size = 0, len(core)
            while i < size:
                if len(ways) == 1:
                    # One way and one reading at a time: no choice to keep.
                    ((state, (v, cut)),) = ways.items()
                    while i < size:
                        sign = core[i]
                        readings = (again if sign == before else single).get(sign) or readings_of(sign, sign == before)
                        if len(readings) != 1:
                            break
                        c = readings[0][0]
                        v += logp[state * CLASSES + c]
                        state, before, i = state % CLASSES * CLASSES + c, sign, i + 1
                    ways = {state: (v, cut)}
                    if i == size:
                        break
                sign = core[i]
                readings = (again if sign == before else single).get(sign) or readings_of(sign, sign == before)
                i += 1
                further: dict[int, tuple[float, tuple | None]] = {}
                if len(readings) == 1:
                    c = readings[0][0]
                    for state, (v, cut) in ways.items():
                        v += logp[state * CLASSES + c]
                        state = state % CLASSES * CLASSES + c
                        if state not in further or v > further[state][0]:
                            further[state] = v, cut
                    ways, before = further, sign
                    continue
                for state, (v, cut) in ways.items():
                    at, after = state * CLASSES, state % CLASSES * CLASSES
                    for c, cost in readings:
                        following, value = (after + c, v + cost + logp[at + c]) if c else (state, v + cost)
                        if following not in further or value > further[following][0]:
                            further[following] = value, cut
                ways, before = further, sign
        cut = closed(len(cores))[1]
        borders = [len(cores)]
        while cut is not None:
            borders.append(cut[0])
            cut = cut[1]
        borders.append(0)
        borders.reverse()
        return [list(range(low, high)) for low, high in zip(borders, borders[1:], strict=False)]


def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of classes over all ``docs`` (text as bytes).

    The result has a fixed size, whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, total = _class_table(), np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for low in range(0, len(texts), 64):
                whole = b"  " + b"  ".join(texts[low : low + 64]) + b"  "
                codes = np.frombuffer(whole.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
                found = classes[np.minimum(codes, 0x24F)]
                # Every word starts after two borders.
                gap = np.flatnonzero((found[:-1] == 0) & (found[1:] != 0)) + 1
                found = np.insert(found, gap, 0)
                at = (found[:-2] * CLASSES + found[1:-1]) * CLASSES + found[2:]
                total += np.bincount(at, minlength=CLASSES**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["at", "n"])

    found = arrow_stage(docs.select("text"), run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES**3, np.int64)
    for row in found.toLocalIterator():
        counts[row.at] = row.n
    return counts


def plain_core(token: bytes) -> str | None:
    """The letters of a token that has no other reading: no signs but common
    ones at its edges, no doubled letter; else None."""
    core = token.decode("utf-8", "replace").lower().strip(_SAFE)
    return core if core.isalpha() and not _DOUBLED.search(core) else None


def restored_token(token: bytes, model: CharModel) -> str:
    """A lower-cased token without edge signs, decoded if it looks disguised."""
    plain = plain_core(token)
    return decoded_token(token, model) if plain is None else plain


def decoded_token(token: bytes, model: CharModel) -> str:
    """The same for a token without a ``plain_core``."""
    word = _NOISY_END.sub("", token.decode("utf-8", "replace").lower())
    core = word.strip(_EDGES)
    if _SUSPECT.search(word):
        core = model.restore(word.strip(".,;:?\"'")).strip(_EDGES)
    return core


class Lexicon(dict):
    """Number of each raw token (small ASCII letters), remembered by a worker
    with what the gaps beside it need. ``known``: log probabilities of words;
    two sides of a known word are read if it or one of them is ``weighed``, as
    the others change no score."""

    def __init__(self, chars: CharModel, known=None, weighed=frozenset(), limit: int = MEMO_TOKENS):
        super().__init__()
        self.chars, self.known, self.weighed, self.limit = chars, known or {}, weighed, limit
        self.ordered = sorted(self.known)
        # Sides of known words that are read, so that few gaps are looked up.
        self.heads, self.tails = set(), set()
        for word in self.known:
            for cut in range(1, len(word)):
                if word in weighed or word[:cut] in weighed or word[cut:] in weighed:
                    self.heads.add(word[:cut])
                    self.tails.add(word[cut:])
        # Classes of the last two and first two letters, signs before and after
        # the core, 0 for no core, 1 for one sign, 2 for more; 1 for an edge
        # that may be read as a letter; 1 for a head and for a tail; how its
        # weight is found.
        self.of = array("i")
        self.raw: list[bytes] = []
        self.cores: list[str] = []
        self.runs: dict[tuple[bytes, ...], list[bytes]] = {}
        self.run_bytes = 0
        self.restored: dict[bytes, str] = {}
        # How often each number was read, halved whenever numbers start anew.
        self.often = np.empty(0, np.int64)

    def forget(self) -> list[int] | None:
        """Called between batches only: numbers stay valid within one. If the
        numbers start anew, the old numbers of the tokens kept: those that were
        read more than once, at most half of the limit."""
        if self.run_bytes > MEMO_RUN_BYTES:
            self.runs.clear()
            self.run_bytes = 0
        if len(self) <= self.limit:
            return None
        most = self.limit // 2
        kept = np.flatnonzero(self.often > 1)
        if len(kept) > most:
            kept = np.sort(kept[np.argpartition(-self.often[kept], most)[:most]])
        self.often = self.often[kept] // 2
        self.of = array("i", np.frombuffer(self.of, np.int32).reshape(-1, _COLUMNS)[kept].tobytes())
        kept = kept.tolist()
        self.raw, self.cores = [self.raw[i] for i in kept], [self.cores[i] for i in kept]
        self.restored = {x: self.restored[x] for x in self.raw if x in self.restored}
        self.clear()
        self.update(zip(self.raw, range(len(kept)), strict=True))
        return kept

    def __missing__(self, token: bytes) -> int:
        at = self[token] = len(self)
        self.raw.append(token)
        return at

    def learn(self) -> None:
        """Cores and rows of the tokens that got a number since the last call."""
        new = self.raw[len(self.cores) :]
        if not new:
            return
        # No token holds a line feed.
        words = b"\n".join(new).decode("utf-8", "replace").lower().split("\n")
        cores, low, high, signed = words[:], [0] * len(new), [0] * len(new), []
        for k, word in enumerate(words):
            if word.isalpha():
                continue
            if word[-2:-1] == word[-1:] and word[-1:] in _NOISY:
                word = word.rstrip(word[-1:])
            core = word.strip(_PLAIN_EDGES)
            if core.isalpha() and "_" not in word:
                cores[k], low[k] = core, word.index(core)
                high[k] = len(word) - low[k] - len(core)
            else:
                signed.append(k)
                cores[k] = ""
        sizes = np.fromiter(map(len, cores), np.int64, len(new))
        codes = np.frombuffer("\n".join([*cores, ""]).encode("utf-32-le"), "<u4")
        first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        last, many = first + sizes - 1, sizes > 1
        twice = (codes[1:] == codes[:-1]) & (codes[1:] != 10)
        kinds = np.full(len(new), PLAIN)
        for kind, found in ((DOUBLED, twice), (DECODED, twice[1:] & twice[:-1])):
            kinds[np.searchsorted(first, np.flatnonzero(found), "right") - 1] = kind
        signed += [k for k in np.flatnonzero(kinds == DECODED).tolist() if not new[k].isalpha()]
        kinds[signed] = DECODED
        classes = _SMALL[np.minimum(codes, len(_SMALL) - 1)]
        rows = np.zeros((len(new), _COLUMNS), np.int32)
        rows[:, 0], rows[:, 1] = np.where(many, classes[last - 1], 0), classes[last]
        rows[:, 2], rows[:, 3] = classes[first], np.where(many, classes[np.minimum(first + 1, len(codes) - 1)], 0)
        rows[:, 4], rows[:, 5], rows[:, 6], rows[:, 10] = low, high, 1 + many, kinds
        for k in signed:
            cores[k], rows[k, :8] = self._signed(new[k])
        if self.heads:
            rows[:, 8] = [x in self.heads for x in cores]
            rows[:, 9] = [x in self.tails for x in cores]
        self.of.frombytes(rows.tobytes())
        self.cores += cores

    def kind(self, at: int) -> int:
        """How the weight of a token is found."""
        return self.of[at * _COLUMNS + 10]

    def _signed(self, token: bytes) -> tuple[str, list[int]]:
        """Core and what is kept of a token with signs or repeated letters."""
        word = token.decode("utf-8", "replace").lower()
        if word[-2:-1] == word[-1:]:
            word = _NOISY_END.sub("", word)
        core = word.strip(_PLAIN_EDGES)
        bare = core.strip(_EDGES) or (core if len(core) == 1 and core in LEET else "")
        row = [0] * 8
        if not bare:
            row[4] = len(word)
            return "", row
        if len(bare) == 1:
            core = bare
        row[4] = word.index(core)
        row[5] = len(word) - row[4] - len(core)
        read, letters = bare, bare.isalpha()
        if (not letters or _DOUBLED.search(bare)) and _SUSPECT.search(bare):
            read = self.restored[token] = restored_token(token, self.chars)
            read = read or bare
        many = len(read) > 1
        of = _CLASS.get
        row[:4] = of(read[-2], 1) if many else 0, of(read[-1], 1), of(read[0], 1), of(read[1], 1) if many else 0
        row[6] = 2 if many else 1
        if not letters:
            row[7] = int((bare[0] in LEET or bare[-1] in LEET) and not _NUMBER.fullmatch(bare))
        return core, row

    def words(self, tokens: list[bytes]) -> list[bytes]:
        """``tokens`` of a text, those that are one word put together."""
        return self.words_of([tokens])[0]

    def words_of(self, texts: list[list[bytes]]) -> list[list[bytes]]:
        """The same for several texts."""
        _, _, runs = self.read(texts)
        out = list(texts)
        for text, found in runs.items():
            words: list[bytes] = []
            done = 0
            for start, stop, read in found:
                words += texts[text][done:start]
                words += read
                done = stop
            out[text] = words + texts[text][done:]
        return out

    def read(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, dict[int, list[tuple[int, int, list[bytes]]]]]:
        """Numbers of all tokens, the first token of each text, and the runs of
        tokens that were decoded: by text, where they lie and what they read.

        Joining X and Y changes the trigrams of the last two letters of X and
        the first two of Y alone. Where a token has one letter, the letter
        beyond it may belong to the word or not: the better case counts. So a
        gap whose best gain is not positive is a border in the best reading by
        signs. Single signs and two sides of a known word go there in any case.
        The gains of all texts are found at once; texts never share a run.
        """
        self.forget()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(texts)), np.int64, int(starts[-1]))
        self.learn()
        read = np.bincount(ids, minlength=len(self))
        read[: len(self.often)] += self.often
        self.often = read
        of = np.frombuffer(self.of, np.int32).reshape(-1, _COLUMNS)[ids]
        at = np.flatnonzero(of[:, 6])
        if len(at) < 2:
            return ids, starts, {}
        signs = np.cumsum(of[:, 4] + of[:, 5], dtype=np.int64)[at]
        text = np.repeat(np.arange(len(texts)), sizes)[at]
        x2, x1, y1, y2, _, high, kind, wild, head, tail, _ = of[at].T.astype(np.int64)
        signs = signs[1:] - signs[:-1] + high[:-1] - high[1:]
        same = text[1:] == text[:-1]
        lp, one = self.chars.logp, kind == 1
        before, after = x2.copy(), y2.copy()
        single = one[1:] & same
        before[1:][single] = x1[:-1][single]
        single = one[:-1] & same
        after[:-1][single] = y1[1:][single]
        left, a, b = x1[:-1], y1[1:], CLASSES

        def lefts(x):
            return lp[(x[:-1] * b + left) * b + a] - lp[(x[:-1] * b + left) * b]

        def rights(y):
            return lp[(left * b + a) * b + y[1:]] - lp[a] - lp[a * b + y[1:]]

        gain = np.maximum(lefts(x2), lefts(before)) + np.maximum(rights(y2), rights(after))
        gain += np.where(one[:-1] & one[1:], SPACED_COST, SPACE_COST) + DROP_COST * signs
        gain[(wild[:-1] | wild[1:] | (one[:-1] & one[1:])).astype(bool)] = 1.0
        known, weighed, cores = self.known, self.weighed, self.cores
        for k in np.flatnonzero(head[:-1] & tail[1:] & same).tolist():
            x, y = cores[ids[at[k]]], cores[ids[at[k + 1]]]
            if (w := x + y) in known and (w in weighed or x in weighed or y in weighed):
                gain[k] = 1.0
        take = np.flatnonzero((gain > 0) & same)
        runs: dict[int, list[tuple[int, int, list[bytes]]]] = {}
        if not len(take):
            return ids, starts, runs
        breaks = np.flatnonzero((np.diff(take) != 1) | (text[take[1:]] != text[take[:-1]])) + 1
        for run in np.split(take, breaks):
            first, last = int(run[0]), int(run[-1]) + 1
            # Runs never share a token: between them lies a border.
            where = int(text[first])
            low, start, stop = int(starts[where]), int(at[first]), int(at[last]) + 1
            key = tuple(texts[where][start - low : stop - low])
            read = self.runs.get(key)
            if read is None:
                read = self._read(key, at[first : last + 1] - start, ids[at[first : last + 1]], signs[run])
                size = sum(map(len, key))
                if size <= LONGEST_RUN:
                    self.runs[key] = read
                    self.run_bytes += size + 100 * len(key)
            runs.setdefault(where, []).append((start - low, stop - low, read))
        return ids, starts, runs

    def _read(self, tokens: tuple[bytes, ...], at: np.ndarray, ids: np.ndarray, signs: np.ndarray) -> list[bytes]:
        cores = [self.cores[i] for i in ids]
        out: list[bytes] = []
        for word in self.chars.joined(cores, signs.tolist(), self.known, self.ordered):
            out.append(tokens[at[word[0]]] if len(word) == 1 else "".join(cores[k] for k in word).encode())
        return out


def restored_words(text: bytes, lexicon: Lexicon) -> list[str]:
    """Restored words of a text, those cut by spaces put together."""
    return [restored_token(x, lexicon.chars) for x in lexicon.words(text.lower().split())]


def restore_texts(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """doc_id and ``restored``: the words of a text as they were meant."""
    logp = docs.sparkSession.sparkContext.broadcast(CharModel.counted(counts).logp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(CharModel(logp.value))
        for batch in batches:
            read = [" ".join(restored_words(x, lexicon)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(read, pa.string())], names=["doc_id", "restored"])

    return arrow_stage(docs.select("doc_id", "text"), run, "doc_id long, restored string")


def features(word: str) -> list[str]:
    """A word and its first letters."""
    return [word, *[word[:k] + "-" for k in _STARTS if len(word) >= k]] if word else []


def token_features(token: bytes, model: CharModel, restored: dict[bytes, str]) -> list[str]:
    """Features of a restored token (if in ``restored``, from there), those of
    all its words for doubled letters."""
    core = restored[token] if token in restored else restored_token(token, model)
    found = features(core)
    if _DOUBLED.search(core):
        found += [x for word in undoubled(core, model) for x in features(word)]
    return found


def undoubled(core: str, model: CharModel) -> list[str]:
    """Other words that ``core`` may stand for if doubled letters are repeats:
    with one or every doubled letter undone, and the best reading, which is
    among those unless three or more are doubled."""
    each = [core[: x.start()] + core[x.start() + 1 :] for x in _DOUBLED.finditer(core)]
    found = {*each, _DOUBLED.sub(r"\1", core)}
    if len(each) > 2:
        found.add(model.restore(core).strip(_EDGES))
    return sorted(found - {core})


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys in order (sorted in place: faster here than by hashes)."""
    keys.sort()
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


class FeatureCounts(dict):
    """Clean and toxic texts that each feature is in, the empty one for all
    texts; the dictionary has the number of each word met (raw tokens)."""

    def __init__(self, chars: CharModel):
        super().__init__()
        self.chars, self.lexicon = chars, Lexicon(chars)
        self.names: dict[str, int] = {"": 0}
        self.new: list[bytes] = []
        # Numbers of the features of all words, and where those of each begin.
        self.features, self.starts = array("q"), array("q", [0])
        self.counts = np.zeros((2, 1), np.int64)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at

    def learn(self) -> None:
        """Features of the words that got a number since the last call."""
        lexicon, names = self.lexicon, self.names
        for word in self.new:
            at = lexicon.get(word)
            if at is not None and lexicon.kind(at) == PLAIN:
                found = features(lexicon.cores[at])
            else:
                found = token_features(word, self.chars, lexicon.restored)
            self.features.extend([names.setdefault(x, len(names)) for x in found])
            self.starts.append(len(self.features))
        self.new.clear()

    def add(self, texts: list[list[bytes]], toxic: list[int]) -> None:
        """Count some texts (tokens), each once for a feature."""
        texts = self.lexicon.words_of(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        words = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(texts)), np.int64, int(sizes.sum()))
        self.learn()
        text, words = np.divmod(_distinct(np.repeat(np.arange(len(texts)), sizes) * len(self) + words), max(1, len(self)))
        starts = np.frombuffer(self.starts, np.int64)
        low, sizes = starts[words], starts[words + 1] - starts[words]
        at = np.arange(sizes.sum()) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)
        n = len(self.names)
        found = np.frombuffer(self.features, np.int64)[at] if len(at) else at
        text, found = np.divmod(_distinct(np.repeat(text, sizes) * n + found), n)
        kind = np.array(toxic, np.int64)
        counts = np.bincount(kind[text] * n + found, minlength=2 * n).reshape(2, n)
        counts[:, : self.counts.shape[1]] += self.counts
        counts[:, 0] += np.bincount(kind, minlength=2)
        self.counts = counts


class Model(NamedTuple):
    chars: CharModel
    weights: dict[str, float]
    coefficients: list[float]
    known: dict[str, float]


class _Weights(dict):
    """Weight of a word, remembered by a worker; those of the lexicon's tokens
    are kept in an array by their number."""

    def __init__(self, chars: CharModel, weights: dict[str, float], known: dict[str, float], limit: int = MEMO_TOKENS):
        super().__init__()
        self.chars, self.weights, self.limit = chars, weights, limit
        self.starts = {x[:-1]: w for x, w in weights.items() if x.endswith("-") and len(x) - 1 in _STARTS}
        # Every feature of four letters or more starts with a word's first four.
        self.heads = {x[:4] for x in weights}
        self.lexicon = Lexicon(chars, known, weights.keys())
        self.by_number = array("d")

    def of_word(self, word: str) -> float:
        """The largest weight of the ``features`` of a word."""
        if word[:4] not in self.heads:
            return 0.0
        get, start = self.weights.get, self.starts.get
        if len(word) < _STARTS[0]:
            return get(word, 0.0)
        # A cut beyond the end gives the word, whose start has that name too.
        return max(get(word, 0.0), *[start(word[:k], 0.0) for k in _STARTS])

    def value(self, token: bytes) -> float:
        """The largest weight of the ``token_features`` of a token."""
        core = plain_core(token)
        if core is not None:
            return self.of_word(core)
        restored = self.lexicon.restored
        core = restored[token] if token in restored else decoded_token(token, self.chars)
        return self.of_doubled(core) if _DOUBLED.search(core) else self.of_word(core)

    def of_doubled(self, core: str) -> float:
        """The largest weight of a core with doubled letters and of its words
        without them."""
        if core[:4] not in self.heads:
            doubled = [x.start() for x in _DOUBLED.finditer(core)]
            # One letter of the fourth and fifth gone leaves the first four.
            if len(doubled) < 3 and doubled[0] > 2:
                return 0.0
        return max(self.of_word(core), *map(self.of_word, undoubled(core, self.chars)))

    def learn(self) -> None:
        """Weights of the lexicon's tokens that have none yet."""
        lexicon, done, heads = self.lexicon, len(self.by_number), self.heads
        kinds = np.frombuffer(lexicon.of, np.int32).reshape(-1, _COLUMNS)[done:, 10].tolist()
        cores = lexicon.cores[done:]
        values = [self.of_word(x) if x[:4] in heads else 0.0 for x in cores]
        for k, kind in enumerate(kinds):
            if kind == DOUBLED:
                values[k] = self.of_doubled(cores[k])
            elif kind == DECODED:
                values[k] = self.value(lexicon.raw[done + k])
        self.by_number.extend(values)

    def __missing__(self, token: bytes) -> float:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = self.value(token)
        return value

    def measured(self, texts: list[list[bytes]]) -> list[list[float]]:
        """What the logistic model sees of some texts' tokens."""
        lexicon = self.lexicon
        kept = lexicon.forget()
        if kept is not None:
            self.by_number = array("d", np.frombuffer(self.by_number)[kept].tobytes())
        ids, starts, runs = lexicon.read(texts)
        self.learn()
        weights = np.frombuffer(self.by_number)[ids] if len(ids) else np.empty(0)
        heavy = np.flatnonzero(weights)
        bounds = np.searchsorted(heavy, starts).tolist()
        rows = []
        for k, tokens in enumerate(texts):
            n = len(tokens)
            if k not in runs:
                found = weights[heavy[bounds[k] : bounds[k + 1]]].tolist()
            else:
                found, low, done = [], int(starts[k]), 0
                for start, stop, read in runs[k]:
                    found += [w for w in weights[low + done : low + start].tolist() if w]
                    found += [w for w in map(self.__getitem__, read) if w]
                    done, n = stop, n - (stop - start) + len(read)
                found += [w for w in weights[low + done : low + len(tokens)].tolist() if w]
            rows.append(_seen(found, n))
        return rows


def _seen(found: list[float], n_tokens: int) -> list[float]:
    strong = sorted(found, reverse=True)[:3]
    return [
        1.0,
        strong[0] if strong else 0.0,
        sum(strong),
        math.log1p(len(found)),
        math.log1p(100 * len(found) / max(1, n_tokens)),
        math.log1p(sum(found)),
        math.log1p(n_tokens),
    ]


def token_batches(texts: list[bytes], most: int = BATCH_TOKENS) -> Iterator[list[list[bytes]]]:
    """Tokens of the texts, as many texts at a time as hold ``most`` tokens; a
    longer text goes alone."""
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        tokens = text.lower().split()
        if held and size + len(tokens) > most:
            yield held
            held, size = [], 0
        held.append(tokens)
        size += len(tokens)
    if held:
        yield held


def measured(texts: list[bytes], weight_of: _Weights) -> list[list[float]]:
    """What the logistic model sees of each text."""
    return [row for tokens in token_batches(texts) for row in weight_of.measured(tokens)]


def _newton_sums(rows: DataFrame, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over ``rows`` (x, toxic) of slopes and curvatures at ``beta``; each
    task adds up its own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(beta)
        sums = np.zeros(size + size * size)
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(0).to_pylist())
                p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
                sums[:size] += x.T @ (batch.column(1).to_numpy() - p)
                sums[size:] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["i", "s"])

    added = rows.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = np.zeros(len(beta) + len(beta) ** 2)
    for r in added:
        sums[r.i] = r.s
    return sums[: len(beta)], sums[len(beta) :].reshape(len(beta), -1)


def _logistic(rows: DataFrame, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression of all stored ``rows`` (x, toxic) by Newton
    steps (first column: constant). Only sums leave the tasks."""
    size = len(_seen([], 0))
    beta, penalty = np.zeros(size), ridge * np.eye(size)
    penalty[0, 0] = 1e-6
    for _ in range(30):
        slope, curve = _newton_sums(rows, beta)
        step = np.linalg.solve(curve + penalty, slope - penalty @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def learned(docs: DataFrame, labels: DataFrame, chars: CharModel) -> Model | float:
    """Model from labelled ``docs`` (doc_id, text) or, without both kinds of
    labels, the share of toxic ones."""
    spark = docs.sparkSession
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    halves = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    marks = stored(marks.withColumn("half", halves), "marks")
    texts = stored(docs.join(broadcast_if_small(marks), "doc_id").select("text", "toxic", "half"), "labelled")
    # Broadcasts hold plain objects: workers may lack this package.
    logp = spark.sparkContext.broadcast(chars.logp)

    def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = FeatureCounts(CharModel(logp.value))
        for batch in batches:
            marks = iter(batch.column(1).to_pylist())
            for texts in token_batches(batch.column(0).to_pylist()):
                held.add(texts, [1 if next(marks) else 0 for _ in texts])
        names = list(held.names)
        for low in range(0, len(names) if held.counts[:, 0].any() else 0, 50_000):
            part = slice(low, low + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[part], pa.string())] + [pa.array(held.counts[k, part], pa.int64()) for k in (1, 0)],
                names=["feature", "toxic", "clean"],
            )

    counted = arrow_stage(
        texts.where("half = 0").select("text", "toxic"), count_features, "feature string, toxic long, clean long"
    )
    counted = stored(counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "odds")
    # Every text has the empty feature: it counts texts.
    sizes = counted.where("feature = ''").first()
    if sizes is None or not sizes.toxic or not sizes.clean:
        mean = marks.agg(F.avg("toxic")).first()[0]
        return float(mean or 0.0)
    odds = F.log((F.col("toxic") + 0.5) / (sizes.toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes.clean + 1.0))
    # Two standard errors off, so that chance finds carry no weight.
    odds = odds - 2 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    chosen = (
        counted.where(f"feature <> '' and toxic >= {LEAST_TEXTS}")
        .select("feature", odds.alias("odds"))
        .where(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc("odds"), "feature")
        .limit(MAX_FEATURES)
    )
    weights = {r.feature: r.odds for r in chosen.collect()}
    # Word starts end in '-', words never do.
    seen = counted.where("feature <> '' and feature not like '%-'").select("feature", (F.col("toxic") + F.col("clean")).alias("n"))
    seen = seen.where(F.col("n") >= max(LEAST_TEXTS, WORD_SHARE * (sizes.toxic + sizes.clean))).collect()
    total = sum(r.n for r in seen)
    known = {r.feature: math.log(r.n / total) for r in seen}

    key = uuid.uuid4().hex

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(f"measure {key}")
        if "weights" not in cache:
            cache["weights"] = _Weights(CharModel(logp.value), weights, known)
        weight_of = cache["weights"]
        for batch in batches:
            rows = measured(batch.column(0).to_pylist(), weight_of)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    second = arrow_stage(texts.where("half = 1").select("text", F.col("toxic").cast("int")), measure, "x array<double>, toxic int")
    second = stored(second, "measured")
    kinds = second.agg(F.count("*").alias("n"), F.min("toxic").alias("low"), F.max("toxic").alias("high")).first()
    if not kinds.n or kinds.low == kinds.high:
        return float(sizes.toxic / (sizes.toxic + sizes.clean))
    return Model(chars, weights, _logistic(second).tolist(), known)


def toxicity(docs: DataFrame, labels: DataFrame, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` (doc_id, text and any others) with the columns ``score`` and
    ``predicted``, learned from ``labels`` (doc_id, toxic). Input columns of
    these names are replaced."""
    docs = docs.drop(score, predicted)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8_or_empty("text").alias("text"))
    model = learned(texts, labels, CharModel.counted(char_counts(texts)))
    if isinstance(model, float):
        return docs.withColumns({score: F.lit(model), predicted: F.lit(int(model >= 0.5))})
    shared = docs.sparkSession.sparkContext.broadcast((model.chars.logp, model.weights, model.coefficients, model.known))
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(f"toxicity {key}")
        logp, weights, beta, known = shared.value
        if "weights" not in cache:
            cache["weights"] = _Weights(CharModel(logp), weights, known)
        weight_of = cache["weights"]
        for batch in batches:
            scores = []
            # The last column is the text as bytes, whatever the names are.
            for row in measured(batch.column(batch.num_columns - 1).to_pylist(), weight_of):
                at = sum(b * x for b, x in zip(beta, row, strict=True))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, at)))))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                ],
                names=[*batch.schema.names[:-1], score, predicted],
            )

    schema = StructType([*docs.schema, StructField(score, DoubleType()), StructField(predicted, IntegerType())])
    return arrow_stage(docs.select("*", utf8_or_empty("text").alias(f"text {key}")), run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; labels of those whose remainder by 5 is 0 are not learned."""
    labels = table(spark, sf_dir, "labels").where(crc_bucket(F.col("doc_id"), 5) != 0)
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return scored.drop("text").withColumn("held_out", crc_bucket(F.col("doc_id"), 5) == 0)
