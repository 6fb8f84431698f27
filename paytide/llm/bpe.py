"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token its encoding can end with. The token
strings are matched by a suffix automaton (Aho-Corasick over the vocabulary), which names at
every position all tokens that end there. Such a token is the last one of the prefix if the
prefix before it has an encoding and the border between that encoding's last token and this
one is one that the merge rules leave alone. Following the stored tokens back from the end
of the word gives the ids that the merge rules would give, in time linear in the word.
The words of some texts that are not known yet are encoded together: the automaton runs over
all of them, and the prefixes of one length, of all words, are decided at once.

A vocabulary file is the JSON the ``tokenizers`` library reads: byte-level alphabet, word-end
mark, merges in rank order. Its path is a parameter; the file must lie at the same place on
every executor. The vocabulary is read once per Python worker.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain
from math import inf

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .tables import map_rows

# Stands for the word-end mark; it is not in the byte alphabet.
END = "\ue000"
# Entries a worker keeps of words already encoded, and of borders already judged. Beyond it the memory is emptied, not
# the result. Several workers share an executor with its heap, so ids are kept packed and a border as one number.
WORDS_KEPT = 70_000
BORDERS_KEPT = 100_000
JOINED_AT_ONCE = 1 << 20
# Characters of the texts (a row counts as ROW_CHARS more), and words of each, that are looked up together, and bytes of
# new words that are encoded together.
TEXT_AT_ONCE = 1 << 19
ROW_CHARS = 64
WORDS_AT_ONCE = 1 << 17
NEW_AT_ONCE = 1 << 16
# Longer words are encoded alone and are not remembered.
LONG_WORD = 64
# Of many borders judged at once, 2 ** JUDGED_BITS are remembered, each at the place that its hash gives.
JUDGED_BITS = 17
HASH = np.uint64(0x9E3779B97F4A7C15)

DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS_SCHEMA = "doc_id long, ids array<int>, decoded string"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A lower-casing word tokenizer with word ends, encoded prefix by prefix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        mark = model["end_of_word_suffix"]
        ids = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # Marked by a line end, which is in no pre-token.
        self.special = {f"\n{s}": packed([i]) for s, i in special.items()}
        self.bytes = byte_alphabet()
        self.split_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

        def inner(token: str) -> str:
            return token[: -len(mark)] + END if token.endswith(mark) and token != mark else token

        # Per token id: its text, its two halves, and the rank of the merge that makes it (-1: none).
        self.size = max(*ids.values(), *special.values(), -1) + 1
        texts = [""] * self.size
        self.left, self.right, self.made = (array("i", [-1]) * self.size for _ in range(3))
        for string, i in [*ids.items(), *special.items()]:
            texts[i] = string
        self.texts = pa.array([f"{text} " for text in texts], pa.string())
        self.decimals = pa.array([f"{i} " for i in range(self.size)], pa.string())

        # A merge's rank orders creation; characters of the alphabet are there from the start.
        self.rank: dict[int, int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            token = ids[left + right]
            self.rank[ids[left] * self.size + ids[right]] = rank
            if self.made[token] < 0:
                self.left[token], self.right[token], self.made[token] = ids[left], ids[right], rank
        banned = self._unreachable()
        self.matches = ahocorasick.Automaton()
        self.lengths = [0] * self.size
        for string, i in ids.items():
            self.lengths[i] = len(inner(string))
            if i not in banned:
                self.matches.add_word(inner(string), i)
        self.matches.make_automaton()
        # The same for many words at a time; white space is in no word, so a line end can stand for the end.
        self.alphabet = "".join(self.bytes[:10] + [END] + self.bytes[11:])
        self.spans = np.array(self.lengths, np.int32)
        self.halves = np.array([self.left, self.right], np.int32)
        self.births = np.array(self.made, np.int32)
        # The last pair is beyond all others, so that a search always ends at one.
        pairs = [*sorted(self.rank.items()), (np.iinfo(np.int64).max, 0)]
        self.pairs, self.ranks = (np.array(column, kind) for column, kind in zip(zip(*pairs), (np.int64, np.int32)))
        self.judged = np.full(1 << JUDGED_BITS, -1, np.int64)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.borders: dict[int, bool] = {}

    def _fits(self, left: int, right: int, until: float = inf) -> bool:
        """Do the merge rules leave the border between two neighbouring tokens alone?

        Undo the merges of both sides from the latest to the earliest. The two tokens that
        touch the border at a time would have merged across it if their merge ranks before
        the one that took either of them away; at equal rank the one further left goes first.
        ``until`` is the rank at which the run ends.
        """
        while True:
            across = self.rank.get(left * self.size + right)
            if across is not None and across < until:
                return False
            left_made, right_made = self.made[left], self.made[right]
            if left_made > right_made:
                until, left = left_made, self.right[left]
            elif right_made >= 0:
                until, right = right_made + 1, self.left[right]
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        """:meth:`_fits` of a whole run, remembered."""
        if len(self.borders) >= BORDERS_KEPT:
            self.borders.clear()
        found = self.borders[left * self.size + right] = self._fits(left, right)
        return found

    def _unreachable(self) -> set[int]:
        """Tokens the merge rules never make, not even of their own text.

        A token needs two halves that are made before its merge comes, and that the earlier
        merges leave side by side.
        """
        out: set[int] = set()
        for token in sorted((i for i in range(self.size) if self.made[i] >= 0), key=self.made.__getitem__):
            left, right, rank = self.left[token], self.right[token], self.made[token]
            early = self.made[left] < rank and self.made[right] < rank
            if not early or left in out or right in out or not self._fits(left, right, rank):
                out.add(token)
        return out

    def word_ids(self, word: str) -> list[int]:
        """Ids of one pre-token, given in the byte alphabet."""
        string = word + END
        size = len(string)
        last = [-1] * (size + 1)
        lengths, borders, tokens = self.lengths, self.borders, self.size
        for at, token in self.matches.iter(string):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - lengths[token]
            if start:
                left = last[start]
                if left < 0:
                    continue
                fits = borders.get(left * tokens + token)
                if not (self.fits(left, token) if fits is None else fits):
                    continue
            last[end] = token
        ids = []
        while size:
            if last[size] < 0:
                raise KeyError(f"no tokens for {word!r}")
            ids.append(last[size])
            size -= lengths[last[size]]
        return ids[::-1]

    def fits_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`_fits` of whole runs, for many borders; a remembered one is a number of its key and the answer."""
        key = left.astype(np.int64) * self.size + right
        place = (key.view(np.uint64) * HASH) >> np.uint64(64 - JUDGED_BITS)
        found = self.judged[place]
        new = np.flatnonzero(found >> 1 != key)
        if len(new):
            found[new] = key[new] * 2 + self._fits_all(left[new], right[new])
            self.judged[place[new]] = found[new]
        return found & 1 == 1

    def _fits_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        fit = np.ones(len(left), bool)
        at, until = np.arange(len(left)), np.full(len(left), np.iinfo(np.int32).max, np.int32)
        while len(at):
            key = left.astype(np.int64) * self.size + right
            place = np.searchsorted(self.pairs, key)
            across = (self.pairs[place] == key) & (self.ranks[place] < until)
            fit[at[across]] = False
            left_made, right_made = self.births[left], self.births[right]
            undo = left_made > right_made
            until = np.where(undo, left_made, right_made + 1)
            left, right = np.where(undo, self.halves[1][left], left), np.where(undo, right, self.halves[0][right])
            on = ~across & (undo | (right_made >= 0))
            at, until, left, right = at[on], until[on], left[on], right[on]
        return fit

    def new_ids(self, words: list[str]) -> list[bytes]:
        """The packed ids of many pre-tokens: as :meth:`word_ids`, with the prefixes of one length at a time."""
        raw = "".join([f"{word}\n" for word in words]).encode()
        found = self.matches.iter(raw.decode("latin-1").translate(self.alphabet))
        end, token = np.fromiter(chain.from_iterable(found), np.int32).reshape(-1, 2).T
        end = end + 1
        start = end - self.spans[token]
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10).astype(np.int32) + 1
        first = np.append(np.int32(0), ends[:-1])
        begin = np.repeat(first, ends - first)[start]
        # last[i]: the last token of the prefix that ends before place i. A prefix that is a token needs no test.
        last = np.full(len(raw) + 1, -1, np.int32)
        whole = start == begin
        last[end[whole]] = token[whole]
        rest = np.flatnonzero(last[end] < 0)
        length = (end - begin)[rest]
        rest = rest[np.argsort(length, kind="stable")]
        end, start, token = end[rest], start[rest], token[rest]
        until = 0
        for many in np.bincount(length).tolist():
            here = slice(until, until := until + many)
            left = last[start[here]]
            at = np.flatnonzero(left >= 0) + here.start
            at = at[self.fits_all(left[at - here.start], token[at])]
            last[end[at]] = token[at]
        # Back from the ends of all words, a token of each at a time.
        steps, at, of = [], ends, np.arange(len(words))
        while len(of):
            tokens = last[at]
            if (tokens < 0).any():
                raise KeyError(f"no tokens for {words[of[tokens.argmin()]]!r}")
            steps.append((of, tokens))
            at = at - self.spans[tokens]
            on = at > first[of]
            at, of = at[on], of[on]
        stop = np.cumsum(np.bincount(np.concatenate([of for of, _ in steps]), minlength=len(words)))
        ids = np.empty(stop[-1], np.int32)
        for back, (of, tokens) in enumerate(steps):
            ids[stop[of] - 1 - back] = tokens
        packed_ids, places = ids.tobytes(), [0, *(4 * stop).tolist()]
        return [packed_ids[a:b] for a, b in zip(places, places[1:])]

    def learnt(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Words with their packed ids, NEW_AT_ONCE bytes of them encoded together."""
        some, size = [], 0
        for word in words:
            if len(word) > LONG_WORD:
                yield word, packed(self.word_ids("".join(map(self.bytes.__getitem__, word.encode()))))
                continue
            some.append(word)
            size += len(word.encode()) + 1
            if size >= NEW_AT_ONCE:
                yield from zip(some, self.new_ids(some))
                some, size = [], 0
        if some:
            yield from zip(some, self.new_ids(some))

    def remember(self, word: str, ids: bytes) -> None:
        if len(self.words) >= WORDS_KEPT:
            # The words before are still known for one more turn, so those in use are never computed anew all at once.
            self.older = self.words.copy()
            self.words.clear()
        if len(word) <= LONG_WORD:
            self.words[word] = ids

    def words_ids(self, words: set[str]) -> dict[str, bytes]:
        """The packed ids of pre-tokens and special tokens."""
        found, new = {}, []
        for word in words:
            ids = self.words.get(word) or self.special.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    new.append(word)
                    continue
                self.remember(word, ids)
            found[word] = ids
        for word, ids in self.learnt(new):
            found[word] = ids
            self.remember(word, ids)
        return found

    def cut(self, text: str) -> list[str]:
        """The pre-tokens and special tokens of a text, the latter marked as in ``special``."""
        parts = self.split_special.split(text) if self.split_special else [text]
        return list(chain.from_iterable([f"\n{part}"] if i % 2 else words(part) for i, part in enumerate(parts)))

    def ids_of_all(self, texts: list[str]) -> list[np.ndarray]:
        """All ids of each text."""
        cut = [self.cut(text) for text in texts]
        ids: list[list[bytes]] = [[] for _ in cut]
        for start in range(0, max(map(len, cut), default=0), WORDS_AT_ONCE):
            parts = [ws[start : start + WORDS_AT_ONCE] for ws in cut]
            found = self.words_ids(set().union(*parts)).__getitem__
            for some, part in zip(ids, parts):
                some.append(b"".join(map(found, part)))
        return [np.frombuffer(b"".join(some), dtype=np.int32) for some in ids]

    def ids(self, text: str) -> np.ndarray:
        """All ids of a text."""
        return self.ids_of_all([text])[0]

    def rows_ids(self, rows: Iterable[tuple]) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of (doc_id, text) rows, TEXT_AT_ONCE characters of them, or one row, at a time."""
        some, size = [], 0
        for row in rows:
            some.append(row)
            size += len(row[1] or "") + ROW_CHARS
            if size >= TEXT_AT_ONCE:
                yield from self._some_ids(some)
                some, size = [], 0
        yield from self._some_ids(some)

    def _some_ids(self, rows: list[tuple]) -> Iterator[tuple[int | None, np.ndarray]]:
        return zip([doc_id for doc_id, _ in rows], self.ids_of_all([text or "" for _, text in rows]))

    def forget(self) -> None:
        """Drop the words and borders known so far; those judged many at once take a fixed megabyte, which stays."""
        self.words.clear()
        self.older.clear()
        self.borders.clear()

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """Token texts joined by one space: this vocabulary comes without a decoder rule."""
        return joined(self.texts, ids).decode()


def packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def joined(strings: pa.StringArray, ids: list[int] | np.ndarray) -> bytes:
    """The strings at these places in a row, each ending with a space but the last; Arrow takes JOINED_AT_ONCE at a time."""
    parts = []
    for i in range(0, len(ids), JOINED_AT_ONCE):
        _, offsets, text = strings.take(pa.array(ids[i : i + JOINED_AT_ONCE], pa.int32())).buffers()
        parts.append(memoryview(text)[: memoryview(offsets).cast("i")[-1]])
    return b"".join(parts)[:-1]


ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
ANY_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


def words(text: str) -> list[str]:
    """Canonical form, lower case, cut into words, digits and runs of other signs.

    Lower case is taken per character: a sigma is not treated apart at the end of a word.
    """
    if text.isascii():
        return ASCII_WORD.findall(text.lower())
    return ANY_WORD.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) per document; a null text has no ids and the empty decoded text.

    Rows are independent: repeated rows, null ids and ties need no rule, an empty table gives
    an empty one, and other columns of the input are not read.
    """
    return map_rows(docs.select("doc_id", "text"), partial(_encode_rows, path=path), TOKENS_SCHEMA, at_once=200)


def _encode_rows(rows: Iterator[tuple], path: str) -> Iterator[tuple]:
    bpe = tokenizer(path)
    for doc_id, ids in bpe.rows_ids(rows):
        yield doc_id, ids, bpe.decode(ids)
    # Rows with all their ids need the room; the next task learns its words anew.
    bpe.forget()


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Digest columns of :func:`encode`, without moving the ids out of the Python worker.

    ``ids_sha256`` is over the decimal ids joined by one space, ``decoded_sha256`` over the
    decoded text in UTF-8.
    """
    return map_rows(docs.select("doc_id", "text"), partial(_digest_rows, path=path), DIGEST_SCHEMA)


def _digest_rows(rows: Iterator[tuple], path: str) -> Iterator[tuple]:
    bpe = tokenizer(path)
    for doc_id, ids in bpe.rows_ids(rows):
        decimals, decoded = joined(bpe.decimals, ids), joined(bpe.texts, ids)
        yield doc_id, len(ids), hashlib.sha256(decimals).hexdigest(), hashlib.sha256(decoded).hexdigest()
