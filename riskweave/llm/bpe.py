"""Byte-level BPE by dynamic programming over prefixes.

The encoding of every prefix of a piece ends in exactly one token, and that token does not
depend on what follows. A table of these last tokens is therefore enough: walking it
backwards gives the encoding, an append only adds entries, and after an edit entries are
recomputed only until they agree with the old ones again.

A token may follow another if the two, merged together from bytes, come out as these two.
Only the seam matters: the tokens that form along the right edge of the first and along
the left edge of the second, in order of rank, must never merge across it earlier than
they merge inwards.

Null and empty texts encode to no tokens. Pieces of any length work; time grows with
length times the longest token. Equal texts give equal rows.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cached_property, lru_cache
from itertools import chain

import ahocorasick
import regex
from pyspark.sql import DataFrame

from riskweave.llm.common import map_rows

# Stretches whose encoding one worker remembers at most, the half of them that was not asked
# for lately goes first.
MEMO_CHUNKS = 240_000
# Byte prefixes whose last token one worker remembers at most; then it starts anew.
MEMO_PREFIXES = 400_000
# The same for pairs of tokens that fit and for the tokens that end a prefix.
MEMO_PAIRS = 250_000
# Pieces of more bytes than this are encoded without leaving prefixes behind.
LONGEST_SHARED = 64
NEVER = 1 << 62


class Vocabulary:
    """Ranks of byte strings, read from lines of base64 token and rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank)
                          for token, rank in (line.split() for line in lines if line.strip())}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, self.ranks))
        self.find_pieces = regex.compile(pattern).findall
        self.usable: dict[bytes, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for token, rank in self.ranks.items():
            parts = self._merged(token, rank)
            if len(parts) <= 2:  # else no merge ever forms it
                self.usable[token] = rank
                if len(parts) == 2:
                    self.halves[rank] = (parts[0], parts[1])
        self._right: dict[int, tuple[int, ...]] = {}
        self._left: dict[int, tuple[int, ...]] = {}
        self.sizes = [len(t) for t in self.tokens]
        self.known_fits: dict[tuple[int, int], bool] = {}
        self.names = [str(rank) for rank in range(len(self.tokens))]
        self._prefixes = Prefixes(self)
        self._spaced = SpacedChunks(self)

    @cached_property
    def endings(self) -> ahocorasick.Automaton:
        """Finds all tokens that end at each byte, longest first."""
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.usable.items():
            found.add_word(token.decode("latin-1"), rank)
        found.make_automaton()
        return found

    def _merged(self, token: bytes, below: int) -> list[int]:
        """Parts of the token after all merges of a lower rank."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, NEVER), i)
                           for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _edge(self, rank: int, side: int) -> tuple[int, ...]:
        """Tokens that form along one edge of a token, from its outermost byte upwards."""
        known = self._right if side else self._left
        if rank not in known:
            inner = self.halves.get(rank)
            known[rank] = (*self._edge(inner[side], side), rank) if inner else (rank,)
        return known[rank]

    def fits(self, first: int, second: int) -> bool:
        """Whether the encoding of both tokens' bytes is just these two tokens."""
        known = self.known_fits.get((first, second))
        if known is None:
            if len(self.known_fits) > MEMO_PAIRS:
                self.known_fits.clear()
            known = self.known_fits[first, second] = self._seam_holds(first, second)
        return known

    def _seam_holds(self, first: int, second: int) -> bool:
        left, right = self._edge(first, 1), self._edge(second, 0)
        i = j = 0
        while True:
            grow_left = left[i + 1] if i + 1 < len(left) else NEVER
            grow_right = right[j + 1] if j + 1 < len(right) else NEVER
            across = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]], NEVER)
            # Of equal ranks the leftmost pair merges first.
            if across < grow_left and across <= grow_right:
                return False
            if grow_left == grow_right == NEVER:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def encode(self, text: str) -> list[int]:
        return [int(token) for _, written, _ in self._chunks(text) for token in written.split()]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Token count, hash of the ids as text, hash of the bytes decoded from the ids."""
        counts, written, decoded = zip(*self._chunks(text)) if text else ((), (), ())
        return (sum(counts), hashlib.sha256(" ".join(written).encode()).hexdigest(),
                hashlib.sha256(b"".join(decoded)).hexdigest())

    def _chunks(self, text: str) -> list[tuple[int, str, bytes]]:
        """Encodings of the stretches between single spaces, each remembered.

        A single space between two other characters always begins a match, so the matches
        of a stretch, with its space, do not depend on its surroundings. Where white space
        is longer, or at the end of the text, the whole text is matched at once.
        """
        if not text:
            return []
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return [self._chunk(text)]
        try:
            return [self._chunk(first), *map(self._spaced.__getitem__, rest)]
        except Inseparable:
            return [self._chunk(text)]

    def _chunk(self, text: str) -> tuple[int, str, bytes]:
        """Number of ids, the ids as text, and the bytes that they decode to."""
        pieces = self.find_pieces(text)
        ids = (self._piece(pieces[0]) if len(pieces) == 1
               else list(chain.from_iterable(map(self._piece, pieces))))
        return len(ids), " ".join([self.names[token] for token in ids]), self.decode(ids)

    def _piece(self, piece: str) -> tuple[int, ...] | list[int]:
        data = piece.encode()
        whole = self.ranks.get(data)  # a piece that is itself a token stays one
        if whole is not None:
            return (whole,)
        if len(data) > LONGEST_SHARED:
            return PrefixTable(self, data).ids()
        return self._prefixes.ids(data)


class Prefixes:
    """Last tokens of the byte prefixes of all pieces seen, each stored once.

    A prefix's last token does not depend on what follows it, so a new piece only adds what
    lies behind its longest known prefix. Whatever is stored, its own prefixes are too.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # All that can be the beginning of a token, to follow the tokens that end at a byte.
        self.begins = {token[:i] for token in vocabulary.usable for i in range(len(token) + 1)}
        self.endings: dict[bytes, list[tuple[int, int, tuple[int, bytes]]]] = {}
        # Prefix -> its last token, and its longest end that begins a token. Entries with the
        # same two share one tuple.
        self.known: dict[bytes, tuple[int, bytes]] = {}

    def ids(self, data: bytes) -> list[int]:
        known, sizes = self.known, self.vocabulary.sizes
        found = known.get(data) or self._add(data)
        out, at = [], len(data)
        while True:
            token = found[0]
            out.append(token)
            at -= sizes[token]
            if not at:
                out.reverse()
                return out
            found = known[data[:at]]

    def _add(self, data: bytes) -> tuple[int, bytes]:
        """Entry of a new piece, after those of all its prefixes. Of the tokens that end at a
        byte exactly one fits what precedes it."""
        if len(self.known) > MEMO_PREFIXES:
            self.known.clear()
        known, fitting, at, found = self.known, self.vocabulary.known_fits, len(data), None
        while at and found is None:
            at -= 1
            found = known.get(data[:at])
        suffix = found[1] if found else b""
        for at in range(at, len(data)):
            end = suffix + data[at:at + 1]
            for size, token, entry in self.endings.get(end) or self._endings(end):
                before = at + 1 - size
                if before:
                    pair = known[data[:before]][0], token
                    fits = fitting.get(pair)
                    if fits is None:
                        fits = self.vocabulary.fits(*pair)
                    if not fits:
                        continue
                found = known[data[:at + 1]] = entry
                suffix = entry[1]
                break
            else:
                raise ValueError(f"no token for byte {data[at]}")
        return found

    def _endings(self, text: bytes) -> list[tuple[int, int, tuple[int, bytes]]]:
        """Size and rank of all tokens that are ends of ``text``, longest first, with the
        entry of a prefix that ends like that."""
        if len(self.endings) > MEMO_PAIRS:
            self.endings.clear()
        usable, suffix = self.vocabulary.usable, text
        while suffix not in self.begins:
            suffix = suffix[1:]
        ends = [(len(suffix) - i, suffix[i:]) for i in range(len(suffix)) if suffix[i:] in usable]
        self.endings[text] = found = [
            (size, usable[token], (usable[token], suffix)) for size, token in ends]
        return found


class Inseparable(ValueError):
    """A stretch whose matches may depend on what surrounds it."""


class SpacedChunks(dict):
    """Chunk without its leading space -> encoding with it."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, chunk: str):
        encoded = self.older.get(chunk)
        if encoded is None:
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                raise Inseparable
            encoded = self.vocabulary._chunk(" " + chunk)
            if len(chunk) > LONGEST_SHARED:
                return encoded
        if len(self) >= MEMO_CHUNKS // 2:
            self.older = dict(self)
            self.clear()
        self[chunk] = encoded
        return encoded


class PrefixTable:
    """Last token of every prefix of one piece; grows by appends, follows edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.sizes = vocabulary.sizes
        self.append(data)

    def _fill(self, settled=None) -> None:
        """Add the last tokens of all prefixes longer than those already there.

        Of the tokens that end at a byte exactly one fits what precedes it. ``settled`` is
        asked after every entry and may end the work.
        """
        last, want = self.last, len(self.last)
        sizes, known, fits = self.sizes, self.vocabulary.known_fits, self.vocabulary.fits
        begin = max(0, want - self.vocabulary.longest)
        text = self.data[begin:].decode("latin-1")
        for at, token in self.vocabulary.endings.iter(text):
            at += begin
            if at != want:
                if at < want:
                    continue
                break
            before = at - sizes[token]
            if before >= 0:
                pair = last[before], token
                if not (known[pair] if pair in known else fits(*pair)):
                    continue
            elif before < -1:
                continue
            last.append(token)
            want += 1
            if settled and settled(want, token):
                return
        if want < len(self.data):
            raise ValueError(f"no token for byte {self.data[want]}")

    def append(self, more: bytes) -> None:
        self.data += more
        self._fill()

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Edit data[start:stop]; gives the number of entries computed again."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        agreed = 0

        def settled(end: int, token: int) -> bool:
            # Entries look back over one token's length only.
            nonlocal agreed
            if end > start + len(new):
                agreed = agreed + 1 if token == old[end - shift - 1] else 0
            return agreed >= self.vocabulary.longest

        self._fill(settled)
        computed = len(self.last) - start
        self.last += old[len(self.last) - shift:]
        return computed

    def ids(self) -> list[int]:
        out, at = [], len(self.data) - 1
        while at >= 0:
            out.append(token := self.last[at])
            at -= self.sizes[token]
        return out[::-1]


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array<int>) of every text."""
    def each(doc_id, text):
        return doc_id, vocabulary(path, pattern).encode(text or "")

    return map_rows(docs.select("doc_id", "text"), each, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text of every row of ids; bytes that are not UTF-8 become U+FFFD."""
    def each(doc_id, ids):
        return doc_id, vocabulary(path, pattern).decode(ids or []).decode("utf-8", "replace")

    return map_rows(encoded.select("doc_id", "ids"), each, "doc_id bigint, text string")


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: n_tokens, ids_sha256, decoded_sha256."""
    def each(doc_id, text):
        return doc_id, *vocabulary(path, pattern).digest(text or "")

    return map_rows(docs.select("doc_id", "text"), each,
                    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
