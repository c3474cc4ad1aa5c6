"""Byte-level BPE by prefix dynamic programming.

Every token of the vocabulary encodes to itself, so each byte prefix of a piece has exactly one
token that can end its encoding: the token whose left neighbour, the last token of the shorter
prefix, would not have been merged with it or with a part of it. A piece is encoded by walking these
last tokens back from its end. The table of last tokens stays valid when bytes are appended, and
after an edit only the entries behind it are made anew, until they agree with the old ones.
"""

from __future__ import annotations

import base64
import re

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from signalflow.llm.common import map_batches

# Letters and numbers younger than the Unicode version of the tokenizer, which takes them for
# symbols: fixed values, first and last code point of each range.
YOUNG_LETTERS_AND_NUMBERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
    (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)

# White space, letters and numbers below U+0250.
_SPACES = r"\t-\r \x85\xA0"
_LETTERS = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\u024F"
_NUMBERS = r"0-9\xB2\xB3\xB9\xBC-\xBE"
_BEYOND_LATIN = re.compile(r"[^\x00-\u024F]")

# Entries a worker keeps of words, prefixes and token pairs it has met while it works on a partition, of words up to
# so many characters: some 60 MB. Beyond it a table starts anew. Results don't depend on it.
KEPT_WORDS, KEPT_LENGTH = 150_000, 40
KEPT_PREFIXES = 100_000
KEPT_PAIRS = 100_000
# Pieces up to this many bytes are encoded by recursion from the end, longer ones by the table from the start.
SHORT = 120


class Vocabulary:
    """Ranks of a byte-level BPE and what its merges allow."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranked = [line.split() for line in file if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in ranked}
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.bytes_of[rank] = token
        self.longest = max(map(len, self.rank))
        young = "".join(f"{chr(a)}-{chr(b)}" for a, b in YOUNG_LETTERS_AND_NUMBERS)
        self._young = regex.compile(f"[{young}]")
        self._split = regex.compile(pattern)
        strict = pattern
        for kind in ("L", "N"):
            strict = strict.replace(rf"[^\s\p{{L}}\p{{N}}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{young}])").replace(
                rf" ?\p{{{kind}}}+", rf" ?(?:(?![{young}])\p{{{kind}}})+"
            )
        self._split_strictly = regex.compile(strict)
        # the same pattern for texts of Latin letters only, for the faster engine of the standard library
        latin = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACES}{_LETTERS}{_NUMBERS}]").replace(r"\p{L}", f"[{_LETTERS}]")
        latin = latin.replace(r"\p{N}", f"[{_NUMBERS}]").replace(r"\s", f"[{_SPACES}]").replace(r"\S", f"[^{_SPACES}]")
        self._split_latin = None if r"\p" in latin else re.compile(latin)
        self._words: dict[str, bytes] = {}
        self._prefixes: dict[bytes, bytes] = {}
        self._pairs: dict[bytes, bool] = {}
        self._packed = [i.to_bytes(4, "little") for i in range(len(self.bytes_of))]
        self._merged: dict[int, int] = {}
        self._halves = [(i, i) for i in range(len(self.bytes_of))]
        self._learn_halves()

    def _learn_halves(self) -> None:
        """The last merge of every token: the one way to cut it into two tokens that may stand together."""
        size = len(self.bytes_of)
        for token in range(size):
            whole = self.bytes_of[token]
            for cut in range(len(whole) - 1, 0, -1):
                left, right = self.rank.get(whole[:cut], size), self.rank.get(whole[cut:], size)
                if left < token and right < token and self._stands(left, right):
                    self._halves[token] = (left, right)
                    self._merged[left << 32 | right] = token
                    break

    def _stands(self, left: int, right: int) -> bool:
        """Whether the two tokens can be neighbours: no merge across their border comes before the merges inside."""
        before = len(self.bytes_of)
        while True:
            if self._merged.get(left << 32 | right, before) < before:
                return False
            inner_left, inner_right = self._halves[left][1], self._halves[right][0]
            open_left, open_right = inner_left != left, inner_right != right
            if not open_left and not open_right:
                return True
            # undo the younger of the two merges that made the border tokens
            if open_left and (left > right or not open_right):
                before, left = left, inner_left
            else:
                before, right = right + 1, inner_right

    def _remember(self, pair: bytes, left: int, right: int) -> bool:
        if len(self._pairs) >= KEPT_PAIRS:
            self._pairs.clear()
        known = self._pairs[pair] = self._stands(left, right)
        return known

    def last_token(self, piece: bytes, end: int, last: list[int]) -> int:
        """The token that ends the encoding of ``piece[:end]``; ``last`` has those of the shorter prefixes."""
        rank = self.rank
        for start in range(max(0, end - self.longest), end):
            token = rank.get(piece[start:end])
            if token is not None and (not start or self._stands(last[start], token)):
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def encode_piece(self, piece: bytes) -> bytes:
        """Packed ids of one match of the pattern."""
        if len(piece) > SHORT:
            table = PrefixTable(self)
            table.append(piece)
            return b"".join([self._packed[i] for i in table.ids()])
        if len(self._prefixes) >= KEPT_PREFIXES:
            self._prefixes.clear()
        return self._encode_prefix(piece)

    def _encode_prefix(self, piece: bytes) -> bytes:
        """Packed ids of a byte prefix: those of the prefix before its last token, and that token."""
        rank, prefixes, packed = self.rank, self._prefixes, self._packed
        token = rank.get(piece)
        if token is not None:
            return packed[token]
        for start in range(max(1, len(piece) - self.longest), len(piece)):
            token = rank.get(piece[start:])
            if token is not None:
                before = piece[:start]
                left = prefixes.get(before)
                if left is None:
                    left = prefixes[before] = self._encode_prefix(before)
                pair = left[-4:] + packed[token]
                stands = self._pairs.get(pair)
                if stands is None:
                    stands = self._remember(pair, int.from_bytes(left[-4:], "little"), token)
                if stands:
                    return left + packed[token]
        raise ValueError("the vocabulary lacks a single byte")

    def pieces(self, text: str) -> list[str]:
        if self._split_latin and not _BEYOND_LATIN.search(text):
            return self._split_latin.findall(text)
        return (self._split_strictly if self._young.search(text) else self._split).findall(text)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        known = self._words
        words = self.pieces(text)
        out = list(map(known.get, words))
        if None in out:
            for i, packed in enumerate(out):
                if packed is None:
                    word = words[i]
                    out[i] = packed = known.get(word) or self.encode_piece(word.encode())
                    if len(word) <= KEPT_LENGTH:
                        if len(known) >= KEPT_WORDS:
                            known.clear()
                        known[word] = packed
        return b"".join(out)

    def forget(self) -> None:
        """Free what was kept of the words met so far."""
        for table in (self._words, self._prefixes, self._pairs):
            table.clear()

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(packed).cast("I").tolist()))


class PrefixTable:
    """The last token of every byte prefix of one piece, kept through appends and edits."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last = [-1]

    def append(self, more: bytes) -> None:
        begin = len(self.piece)
        self.piece += more
        for end in range(begin + 1, len(self.piece) + 1):
            self.last.append(self.vocabulary.last_token(self.piece, end, self.last))

    def edit(self, at: int, removed: int, inserted: bytes) -> int:
        """Replace bytes in the middle; returns how many entries had to be made anew."""
        old, shift = self.last, len(inserted) - removed
        self.piece = self.piece[:at] + inserted + self.piece[at + removed :]
        last = old[: at + 1]
        agreed = 0
        for end in range(at + 1, len(self.piece) + 1):
            last.append(self.vocabulary.last_token(self.piece, end, last))
            behind = end > at + len(inserted)
            agreed = agreed + 1 if behind and last[end] == old[end - shift] else 0
            # a last token reaches back over at most so many entries, so from here on nothing differs
            if agreed >= self.vocabulary.longest and end - agreed >= at + len(inserted):
                last += old[end - shift + 1 :]
                break
        self.last = last
        return min(end, len(self.piece)) - at if len(self.piece) > at else 0

    def ids(self) -> list[int]:
        ids, end = [], len(self.piece)
        while end:
            ids.append(self.last[end])
            end -= len(self.vocabulary.bytes_of[self.last[end]])
        return ids[::-1]


_LOADED: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary at ``path``, loaded once in each worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Vocabulary(path, pattern)
    return _LOADED[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", round_trip: bool = False) -> DataFrame:
    """Append ``token_ids`` (little-endian unsigned 32-bit ids as binary) of every whole text.

    With ``round_trip`` also ``decoded``, the bytes the ids stand for. A NULL text has no tokens,
    as an empty one. Columns named ``token_ids`` or ``decoded`` are replaced. ``path`` must exist
    on the executors. Rows are independent: no shuffle, one split of the input in memory at a time.
    """

    def compute(batch):
        words = vocabulary(path, pattern)
        ids = [words.encode(t) if t else b"" for t in (x.as_py() for x in batch.column(text))]
        return {"token_ids": ids} | ({"decoded": [words.decode(i) for i in ids]} if round_trip else {})

    new = [StructField("token_ids", BinaryType())] + [StructField("decoded", BinaryType())] * round_trip
    return map_batches(df, compute, new, lambda: vocabulary(path, pattern).forget())


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """Append ``decoded``, the bytes of the ids; NULL ids give NULL."""

    def compute(batch):
        words = vocabulary(path, pattern)
        return {"decoded": [None if x is None else words.decode(x) for x in batch.column(ids).to_pylist()]}

    return map_batches(df, compute, [StructField("decoded", BinaryType())])


def token_digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: its number of tokens and the digests of its ids and of the decoded bytes."""
    made = encode(df.select("doc_id", "text"), path, pattern, round_trip=True)
    return made.select(
        "doc_id",
        F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
