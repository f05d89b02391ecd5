"""Exact token counts of every prefix of a text, by dynamic programming over byte-pair encodings.

A vocabulary's rules cut a text into pieces, and a piece into tokens by merging bytes. For
a piece, one pass over its bytes finds the last token of every prefix: the one token that ends there and
that the vocabulary leaves next to the last token of the prefix before it. Two tokens are left side by
side unless a merge across their border comes first; a token at the border exists from
the merge that makes it to the merge that uses it up. The count of a prefix is then that of the
prefix before its last token, and one.

A text's table holds the tokens before every piece and, within a piece, the count at each character. The
tokens of any prefix are read from it, and the longest prefix within a budget is found in it, without
encoding anything again. Three cases where a cut changes the pieces around it are written into the table:
inside white space, inside an English ending such as 're, and inside a special token. A count within a piece
takes one byte, in a text where one is over 127 four.

Pieces seen before are remembered by a worker, up to ``REMEMBERED``; new ones are counted in sorted order, so that common
beginnings are counted once. Null texts are empty: no
bytes, no tokens. Special strings inside texts are one token each, as is the library's default. Repeated rows
get the same result, an empty table gives an empty result, and columns of any name stay as they are.
"""

import gc
import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm.batches import by_pieces

REMEMBERED = 400_000
NEVER = 1 << 30
# Fixed value: the pattern that cuts a text into pieces, as public_tokenizers.PATTERN has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Endings of two letters, of which a part is no ending.
ENDINGS = ("'re", "'ve", "'ll")
TABLE = "n_bytes long, n_chars long, n_tokens long, starts binary, before binary, within binary"


def byte_letters() -> dict[str, int]:
    """Which byte a letter of the vocabulary file stands for: printable bytes themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, and when in the order of merges each is made and used."""

    def __init__(self, text: str):
        content = json.loads(text)
        letter = byte_letters()
        as_bytes = {token: bytes(letter[c] for c in token) for token in content["model"]["vocab"] if all(c in letter for c in token)}
        self.special = [token["content"] for token in content["added_tokens"]]
        self._made: dict[bytes, int] = {bytes([b]): -1 for b in range(256)}
        self._parts: dict[bytes, tuple[bytes, bytes]] = {}
        self._merges: dict[tuple[bytes, bytes], int] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        for order, merge in enumerate(content["model"]["merges"]):
            left, right = (as_bytes[part] for part in (merge.split(" ") if isinstance(merge, str) else merge))
            self._merges.setdefault((left, right), order)
            if left + right not in self._made:
                self._made[left + right] = order
                self._parts[left + right] = (left, right)
        tokens = {bytes([b]) for b in range(256)}
        for token in sorted(self._parts, key=len):
            left, right = self._parts[token]
            if left in tokens and right in tokens and self._first_of_all(left, right):
                tokens.add(token)
        self._names = sorted(tokens)
        self._tokens = {token: number for number, token in enumerate(self._names)}
        self._longest = max(map(len, tokens))
        # By the numbers of two tokens, the left one times 65,536.
        self._beside: dict[int, bool] = {}
        self._counts: dict[str, tuple[bytes, int]] = {}
        specials = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self._specials = regex.compile(f"({specials})") if specials else None
        self._pieces = regex.compile(PATTERN)
        self._blanks = regex.compile(r"\s\s")

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int, int]]:
        """The tokens at one end of a token while it is put together: each with when it is made and used up."""
        edge = self._edges[side].get(token)
        if edge is None:
            edge, used, part = [], NEVER, token
            while True:
                made = self._made[part]
                edge.append((part, made, used))
                if made < 0:
                    break
                part, used = self._parts[part][side], made
            self._edges[side][token] = edge
        return edge

    def _stay(self, pair: int) -> bool:
        """Whether two tokens side by side stay two tokens."""
        left, right = self._names[pair >> 16], self._names[pair & 0xFFFF]
        stay, starts = True, self._edge(right, 0)
        for a, a_made, a_used in self._edge(left, 1):
            for b, b_made, b_used in starts:
                order = self._merges.get((a, b))
                # Of equal merges the one further left comes first.
                if order is not None and a_made < order < a_used and b_made < order <= b_used:
                    stay = False
        if len(self._beside) >= REMEMBERED:
            self._beside.clear()
        self._beside[pair] = stay
        return stay

    def _first_of_all(self, left: bytes, right: bytes) -> bool:
        """Whether no other merge across the border of two tokens comes before their own."""
        own = self._merges[left, right]
        for a, a_made, a_used in self._edge(left, 1):
            for b, b_made, b_used in self._edge(right, 0):
                order = self._merges.get((a, b))
                if order is not None and (a, b) != (left, right) and order < own:
                    if a_made < order < a_used and b_made < order <= b_used:
                        return False
        return True

    def _extended(self, piece: bytes, counts: list[int], last: list[int]) -> None:
        """Adds the prefixes of a piece that ``counts`` and ``last`` lack: their tokens and last tokens."""
        number_of, longest, beside = self._tokens.get, self._longest, self._beside.get
        for end in range(len(counts), len(piece) + 1):
            token = number_of(piece[:end]) if end <= longest else None
            if token is not None:
                counts.append(1)
                last.append(token << 16)
                continue
            # Only one token fits, so the order does not matter; most are short.
            for start in range(end - 1, max(0, end - longest - 1), -1):
                token = number_of(piece[start:end])
                if token is not None:
                    stay = beside(last[start] | token)
                    if stay is None:
                        stay = self._stay(last[start] | token)
                    if stay:
                        counts.append(counts[start] + 1)
                        last.append(token << 16)
                        break
            else:
                raise ValueError(f"no token ends the prefix of {end} bytes of a piece of {len(piece)}")

    def learn(self, pieces: set[str]) -> None:
        """Counts the prefixes of new pieces; taken in order, pieces share the work on common beginnings."""
        new = pieces.difference(self._counts)
        if len(self._counts) + len(new) > REMEMBERED:
            self._counts.clear()
            new = pieces
        before, counts, last = b"", [0], [0]
        for data, piece in sorted((piece.encode("utf-8", "surrogatepass"), piece) for piece in new):
            shared = 0
            for one, two in zip(before, data):
                if one != two:
                    break
                shared += 1
            del counts[shared + 1 :], last[shared + 1 :]
            self._extended(data, counts, last)
            before = data
            found = counts[1:]
            if len(data) != len(piece):
                found = [n for i, n in enumerate(found, 1) if i == len(data) or data[i] & 0xC0 != 0x80]
            if piece in ENDINGS:
                # A cut after the first letter leaves a mark and a letter.
                found[1] = self.count("'") + self.count(piece[1])
            self._counts[piece] = (_numbers(found), found[-1])

    def count(self, text: str) -> int:
        """Tokens of a text without special strings."""
        total = 0
        for piece in self._pieces.findall(text):
            if piece not in self._counts:
                self.learn({piece})
            total += self._counts[piece][1]
        return total

    def tables(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, bytes]]:
        """For every text: tokens in all, where pieces start, tokens before each, tokens of prefixes since their piece began."""
        parts = [self._specials.split(text) if self._specials else [text] for text in texts]
        split = [[self._pieces.findall(part) for part in each[::2]] for each in parts]
        self.learn(set(chain.from_iterable(chain.from_iterable(split))))
        known = [[[*map(self._counts.__getitem__, pieces)] for pieces in each] for each in split]
        for each, pieces, counts in zip(parts, split, known):
            yield self._table(each, pieces, counts)

    def _table(
        self, parts: list[str], split: list[list[str]], known: list[list[tuple[bytes, int]]]
    ) -> tuple[int, np.ndarray, np.ndarray, bytes]:
        lengths, tokens, within = [], [], []
        for number, (pieces, counts) in enumerate(zip(split, known)):
            if number:
                # A part of a special string is plain text that follows the last piece.
                special, ended = parts[2 * number - 1], split[number - 1][-1] if split[number - 1] else ""
                alone = self.count(ended)
                cut = [self.count(ended + special[:i]) - alone for i in range(1, len(special))]
                lengths.append(len(special))
                tokens.append(1)
                within.append(_numbers([*cut, 1]))
            if not pieces:
                continue
            if self._blanks.search(parts[2 * number]):
                for i, (one, two) in enumerate(zip(pieces, pieces[1:]), 1):
                    if one.isspace() and two[0].isspace():
                        # Cut after the first character of this piece, the text ends in one run of white space.
                        first = self.count(one + two[0]) - self.count(one)
                        counts[i] = (_numbers([first, *_read(counts[i][0], len(two))[1:].tolist()]), counts[i][1])
            each, totals = zip(*counts)
            lengths += map(len, pieces)
            tokens += totals
            within += each
        lengths = np.fromiter(lengths, dtype=np.int32, count=len(lengths))
        tokens = np.fromiter(tokens, dtype=np.int32, count=len(tokens))
        starts, before = np.cumsum(lengths) - lengths, np.cumsum(tokens) - tokens
        every = b"".join(within)
        if len(every) != lengths.sum():
            # Some piece needs wide numbers, so all get them.
            every = b"".join(_read(each, n).astype(np.int32).tobytes() for each, n in zip(within, lengths))
        return int(tokens.sum()), starts.astype(np.int32), before.astype(np.int32), every


def _numbers(counts: list[int]) -> bytes:
    """One byte for each number, or four where one does not fit."""
    try:
        return array("b", counts).tobytes()
    except OverflowError:
        return array("i", counts).tobytes()


def _read(numbers: bytes, count: int) -> np.ndarray:
    return np.frombuffer(numbers, dtype=np.int8 if len(numbers) == count else np.int32)


def _tabled(content: Broadcast):
    def tables(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # A worker keeps what it was sent, and with it the pieces it has met, from task to task.
        sent = content.value
        if "vocabulary" not in sent:
            sent["vocabulary"] = Vocabulary(sent["file"])
        vocabulary = sent["vocabulary"]

        def tabled(texts: list) -> pa.Array:
            columns = [[] for _ in range(6)]
            texts = [text or "" for text in texts]
            for text, (total, starts, before, within) in zip(texts, vocabulary.tables(texts)):
                size = len(text.encode("utf-8", "surrogatepass"))
                row = (size, len(text), total, starts.tobytes(), before.tobytes(), within)
                for column, value in zip(columns, row):
                    column.append(value)
            arrays = [pa.array(column, pa.int64() if i < 3 else pa.binary()) for i, column in enumerate(columns)]
            return pa.StructArray.from_arrays(arrays, names=["n_bytes", "n_chars", "n_tokens", "starts", "before", "within"])

        # Millions of small tuples and no cycles: the collector would only walk them over and over.
        gc.disable()
        try:
            yield from by_pieces(tabled)(batches)
        finally:
            gc.enable()

    return tables


def read_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A tokenizer file of a few MB, sent to the tasks."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast({"file": file.read()})


def prefix_table(text: Column, vocabulary: Broadcast) -> Column:
    """The table of a text's prefixes: a struct of ``TABLE``."""
    return F.arrow_udf(_tabled(vocabulary), TABLE)(text)


def _arrays(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, before = (np.frombuffer(row[x], dtype=np.int32) for x in ("starts", "before"))
    return starts, before, _read(row["within"], row["n_chars"])


def tokens_of_prefix(row, length: int) -> int:
    """Tokens of the first ``length`` characters, from a table's row."""
    starts, before, within = _arrays(row)
    length = min(length, len(within))
    if length <= 0:
        return 0
    return int(before[np.searchsorted(starts, length - 1, side="right") - 1]) + int(within[length - 1])


def longest_prefix(row, budget: int) -> int:
    """The most characters, from the start, that make ``budget`` tokens or fewer."""
    starts, before, within = _arrays(row)
    lengths = np.diff(np.append(starts, len(within)))
    counts = within + np.repeat(before, lengths)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def _measured(budget: int):
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for tables in batches:
            yield pa.array([longest_prefix(row, budget) for row in tables.to_pylist()], pa.int64())

    return measure


def fitting_length(table: Column, budget: int) -> Column:
    """The longest prefix within a budget, for every table of a column."""
    return F.arrow_udf(_measured(budget), "long")(table)


def counted(docs: DataFrame, text: str, vocabulary: Broadcast) -> DataFrame:
    """``row`` (the whole input row) and the ``table`` of its text."""
    return docs.select(F.struct("*").alias("row"), prefix_table(F.col(text), vocabulary).alias("table"))
