"""Two tokenizers laid over the same bytes, and how common each pairing of their tokens is.

Tokenizer A (a byte-level vocabulary file) encodes a space and the text, tokenizer B (a piece model, which
adds the space itself) the text. Two tokens are linked where their byte ranges overlap. Offsets at which
tokens of both end cut a text into groups. The count of a pair of ids is the number of documents
that hold it linked, over the whole table; for every document the links are added up with the counts of
their pairs, and those links are counted whose pair is the most common one of its A id, ties included.

Counting is external, in blocks and runs:

1. A task takes its documents in blocks of ``BLOCK_BYTES``. Records of (pair, document, links) are sorted by pair,
   A first, then document, and dealt by A id to ``PARTS`` parts; a block's records of one part are a run, packed with
   zstd. Blocks and runs are written as a table, so texts are encoded once and a lost executor costs
   its own tasks only.
2. The runs' pairs, each with its documents in the block, are merged part by part through a heap of run heads, up to
   ``FAN_IN`` runs at a time, level after level. A pair in all documents is one entry a block, so no
   id or pair is hot. In the last merge all pairs of an A id come one after another, which gives its highest count.
3. The totals of a part meet the runs of ``FAN_IN`` blocks at a time and give what each document gets from
   that part; a block's parts are added up beside its documents.

A task holds one block, or the heads of ``FAN_IN`` runs, or the totals of a part: at most the pairs of ids
that can be, over ``PARTS``.

Words are encoded by the libraries once in a while only: both tokenizers always cut before a space that stands between
a character other than white space and another such character (checked for B as it is loaded), so the words between
such places are encoded on their own and remembered, up to ``REMEMBERED`` bytes of them.

Null and empty texts, and texts that the tokens of A or B do not spell byte by byte, have no tokens: zeros and ''.
Repeated rows are documents of their own and count as such; ids are passed on as they are, nulls too. An
empty table gives an empty result. Other columns are not read.
"""

import base64
import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ridelake.llm.token_counts import byte_letters
from ridelake.sources.workspace import written

BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 1 << 14
PARTS, FAN_IN, CHUNK = 64, 256, 4096
REMEMBERED = 64 << 20
WORD_STARTS = re.compile(r"(?<=\S)(?= \S)")
RUNS = "array<struct<part: int, pairs: array<binary>, records: binary>>"
FACTS = ["n_a", "n_b", "n_groups", "n_links"]
TOTALS = "part int, totals array<binary>"
PARTIAL = "part int, block long, pairs array<binary>"
SHARES = "block long, shares binary"


def read_tokenizers(spark: SparkSession, a_path: str, b_path: str) -> Broadcast:
    """The files of both tokenizers, a few MB, sent to the tasks."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return spark.sparkContext.broadcast({"a": a.read(), "b": base64.b64encode(b.read()).decode()})


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, files: dict[str, str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(files["a"])
        self._a.encode_special_tokens = True
        letter = byte_letters()
        vocabulary = json.loads(files["a"])["model"]["vocab"]
        self._a_bytes = [b""] * self._a.get_vocab_size()
        for token, number in vocabulary.items():
            self._a_bytes[number] = bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()
        self._b = SentencePieceProcessor(model_proto=base64.b64decode(files["b"]))
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._b_bytes = [
            bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode() for i, piece in enumerate(pieces)
        ]
        # A piece with a space after another character could join two words.
        self.splits = not any(re.search("[^▁]▁", piece) for piece in pieces)
        self.a_lengths = np.array([len(x) for x in self._a_bytes], dtype=np.int64)
        self.b_lengths = np.array([len(x) for x in self._b_bytes], dtype=np.int64)

    def encoded(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of words that begin with a space each: by A with it, by B without."""
        a = [found.ids for found in self._a.encode_batch_fast(words, add_special_tokens=False)]
        return a, self._b.encode([word[1:] for word in words], num_threads=1)

    def spell(self, word: str, a: list[int], b: list[int]) -> bool:
        data = word.encode()
        return b"".join(map(self._a_bytes.__getitem__, a)) == data == b"".join(map(self._b_bytes.__getitem__, b))


class _Column:
    """An array that grows."""

    def __init__(self, dtype):
        self._data, self.size = np.empty(1024, dtype=dtype), 0

    def extend(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self._data):
            self._data = np.concatenate([self._data[: self.size], np.empty(max(end, 2 * len(self._data)) - self.size, dtype=self._data.dtype)])
        self._data[self.size : end] = values
        self.size = end

    @property
    def values(self) -> np.ndarray:
        return self._data[: self.size]


class _Numbers(dict):
    """Numbers words in the order in which they are first met."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Words:
    """What a word gives: tokens, groups and links. Remembered by number."""

    def __init__(self, tokenizers: Tokenizers):
        self._tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.numbers, self.groups, self.bytes = _Numbers(), [], 0
        self.facts = {name: _Column(np.int64) for name in [*FACTS, "bad"]}
        self.pairs, self.first = _Column(np.int64), _Column(np.int64)

    def cut(self, text: str) -> list[int]:
        """The numbers of a text's words."""
        words = WORD_STARTS.split(" " + text) if self._tokenizers.splits else [" " + text]
        return list(map(self.numbers.__getitem__, words))

    def learn(self) -> None:
        """Encodes the words that have been numbered since."""
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        a, b = self._tokenizers.encoded(new)
        for i, (word, a_ids, b_ids) in enumerate(zip(new, a, b)):
            if not self._tokenizers.spell(word, a_ids, b_ids):
                a[i], b[i] = [], []
        a_count, b_count = (np.fromiter(map(len, ids), dtype=np.int64, count=len(new)) for ids in (a, b))
        a_ids, b_ids = (np.array([i for ids in every for i in ids], dtype=np.int64) for every in (a, b))
        # All new words in a row: both tokenizers end a token wherever a word ends.
        a_ends, b_ends = np.cumsum(self._tokenizers.a_lengths[a_ids]), np.cumsum(self._tokenizers.b_lengths[b_ids])
        a_starts = a_ends - self._tokenizers.a_lengths[a_ids]
        low, high = np.searchsorted(b_ends, a_starts, side="right"), np.searchsorted(b_ends, a_ends, side="left")
        links = high - low + 1
        linked = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links - low, links)
        pairs = np.repeat(a_ids, links) << 32 | b_ids[linked]
        a_word = np.repeat(np.arange(len(new)), a_count)
        per_word = np.bincount(a_word, weights=links, minlength=len(new)).astype(np.int64)
        ends, a_cuts, b_cuts = np.intersect1d(a_ends, b_ends, return_indices=True)
        group_word = a_word[a_cuts]
        per_group = np.bincount(group_word, minlength=len(new))
        self._spell_groups(a_ids, b_ids, a_cuts, b_cuts, per_group)
        found = {"n_a": a_count, "n_b": b_count, "n_groups": per_group, "n_links": per_word, "bad": a_count == 0}
        for name, values in found.items():
            self.facts[name].extend(values)
        self.first.extend(self.pairs.size + np.cumsum(per_word) - per_word)
        self.pairs.extend(pairs)
        self.bytes += sum(map(len, new)) * 4 + 100 * len(new) + 24 * len(pairs)

    def _spell_groups(self, a_ids, b_ids, a_cuts, b_cuts, per_group) -> None:
        a_names, b_names = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        spelt, i, j = [], 0, 0
        for p, q in zip((a_cuts + 1).tolist(), (b_cuts + 1).tolist()):
            spelt.append(f"{a_names[i] if p == i + 1 else ','.join(a_names[i:p])}|{b_names[j] if q == j + 1 else ','.join(b_names[j:q])}")
            i, j = p, q
        at = 0
        for count in per_group.tolist():
            self.groups.append(";".join(spelt[at : at + count]))
            at += count


def pack(values: np.ndarray) -> bytes:
    """Whole numbers of 64 bits by place of the byte, as zstd."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * size, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, size).T).view("<u8").ravel().astype(np.int64)


def _chunks(*columns: np.ndarray) -> list[bytes]:
    """Columns of a run in pieces of ``CHUNK`` rows; the first column, which rises, by its steps."""
    pieces = []
    for at in range(0, len(columns[0]), CHUNK):
        first, *others = (column[at : at + CHUNK] for column in columns)
        pieces.append(pack(np.concatenate([np.diff(first, prepend=0), *others])))
    return pieces


def _read_chunk(piece: bytes, columns: int) -> list[np.ndarray]:
    first, *others = np.split(unpack(piece), columns)
    return [np.cumsum(first), *others]


def _block_row(block: int, ids: pa.Array, texts: list[str], words: Words) -> dict:
    """A block's documents and its runs."""
    cut = [words.cut(text) if text else [] for text in texts]
    words.learn()
    size = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
    number = np.array([n for numbers in cut for n in numbers], dtype=np.int64)
    stop = np.cumsum(size)

    def per_document(name):
        along = np.concatenate([[0], np.cumsum(words.facts[name].values[number])])
        return along[stop] - along[stop - size]

    whole = per_document("bad") == 0
    facts = {name: np.where(whole, per_document(name), 0) for name in FACTS}
    digests = [
        hashlib.sha256(";".join(map(words.groups.__getitem__, numbers)).encode()).hexdigest() if good and numbers else ""
        for numbers, good in zip(cut, whole.tolist())
    ]
    document = np.repeat(np.arange(len(cut)), size)
    keep = whole[document]
    distinct, times = np.unique(document[keep] * max(1, len(words.numbers)) + number[keep], return_counts=True)
    document, number = np.divmod(distinct, max(1, len(words.numbers)))
    count, first = words.facts["n_links"].values[number], words.first.values[number]
    place = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
    pairs, which = np.unique(words.pairs.values[place], return_inverse=True)
    # Records in the order of pairs, then documents.
    record, back = np.unique(which * len(cut) + np.repeat(document, count), return_inverse=True)
    links = np.bincount(back, weights=np.repeat(times, count), minlength=len(record)).astype(np.int64)
    pair_of, document = np.divmod(record, max(1, len(cut)))
    runs, part = [], (pairs >> 32) % PARTS
    for p in np.unique(part).tolist():
        mine, own = part == p, part[pair_of] == p
        holders = np.bincount(pair_of[own], minlength=len(pairs))[mine]
        records = pack(np.concatenate([document[own], links[own]]))
        runs.append({"part": p, "pairs": _chunks(pairs[mine], holders), "records": records})
    documents = pa.StructArray.from_arrays(
        [ids, *(pa.array(facts[name]) for name in FACTS), pa.array(digests, pa.string())], names=["id", *FACTS, "groups_sha256"]
    )
    return {"block": block, "documents": documents, "runs": runs}


def _blocks(files: Broadcast, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(Tokenizers(files.value))
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts, at = batch.column(0), batch.column(1), 0
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            while at < len(sizes):
                fits = int(np.searchsorted(np.cumsum(sizes[at : at + BLOCK_ROWS]), BLOCK_BYTES, side="right"))
                end = at + max(1, fits)
                row = _block_row(block, ids.slice(at, end - at), texts.slice(at, end - at).to_pylist(), words)
                documents = pa.ListArray.from_arrays(pa.array([0, end - at], pa.int32()), row["documents"])
                columns = [pa.array([block]), documents, pa.array([row["runs"]], schema.field("runs").type)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
                at, block = end, block + 1
                if words.bytes > REMEMBERED:
                    words.clear()

    return run


def merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the runs, rising and in stretches, with their documents. A heap tells how far all runs are known."""
    heads, after, heap = {}, [0] * len(runs), []

    def load(i: int) -> None:
        if after[i] < len(runs[i]):
            heads[i] = _read_chunk(runs[i][after[i]], 2)
            after[i] += 1
            heapq.heappush(heap, (int(heads[i][0][-1]), i))
        else:
            heads.pop(i, None)

    for i in range(len(runs)):
        load(i)
    while heap:
        bound, i = heapq.heappop(heap)
        taken = []
        for j, (pairs, holders) in heads.items():
            n = int(np.searchsorted(pairs, bound, side="right"))
            if n:
                taken.append((pairs[:n], holders[:n]))
                heads[j] = [pairs[n:], holders[n:]]
        load(i)
        if taken:
            pairs, which = np.unique(np.concatenate([t[0] for t in taken]), return_inverse=True)
            yield pairs, np.bincount(which, weights=np.concatenate([t[1] for t in taken])).astype(np.int64)


def _with_best(stretches: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs with their documents and whether no other pair of the A id has more; an A id is settled once the next one begins."""
    held = (np.empty(0, dtype=np.int64),) * 2

    def settled(pairs, holders):
        starts = np.flatnonzero(np.diff(pairs >> 32, prepend=-1))
        most = np.repeat(np.maximum.reduceat(holders, starts), np.diff(np.append(starts, len(pairs))))
        return pairs, holders, (holders == most).astype(np.int64)

    for stretch in stretches:
        pairs, holders = (np.concatenate(both) for both in zip(held, stretch))
        cut = int(np.searchsorted(pairs >> 32, pairs[-1] >> 32))
        held = pairs[cut:], holders[cut:]
        if cut:
            yield settled(pairs[:cut], holders[:cut])
    if len(held[0]):
        yield settled(*held)


def _lists(table: pa.Table, name: str) -> list[list[bytes]]:
    return table.column(name).to_pylist()


def _partial(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    stretches = list(merged(_lists(table, "pairs")))
    run = _chunks(*(np.concatenate(column) for column in zip(*stretches))) if stretches else []
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "block": [key[1].as_py()], "pairs": pa.array([run], pa.list_(pa.binary()))})


def _totals(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    pieces = [piece for stretch in _with_best(merged(_lists(table, "pairs"))) for piece in _chunks(*stretch)]
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "totals": pa.array([pieces], pa.list_(pa.binary()))})


def _shares(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """What the documents of some blocks get from one part: the sum of their links' counts, and the links with the best."""
    pieces = [_read_chunk(piece, 3) for row in _lists(totals, "totals") for piece in row]
    known = [np.concatenate(column) for column in zip(*pieces)]
    blocks, shares = [], []
    for row in runs.select(["block", "pairs", "records"]).to_pylist():
        pairs, holders = (np.concatenate(column) for column in zip(*(_read_chunk(piece, 2) for piece in row["pairs"])))
        at = np.repeat(np.searchsorted(known[0], pairs), holders)
        document, links = np.split(unpack(row["records"]), 2)
        who, which = np.unique(document, return_inverse=True)
        sums = np.zeros((2, len(who)), dtype=np.int64)
        np.add.at(sums[0], which, links * known[1][at])
        np.add.at(sums[1], which, links * known[2][at])
        blocks.append(row["block"])
        shares.append(pack(np.concatenate([who, *sums])))
    return pa.table({"block": pa.array(blocks, pa.int64()), "shares": pa.array(shares, pa.binary())})


def _finished(schema: pa.Schema):
    def run(blocks: pa.Table, shares: pa.Table) -> pa.Table:
        documents = blocks.column("documents").combine_chunks().flatten()
        sums = np.zeros((2, len(documents)), dtype=np.int64)
        for share in shares.column("shares").to_pylist():
            who, counts, best = np.split(unpack(share), 3)
            sums[0][who] += counts
            sums[1][who] += best
        columns = {name: documents.field(name) for name in ["id", *FACTS, "groups_sha256"]}
        columns |= {"n_best": pa.array(sums[1]), "count_sum": pa.array(sums[0])}
        return pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def aligned(docs: DataFrame, key: str, text: str, tokenizers: Broadcast) -> DataFrame:
    """``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row."""
    document = T.StructType().add("id", docs.schema[key].dataType)
    for name in FACTS:
        document = document.add(name, "long")
    document = document.add("groups_sha256", "string")
    shape = T.StructType().add("block", "long").add("documents", T.ArrayType(document)).add("runs", T.DataType.fromDDL(RUNS))
    texts = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    blocks = written(texts.mapInArrow(_blocks(tokenizers, to_arrow_schema(shape)), shape), "alignment-blocks")
    runs = blocks.select("block", F.explode("runs").alias("run")).select("block", "run.*")
    groups = -(-blocks.count() // FAN_IN)
    group = F.pmod(F.xxhash64("block"), F.lit(max(1, groups)))
    counts, left = runs.select("part", "block", "pairs"), groups
    while left > 1:
        counts = written(counts.groupBy("part", F.pmod(F.xxhash64("block"), F.lit(left)).alias("to")).applyInArrow(_partial, PARTIAL), "alignment-runs")
        left = -(-left // FAN_IN)
    totals = written(counts.groupBy("part").applyInArrow(_totals, TOTALS), "alignment-totals")
    dealt = totals.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(max(1, groups) - 1)))).withColumn("to", F.col("to").cast("long"))
    meeting = runs.withColumn("to", group).groupBy("part", "to").cogroup(dealt.groupBy("part", "to"))
    shares = meeting.applyInArrow(_shares, SHARES)
    result = T.StructType([*document.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    both = blocks.select("block", "documents").groupBy("block").cogroup(shares.groupBy("block"))
    return both.applyInArrow(_finished(to_arrow_schema(result)), result)
