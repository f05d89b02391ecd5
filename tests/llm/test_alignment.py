"""Two tokenizers laid over each other, against the libraries and counting by hand."""

import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from llm.tables import documents, prose
from ridelake.llm import alignment
from ridelake.llm.queries import PIECES, TOKENIZER

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(TOKENIZER)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    names = {i: token for token, i in json.load(open(TOKENIZER, encoding="utf-8"))["model"]["vocab"].items()}
    b = SentencePieceProcessor(model_file=PIECES)

    def spans(text):
        if not text:
            return None
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_bytes = [bytes(letters[c] for c in names[i]) for i in a_ids]
        pieces = [b.id_to_piece(i) for i in b_ids]
        b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        return [list(zip(ids, np.cumsum([0, *map(len, x)]).tolist(), np.cumsum([*map(len, x)]).tolist())) for ids, x in ((a_ids, a_bytes), (b_ids, b_bytes))]

    return spans


def by_hand(spans, texts):
    facts, counts = [], Counter()
    for text in texts:
        both = spans(text)
        if not both:
            facts.append(None)
            continue
        a, b = both
        links = Counter((i, j) for i, s, e in a for j, t, f in b if s < f and t < e)
        ends, last, groups = sorted({e for *_, e in a} & {f for *_, f in b}), 0, []
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in x if last <= s and e <= end) for x in both))
            last = end
        facts.append((len(a), len(b), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(links.keys())
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [
        (f[0], f[1], f[2], sum(f[3].values()), f[4], sum(n for p, n in f[3].items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in f[3].items()))
        if f
        else (0, 0, 0, 0, "", 0, 0)
        for f in facts
    ]


TEXTS = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "\n", "a\n b\n\n c", "tab\there", "x▁y", "▁", "\x00", "a　b\xa0c\x85d e", "don't we'll 'tis",
    "<|endoftext|> <s> </s> <unk>", "日本語のテキスト", "naïve café é", "😀😀 👩‍👩‍👧", "1234567 89", "ends with space ", "aaaa" * 50, "Ã Â" * 40, "\x1c \x1d y",
    "ﬁ Å①", "a" * 700, "same text twice", "same text twice", "x" + " " * 40 + "y", "﻿ bom", "a​b   c",
]


def result(spark, texts):
    frame = documents(spark, texts)
    rows = alignment.aligned(frame, "doc_id", "text", alignment.read_tokenizers(spark, TOKENIZER, PIECES)).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(texts)))
    return [tuple(r[c] for c in COLUMNS) for r in sorted(rows, key=lambda r: r["id"])]


def test_awkward_texts_as_by_hand(spark, libraries):
    found = result(spark, TEXTS)
    assert found == by_hand(libraries, TEXTS)
    assert found[11] == found[0] == (0, 0, 0, 0, "", 0, 0) and found[4][0] > 0


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_BYTES": 300, "FAN_IN": 3, "CHUNK": 5}, {"BLOCK_ROWS": 1, "FAN_IN": 2, "REMEMBERED": 1, "PARTS": 3}])
def test_blocks_levels_and_parts_change_nothing(spark, libraries, monkeypatch, sizes):
    texts = TEXTS + prose(40, 25, vocabulary=80) + prose(10, 25, vocabulary=80)
    expected = by_hand(libraries, texts)
    for name, value in sizes.items():
        monkeypatch.setattr(alignment, name, value)
    assert result(spark, texts) == expected


def test_nulls_repeats_and_an_empty_table(spark, libraries):
    frame = documents(spark, ["one two", "one two", None], [None, None, 3])
    tokenizers = alignment.read_tokenizers(spark, TOKENIZER, PIECES)
    rows = alignment.aligned(frame, "doc_id", "text", tokenizers).collect()
    one, *_, none = by_hand(libraries, ["one two", "one two", None])
    assert Counter((r["id"], *(r[c] for c in COLUMNS)) for r in rows) == Counter([(None, *one), (None, *one), (3, *none)])
    assert not alignment.aligned(frame.limit(0), "doc_id", "text", tokenizers).collect()


def test_runs_are_merged_in_order():
    rng = np.random.default_rng(1)
    runs, expected = [], Counter()
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 500, rng.integers(1, 300))) | rng.integers(0, 3) << 32
        holders = rng.integers(1, 9, len(pairs))
        expected.update(dict(zip(pairs.tolist(), holders.tolist())))
        runs.append([alignment.pack(np.concatenate([np.diff(pairs[i : i + 7], prepend=0), holders[i : i + 7]])) for i in range(0, len(pairs), 7)])
    stretches = list(alignment.merged([*runs, []]))
    pairs = np.concatenate([s[0] for s in stretches]).tolist()
    assert pairs == sorted(expected) and len(stretches) > 9
    assert dict(zip(pairs, np.concatenate([s[1] for s in stretches]).tolist())) == expected


def test_packing_keeps_values():
    for values in ([], [0], [-1, 2**62, -(2**63)], list(range(1000))):
        assert alignment.unpack(alignment.pack(np.array(values, dtype=np.int64))).tolist() == values


def test_words_are_cut_where_both_tokenizers_cut():
    files = {"a": open(TOKENIZER, encoding="utf-8").read(), "b": __import__("base64").b64encode(open(PIECES, "rb").read()).decode()}
    known = alignment.Tokenizers(files)
    assert known.splits and public_tokenizers.path("piece_bpe_32k.model") == PIECES
    for text in filter(None, TEXTS):
        words = alignment.WORD_STARTS.split(" " + text)
        a, b = known.encoded(words)
        whole = known.encoded([" " + text])
        assert (sum(a, []), sum(b, [])) == (whole[0][0], whole[1][0])
