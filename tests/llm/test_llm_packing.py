"""Packing: the placement rule against its definition, whole documents, padding."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tieout.llm import packing
from tieout.llm.common import scratch_of
from tieout.llm.tokens import tokenizer_file

DOCS = "doc_id long, text string"


def sum_of_squares(counts, window):
    return sum(n * n for h, n in enumerate(counts) if 0 < h < window)


def by_definition(counts, size, window):
    """All choices tried; the fullest of the best, a new window last."""
    best = None
    for level in range(window - size, -1, -1):
        if level and not counts[level]:
            continue
        after = list(counts)
        if level:
            after[level] -= 1
        after[level + size] += 1
        cost = sum_of_squares(after, window)
        if best is None or cost < best[0]:
            best = (cost, level)
    return best[1]


@given(st.lists(st.integers(0, 4), min_size=15, max_size=15), st.integers(1, 16))
@settings(max_examples=300, deadline=None)
def test_the_level_with_the_least_sum_of_squares_is_chosen(counts, size):
    levels = packing.Levels(16)
    levels.count[1:16] = counts
    assert levels.best(size) == by_definition([0, *counts, 0], size, 16)


def packed(lengths, window, most_open):
    packer = packing.Packer(window, most_open)
    done, most = [], 0
    for i, n in enumerate(lengths):
        ids = (np.arange(n, dtype="<u4") + i * 100_000).tobytes()
        done += packer.place(i, ids)
        most = max(most, packer.n_open)
    return done + list(packer.close()), most


@given(
    st.lists(st.integers(1, 80), max_size=120),
    st.sampled_from([4, 16, 32]),
    st.sampled_from([1, 3, 1000]),
)
@settings(max_examples=200, deadline=None)
def test_every_id_lies_in_one_piece_and_nothing_is_padded(lengths, window, most_open):
    done, most = packed(lengths, window, most_open)
    assert most <= most_open
    ids = {i: {} for i in range(len(lengths))}
    for w in done:
        assert w.fill == sum(map(len, w.pieces)) <= window and all(map(len, w.pieces))
        assert packing.padded(w.fill, window) == w.fill
        for p in w.pieces:
            assert p.doc_tokens == lengths[p.doc_id] and p.start not in ids[p.doc_id]
            ids[p.doc_id][p.start] = p.ids
    for i, n in enumerate(lengths):
        whole = b"".join(ids[i][s] for s in sorted(ids[i]))
        assert whole == (np.arange(n, dtype="<u4") + i * 100_000).tobytes()
        ends = np.cumsum([len(ids[i][s]) // 4 for s in sorted(ids[i])])
        assert sorted(ids[i]) == [0, *ends[:-1]]


def test_few_windows_stay_open_and_few_documents_are_cut():
    drawn = random.Random(5)
    lengths = [drawn.choice([drawn.randint(1, 2000), drawn.randint(100, 400)]) for _ in range(20_000)]
    done, most = packed(lengths, 2048, 4096)
    pieces = sum(len(w.pieces) for w in done)
    assert pieces - len(lengths) < 0.05 * len(lengths)
    assert most < 1000


def test_padding_counts_powers_of_two():
    assert [packing.padded(n, 2048) for n in (1, 2, 3, 64, 100, 1024, 1025, 2048)] == [
        1, 2, 2048, 64, 2048, 1024, 2048, 2048,
    ]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_file())


def whole(pieces, tokenizer, texts):
    """Pieces of documents with different ids against the library's ids."""
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert by_doc.keys() == texts.keys()
    for doc_id, parts in by_doc.items():
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [1]
        data = np.array(ids, "<u4").tobytes()
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(data[4 * p["start"] : 4 * at])
        assert at == len(ids)
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == parts[0]["n_tokens"] == parts[0]["padded"] <= 2048


def test_query_holds_all_documents(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    found = [r.asDict() for r in packing.op13_pack_sequences(spark, sf).collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    whole(found, tokenizer, texts)


def test_sequences_as_arrays(spark, tokenizer):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four " * 5000)], DOCS).coalesce(1)
    kept = scratch_of(spark).keep(packing.sequences(docs, tokenizer_file()), "sequences")
    expected = Counter(tokenizer.encode("one two three", add_special_tokens=False).ids + [1, 1])
    expected.update(tokenizer.encode("four", add_special_tokens=False).ids * 5000)
    plain = packing.token_ids(kept).collect()
    assert sum((Counter(r.ids) for r in plain), Counter()) == expected
    odd = kept.withColumn("padded", F.lit(2048)).where("n_tokens < 2048")
    for r in packing.token_ids(odd, padding=49407).collect():
        assert len(r.ids) == 2048 and r.ids[r.n_tokens :] == [49407] * (2048 - r.n_tokens)


def test_odd_rows(spark, tokenizer):
    long = "wort & zwei " * 40_000
    texts = {1: None, 2: "", 3: "  ", 4: long, 5: "same", 6: "same", None: "no id"}
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    for name in ("ids", "pieces", "sequence_id", "start", "task"):
        docs = docs.withColumn(name, F.lit("clash"))
    kept = scratch_of(spark).keep(packing.sequences(docs, tokenizer_file()), "sequences")
    whole([r.asDict() for r in packing.pieces_of(kept).collect()], tokenizer, texts)
    again = spark.createDataFrame([(7, "twice"), (7, "twice")], DOCS)
    kept = scratch_of(spark).keep(packing.sequences(again, tokenizer_file()), "sequences")
    found = packing.pieces_of(kept).collect()
    assert sorted((r.doc_id, r.start) for r in found)[:2] == [(7, 0), (7, 0)]
    assert sum(r.length for r in found) == 2 * found[0].doc_tokens
    empty = spark.createDataFrame([], DOCS)
    assert packing.sequences(empty, tokenizer_file()).count() == 0
    assert packing.pieces_of(packing.sequences(empty, tokenizer_file())).count() == 0
