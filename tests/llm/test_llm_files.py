"""Token files and WARC archives: round trips, broken files, odd rows."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tieout.llm import bytefiles, tokens, warc
from tieout.llm.common import scratch_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.tokenizer_file())


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.tokenizer_file())


def direct(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, dtype="<u4").tobytes()


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=600), st.integers(1, 32))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip(values, bits):
    ids = np.array(values, dtype=np.uint32)
    ids[len(ids) // 8 :] &= np.uint32((1 << bits) - 1)
    index, payload = tokens.encode_blocks(ids)
    assert (tokens.decode_blocks(index, payload)[: len(ids)] == ids).all()


@pytest.mark.parametrize("width", range(1, 33))
def test_packing_round_trip(width):
    values = np.random.default_rng(width).integers(0, 1 << width, (3, tokens.BLOCK), dtype=np.uint64)
    assert (tokens.unpack(tokens.pack(values, width), width) == values.astype(np.int64)).all()


def test_outliers_become_exceptions():
    ids = np.full(tokens.BLOCK, 1000, dtype=np.uint32)
    ids[5], ids[70] = 1001, 49_000
    index, payload = tokens.encode_blocks(ids)
    assert index["minimum"][0] == 1000 and index["width"][0] == 0 and index["exceptions"][0] == 2
    assert len(payload) == 10


def test_broken_token_files_raise():
    content = tokens.to_file([1], [3], np.array([7, 8, 1], dtype=np.uint32)) + tokens.END_MARK
    documents, ids = tokens.from_file(content)
    assert ids.tolist() == [7, 8, 1] and documents["n"].tolist() == [3]
    for broken in (content[:-1], b"XXXX" + content[4:]):
        with pytest.raises(ValueError):
            tokens.from_file(broken)


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_the_library(tokenizer, encoder, text):
    assert encoder.encode(text) == direct(tokenizer, text)


@given(st.lists(st.sampled_from("ab É 9 . , & % ' | < - \x1c \x1f \x85 \xa0 \u2003 \u0301 \n".split(" ") + [" "])))
@settings(max_examples=300, deadline=None)
def test_encoder_on_signs_and_separators(tokenizer, encoder, parts):
    assert encoder.encode("".join(parts)) == direct(tokenizer, "".join(parts))


def test_encoder_forgets_in_generations(tokenizer):
    small = tokens.Encoder(tokens.tokenizer_file(), words_kept=5)
    texts = ["one two three", "four five six one", "x" * 100 + " one", "seven one", ""] * 4
    assert small.encode_all(texts) == [direct(tokenizer, t) for t in texts]
    for text in texts:
        assert small.encode(text) == direct(tokenizer, text)
        assert len(small.words) <= 5 + 8 and "x" * 100 not in small.words
    assert tokens.Encoder.word(small, "Word.") == direct(tokenizer, "Word.") and "word" in small.words


def test_encoder_on_awkward_words(tokenizer, encoder):
    assert encoder.plain
    for text in (
        "İstanbul ǅ don't 's <|endoftext|>x <|startoftext|> ＡＢ é é a.b, x,. 12 3.4",
        " y z \x1c q ſ ŉ ÀÉ, ÿ. Ω ß ẞ.. À. ̀x", "", "  a  b ", "WORD word. Word, word", "a" * 3000,
    ):
        assert encoder.encode(text) == direct(tokenizer, text)


def check_digests(docs, tokenizer):
    """Rows of digests() against encoding in order of id, ties by any order."""
    got = sorted(tokens.digests(docs, tokens.tokenizer_file()).collect(), key=lambda r: r["start"])
    wanted = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = direct(tokenizer, r["text"]) + np.array([1], "<u4").tobytes()
        wanted[r["doc_id"], len(ids) // 4, zlib.crc32(ids)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == wanted
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    ids = [float("-inf") if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)


def test_all_documents_from_their_files(spark, tokenizer):
    check_digests(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer)


def test_odd_documents_in_files(spark, tokenizer):
    rows = [(5, None), (5, "same id"), (5, "same id"), (None, "no id"), (-3, ""), (9, "long words " * 40_000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("hash", F.lit(1)).withColumn("id", F.lit(2))
    check_digests(docs, tokenizer)
    assert tokens.digests(docs.limit(0), tokens.tokenizer_file()).count() == 0


def test_ids_come_back_from_several_files(spark, tokenizer):
    rows = [(i, f"text number {i} " * (1 + i % 5)) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    path = f"{scratch_of(spark).root}/tokens"
    tokens.write_tokens(docs, path, tokens.tokenizer_file(), ids_per_file=500)
    files = bytefiles.read_files(spark, path)
    assert files.count() > 4
    for r in tokens.read_tokens(spark, path).collect():
        ids = np.array(r["ids"], dtype="<u4").tobytes()
        assert ids == direct(tokenizer, rows[r["doc_id"]][1]) + np.array([1], "<u4").tobytes()


def test_tokenizer_is_the_shared_one():
    assert tokens.tokenizer_file() == public_tokenizers.path("word_bpe_49k.json")


# --- WARC -----------------------------------------------------------------------------


def stored(spark, rows):
    return scratch_of(spark).keep(spark.createDataFrame(rows, PAGES).repartition(3), "pages")


def sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_pages_as_read_back(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", rng.choice(["<p>é</p>", "", None, f"<b>{i}</b>", "x" * 300_000])) for i in range(60)]
    pages = stored(spark, rows)
    last = {}
    for i, _, html in rows:
        last[(html or "").encode()] = i
    for least in (0, 5):
        got = {r["page_id"]: r for r in warc.round_trip(pages, least).collect()}
        assert len(got) == len(rows)
        for i, url, html in rows:
            payload, r = (html or "").encode(), got[i]
            revisit = len(payload) >= least and last[payload] != i
            assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), sha1(payload))
            assert r["record_type"] == ("revisit" if revisit else "response")
            assert r["refers_to"] == (last[payload] if revisit else None) and r["url"] == url


def test_repeated_and_odd_pages(spark):
    rows = [(1, "a", "same")] * 4 + [(None, None, "same"), (2, "with space\r\nX-Bad: 1", "other"), (None, "n", "alone")]
    got = warc.round_trip(stored(spark, rows)).collect()
    same = [r for r in got if r["payload_bytes"] == 4]
    assert Counter(r["record_type"] for r in same) == {"response": 1, "revisit": 4}
    assert all(r["refers_to"] == 1 for r in same if r["record_type"] == "revisit")
    assert {r["page_id"] for r in same if r["record_type"] == "response"} == {1}
    assert [r["url"] for r in got if r["page_id"] == 2] == ["with%20space%0D%0AX-Bad:%201"]
    assert len({r["record_id"] for r in got}) == len(rows)
    assert warc.round_trip(scratch_of(spark).keep(spark.createDataFrame([], PAGES), "none")).count() == 0


def test_archives_are_gzip_members_of_warc_records(spark):
    path = f"{scratch_of(spark).root}/warc"
    rows = [(i, "http://h/", f"payload {i}" * 100) for i in range(20)]
    warc.write_warc(stored(spark, rows), path, bytes_per_file=500)
    files = [bytes(r["content"]) for r in bytefiles.read_files(spark, path).collect()]
    assert len(files) > 3
    assert sum(gzip.decompress(f).count(b"WARC/1.1\r\n") for f in files) == 20
    payloads = {bytes(r["payload"]) for r in warc.read_warc(spark, path).collect()}
    assert payloads == {html.encode() for _, _, html in rows}


@pytest.mark.parametrize("step", [1, 7, 1 << 16])
def test_members_at_any_step(step):
    parts = [b"", b"one", b"two" * 50_000, b"\x1f\x8b"]
    assert list(warc.members(b"".join(map(warc.gzip_member, parts)), step)) == parts


def test_broken_archives_raise():
    good = warc.record(1, "u", 7, b"payload", 7, sha1(b"payload"), False, None, None)
    assert warc.parse(good)["payload"] == b"payload"
    for bad in (good[:-1], good + b"x", good.replace(b"payload\r\n", b"pAyload\r\n"), b"junk",
                warc.record(1, "u", 7, b"payload", 7, sha1(b"else"), False, None, None)):
        with pytest.raises(warc.BrokenArchive):
            warc.parse(bad)
    member = warc.gzip_member(good)
    for bad in (member[:-4], b"no gzip", member[:-8] + bytes(8)):
        with pytest.raises(warc.BrokenArchive):
            list(warc.members(bad))
