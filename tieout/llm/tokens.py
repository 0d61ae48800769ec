"""Token ids of documents in files of packed blocks (patched frame of reference).

A file holds whole documents in ascending order of id. Its ids, 128 to a block,
are stored as differences from the block's minimum, packed at the narrowest
width that holds PERCENT of them. Differences that need more bits keep their low
bits in place; the block's exception list has their positions and high bits. An
index holds where blocks start, so any of them can be decoded alone.

Layout, little-endian, one file:
    magic "TKPF", format 1, block size, number of documents, ids, blocks,
        bytes of payload                          (4s 6I, see HEADER)
    per document: id (i64), 1 if the id is NULL (u8), number of ids (u32)
    per block: start in the payload (u32), minimum (u32), width (u8),
        number of exceptions (u8)
    payload: per block the packed low bits, exception positions (u8 each),
        exception high bits (u32 each)
    end mark "TKEND"

Texts are range-partitioned by id (ties by hash and row), encoded where they
land, and written by Spark, one file per ROWS of about IDS_PER_FILE ids; ids
are never gathered. The reader decodes file by file.

Defined cases: a NULL text is an empty one and yields the end id alone. A NULL
id sorts first. Rows that share an id stay apart, ordered by their text's hash.
An empty table writes no documents.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tieout.llm.bytefiles import read_files, write_files
from tieout.llm.common import kept_in_worker, scratch_of, table

END_ID = 1
BLOCK = 128
PERCENT = 90
IDS_PER_FILE = 2_000_000
MAGIC, END_MARK, VERSION = b"TKPF", b"TKEND", 1
HEADER = "<4s6I"
DOCUMENT = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u4")])
INDEX = np.dtype([("start", "<u4"), ("minimum", "<u4"), ("width", "u1"), ("exceptions", "u1")])

# --- blocks ---------------------------------------------------------------------------


def bit_length(values: np.ndarray) -> np.ndarray:
    """Bits needed for each value below 2**32."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def places(width: int) -> list[tuple[int, int]]:
    """Word of 64 bits and shift where each value of a block starts."""
    return [divmod(i * width, 64) for i in range(BLOCK)]


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of bytes, low bits first."""
    columns = values.T.astype(np.uint64)
    words = np.zeros((BLOCK * width // 64, len(values)), np.uint64)
    for column, (word, shift) in zip(columns, places(width)):
        words[word] |= column << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= column >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8)


def unpack(data: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").T)
    values = np.zeros((BLOCK, words.shape[1]), np.uint64)
    for i, (word, shift) in enumerate(places(width)):
        values[i] = words[word] >> np.uint64(shift)
        if shift + width > 64:
            values[i] |= words[word + 1] << np.uint64(64 - shift)
    return (values & np.uint64((1 << width) - 1)).T.astype(np.int64)


def exception_places(index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per exception, its block and where its position and its high bits are stored."""
    n = index["exceptions"].astype(np.int64)
    block = np.repeat(np.arange(len(index)), n)
    rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    packed = index["width"].astype(np.int64) * (BLOCK // 8)
    start = (index["start"].astype(np.int64) + packed)[block]
    return block, start + rank, start + n[block] + 4 * rank


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Index and payload. The last block is filled up with its last id."""
    n_blocks = -(-len(ids) // BLOCK)
    filled = np.concatenate([ids, np.repeat(ids[-1:], n_blocks * BLOCK - len(ids))])
    blocks = filled.astype(np.uint32).reshape(n_blocks, BLOCK)
    minimum = blocks.min(axis=1)
    over = blocks - minimum[:, None]
    kth = -(-BLOCK * PERCENT // 100) - 1
    width = bit_length(np.partition(over, kth, axis=1)[:, kth])
    high = (over.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    rows, columns = np.nonzero(high)
    index = np.zeros(n_blocks, INDEX)
    index["minimum"], index["width"] = minimum, width
    index["exceptions"] = np.bincount(rows, minlength=n_blocks)
    sizes = width * (BLOCK // 8) + index["exceptions"].astype(np.int64) * 5
    index["start"] = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    payload = np.zeros(sizes.sum(), np.uint8)
    for w in map(int, np.unique(width)):
        if w:
            same = np.flatnonzero(width == w)
            at = index["start"][same].astype(np.int64)[:, None] + np.arange(w * (BLOCK // 8))
            payload[at] = pack(over[same] & np.uint32((1 << w) - 1), w)
    _, positions, bits = exception_places(index)
    payload[positions] = columns
    payload[bits[:, None] + np.arange(4)] = high[rows, columns].astype("<u4")[:, None].view(np.uint8)
    return index, payload.tobytes()


def decode_blocks(index: np.ndarray, payload: bytes) -> np.ndarray:
    data = np.frombuffer(payload, np.uint8)
    values = np.zeros((len(index), BLOCK), np.int64)
    starts, width = index["start"].astype(np.int64), index["width"].astype(np.int64)
    for w in map(int, np.unique(width)):
        if w:
            same = np.flatnonzero(width == w)
            values[same] = unpack(data[starts[same][:, None] + np.arange(w * (BLOCK // 8))], w)
    block, positions, bits = exception_places(index)
    high = np.ascontiguousarray(data[bits[:, None] + np.arange(4)]).view("<u4")[:, 0]
    values[block, data[positions]] += high.astype(np.int64) << width[block]
    return (values + index["minimum"][:, None].astype(np.int64)).astype(np.uint32).reshape(-1)


# --- files ----------------------------------------------------------------------------


def to_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    documents = np.zeros(len(doc_ids), DOCUMENT)
    documents["id"] = [i or 0 for i in doc_ids]
    documents["null"] = [i is None for i in doc_ids]
    documents["n"] = counts
    index, payload = encode_blocks(ids)
    header = struct.pack(
        HEADER, MAGIC, VERSION, BLOCK, len(documents), len(ids), len(index), len(payload)
    )
    return b"".join([header, documents.tobytes(), index.tobytes(), payload])


def from_file(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Documents and ids of a file; raises if it is not one or is cut off."""
    magic, version, block, n_docs, n_ids, n_blocks, n_bytes = struct.unpack_from(HEADER, content)
    if (magic, version, block) != (MAGIC, VERSION, BLOCK):
        raise ValueError("not a token file of this format")
    at = struct.calcsize(HEADER)
    documents = np.frombuffer(content, DOCUMENT, n_docs, at)
    at += documents.nbytes
    index = np.frombuffer(content, INDEX, n_blocks, at)
    at += index.nbytes
    if content[at + n_bytes :] != END_MARK:
        raise ValueError("token file without its end mark")
    return documents, decode_blocks(index, content[at : at + n_bytes])[:n_ids]


# --- encoding -------------------------------------------------------------------------

# White space to str.split(), but not to the tokenizer.
SEPARATORS = re.compile("[\x1c-\x1f]")
SPACES = re.compile("[ \n\t\r]+")
# Letters between runs of ASCII signs. Without the apostrophe, which begins endings such
# as 's, the bar, which special tokens hold, and U+0130, the one letter here whose lower
# case is two characters.
PARTS = re.compile(
    "([!-&(-/:-@[-`{}~]*)([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@[-`{}~]*)"
)
LONGEST_KEPT = 40
WORDS_KEPT = 450_000
TEXTS_AT_ONCE = 256


class Memory(dict):
    """Ids of words, in two generations: what is not met in the younger one's time goes."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= LONGEST_KEPT:
            self[word] = ids
        return ids

    def age(self) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()


class Encoder:
    """encode() of the tokenizers library, remembering the ids of words.

    The tokenizer's own steps (composition, lower case, splitting into letters,
    digits and signs) never look across white space, so a text's ids are those
    of its words one after the other. Letters of Latin words, the bulk, skip the
    steps that cannot change them and go to the library's model directly; runs of
    signs around them are few and remembered; all other words go through the whole
    of it. That is checked against encode() when an encoder is made, on a sample of
    words, and all words take the long way should they differ.
    """

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        model = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x250) if PARTS.fullmatch(chr(c))]
        lower = {c.lower() for c in letters}
        self.translated = str.maketrans({c: as_bytes.pre_tokenize_str(c)[0][0] for c in lower})
        self.tokenize = model.tokenize
        self.words = Memory(self.word, words_kept)
        self.plain = all(
            self.word(w) == self.by_library(w)
            for w in ("The", "Straße", "Éléments", "niño", "internationalisation", "xqzvw", "ǆ", "A")
            + ("(end).", "the&&&", "<b>", "<|startoftext|>", "#tag", "C++", "e-mail", "don't", "\u00a71")
        ) and self.by_library("one, two.\tThree\n«4»\u00a0five\u2003six\x85don't") == b"".join(
            map(self.by_library, ("one,", "two.", "Three", "«4»", "five", "six", "don't"))
        )

    def by_library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def by_model(self, word: str) -> bytes:
        written = word if word.isascii() else word.translate(self.translated)
        return array("I", [t.id for t in self.tokenize(written)]).tobytes()

    def word(self, word: str) -> bytes:
        if word.islower() and word.isascii() and word.isalpha():
            return self.by_model(word)
        parts = PARTS.fullmatch(word)
        if parts is None:
            return self.by_library(word)
        before, letters, after = parts.groups()
        # Parts are words themselves, so they are remembered as such.
        lower = letters.lower()
        ids = self.by_model(lower) if lower == word else self.words[lower]
        if before:
            ids = self.words[before] + ids
        return ids + self.words[after] if after else ids

    def words_of(self, text: str) -> list[str]:
        return text.split() if SEPARATORS.search(text) is None else SPACES.split(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """All ids of each text as little-endian 32-bit integers."""
        if not self.plain:
            return [self.by_library(text) for text in texts]
        out, ids_of = [], self.words.__getitem__
        for text in texts:
            self.words.age()
            out.append(b"".join(map(ids_of, self.words_of(text))))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encoded(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """(first column, ids of the second) of each row, some rows at a time."""
        for at in range(0, len(batch), TEXTS_AT_ONCE):
            keys, texts = (column.to_pylist() for column in batch.slice(at, TEXTS_AT_ONCE).columns[:2])
            yield from zip(keys, self.encode_all(texts))


# --- on Spark -------------------------------------------------------------------------


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids_per_file: int = IDS_PER_FILE,
) -> None:
    """Encode all texts into files under `path`, in ascending order of id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["id", "hash", "row"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(f"encoder {tokenizer_path}", lambda: Encoder(tokenizer_path))
        doc_ids, counts, parts, n = [], [], [], 0

        def file() -> pa.RecordBatch:
            content = to_file(doc_ids, counts, np.frombuffer(b"".join(parts), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for doc_id, ids in encoder.encoded(batch):
                doc_ids.append(doc_id)
                counts.append(len(ids) // 4 + 1)
                parts += [ids, end]
                n += counts[-1]
                if n >= ids_per_file:
                    yield file()
                    doc_ids, counts, parts, n = [], [], [], 0
        if doc_ids:
            yield file()

    write_files(
        sorted_rows.select("id", "text").mapInArrow(encode, "content binary"), path, END_MARK
    )


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(part, file, place, doc_id, before, n_tokens, ids_crc32[, ids]) of all documents.

    `before` counts the ids of documents before it in the same file.
    """
    fields = [
        ("part", pa.int32()),
        ("file", pa.int32()),
        ("place", pa.int32()),
        ("doc_id", pa.int64()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, content in zip(*(batch.column(i) for i in range(3))):
                documents, ids = from_file(content.as_py())
                ends = np.cumsum(documents["n"].astype(np.int64))
                starts = ends - documents["n"]
                data = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(starts, ends)]
                n = len(documents)
                columns = [
                    np.full(n, part.as_py(), np.int32),
                    np.full(n, number.as_py(), np.int32),
                    np.arange(n, dtype=np.int32),
                    pa.array(documents["id"], mask=documents["null"].astype(bool)),
                    starts,
                    documents["n"].astype(np.int64),
                    np.array(crcs, np.int64),
                ]
                if with_ids:
                    offsets = np.append(starts, ends[-1:]).astype(np.int32)
                    columns.append(
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                    )
                arrays = [pa.array(c, f.type) for c, f in zip(columns[:3], schema)]
                arrays += [columns[3], *map(pa.array, columns[4:7]), *columns[7:]]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    sql = (
        "part int, file int, place int, doc_id bigint, before bigint, n_tokens bigint,"
        " ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    )
    return read_files(spark, path).mapInArrow(decode, sql)


def with_starts(decoded: DataFrame) -> DataFrame:
    """Add `start`: ids of all documents before. `decoded` is read twice, so store it."""
    # One row per file, IDS_PER_FILE ids each.
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        decoded.groupBy("part", "file")
        .agg(F.sum("n_tokens").alias("n"))
        .select("part", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        decoded.join(files, ["part", "file"])
        .withColumn("start", F.col("_before") + F.col("before"))
        .drop("_before")
    )


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the documents' tokens, read them back, and say what was read."""
    spark = docs.sparkSession
    scratch = scratch_of(spark)
    path = f"{scratch.root}/tokens"
    write_tokens(docs, path, tokenizer_path)
    read = scratch.keep(read_tokens(spark, path, with_ids=False), "read-back")
    return with_starts(read).select("doc_id", "start", "n_tokens", "ids_crc32")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_token_files(spark, sf_dir):
    """Tokens of all documents, as read back from their files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, tokenizer_file())
