"""Benchmark decontamination with one Aho-Corasick automaton over test items.

Texts are normalised to words: A-Z in lower case, runs of ASCII letters, digits
and all other code points from U+0080. Every run of WINDOW words of an item, or
the whole of a shorter item, is a pattern. The automaton reads words, not
characters: each task builds it once from the broadcast items and scans every
document once. Words inside an occurrence are hit; offsets lead back to the
original text.

Items are gathered in blocks of about MAX_BLOCK_WORDS words, so a broadcast and
an automaton have a bounded size; a benchmark larger than that is scanned block
after block in the same pass over the documents. Documents are never shuffled.

Defined cases: a NULL or empty text has no words; an item without words has no
window; a NULL item id counts as 'null'; rows sharing an item id are one item.
Repeated documents each get their row. An empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import one_row, table

WINDOW = 10
MAX_BLOCK_WORDS = 1_000_000
# On UTF-8 bytes: ASCII punctuation, white space and controls separate words.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SPAN = "struct<first: int, last: int, start: int, end: int>"
FOUND = f"struct<n_words: bigint, spans: array<{SPAN}>, items: array<string>>"


def words_of(text: bytes | None) -> list[bytes]:
    # bytes.lower() changes A-Z and nothing else.
    return WORD.findall(text.lower()) if text else []


class Windows:
    """The automaton over the windows of some items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = tuple(
                self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)
            )
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                owners.setdefault(ids[i : i + size], set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, ids in owners.items():
            self.automaton.add_word(key, (len(key), frozenset(ids)))
        self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges (first, last) of all occurrences, merged, and their items."""
        ranges, items = [], set()
        if not self.empty and words:
            number = self.numbers.get
            for last, (size, owners) in self.automaton.iter(tuple([number(w, 0) for w in words])):
                ranges.append((last - size + 1, last))
                items |= owners
        return merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def with_offsets(text: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges with code point offsets in the original text, end exclusive."""
    if not ranges:
        return []
    at = [(m.start(), m.end()) for m in WORD.finditer(text.lower())]
    spans, done, points = [], 0, 0
    for first, last in ranges:
        start, end = at[first][0], at[last][1]
        points += len(text[done:start].decode("utf-8", "replace"))
        length = len(text[start:end].decode("utf-8", "replace"))
        spans.append({"first": first, "last": last, "start": points, "end": points + length})
        points, done = points + length, end
    return spans


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """Lists of (item, text), each small enough for one automaton."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
        F.col(text_col).cast("binary").alias("text"),
    ).where(F.col(text_col).isNotNull())
    # A word has a byte and a separator at least.
    bytes_in = one_row(items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")))
    blocks = bytes_in["n"] // (2 * block_words) + 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for k in range(blocks):
        yield [(r["item"], bytes(r["text"])) for r in items.where(block == k).distinct().collect()]


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = MAX_BLOCK_WORDS,
    name: str = "found",
) -> DataFrame:
    """Add `name`: number of words, hit ranges with offsets, and items that occur."""
    spark = docs.sparkSession

    def scanner(items: list[tuple[str, bytes]]):
        shared = spark.sparkContext.broadcast(items)

        @F.pandas_udf(FOUND)
        def scan(
            batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]],
        ) -> Iterator[pd.DataFrame]:
            windows = Windows(shared.value, window)
            for texts, edges_before, items_before in batches:
                n_words, spans, found = [], [], []
                for text, edges, known in zip(texts, edges_before, items_before):
                    text = text or b""
                    words = words_of(text)
                    ranges, items = windows.scan(words)
                    if known is not None:
                        ranges = merged([*ranges, *zip(map(int, edges[::2]), map(int, edges[1::2]))])
                        items |= set(known)
                    n_words.append(len(words))
                    spans.append(with_offsets(text, ranges))
                    found.append(sorted(items))
                yield pd.DataFrame({"n_words": n_words, "spans": spans, "items": found})

        return scan

    edges = F.lit(None).cast("array<int>")
    known = F.lit(None).cast("array<string>")
    for items in item_blocks(benchmark, item_col, item_text_col, block_words):
        docs = docs.withColumn(name, scanner(items)(F.col(text_col).cast("binary"), edges, known))
        ranges = F.transform(F.col(f"{name}.spans"), lambda s: F.array(s["first"], s["last"]))
        edges, known = F.flatten(ranges), F.col(f"{name}.items")
    return docs


def n_hit(found):
    return F.aggregate(
        found["spans"],
        F.lit(0).cast("bigint"),
        lambda n, span: n + (span["last"] - span["first"] + 1).cast("bigint"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents in which no item occurs."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    found = occurrences(rows, benchmark, **settings)
    return found.where(F.size("found.items") == 0).select("row.*")


def op9_decontaminate(spark, sf_dir):
    """How much of every document is taken from the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = occurrences(docs, table(spark, sf_dir, "benchmark"))
    hit = n_hit(F.col("found"))
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
ORACLE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_WORDS_SQL} AS words FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, {_WORDS_SQL} AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT item_id, words, least({WINDOW}, len(words)) AS size,
               unnest(range(1, len(words) - least({WINDOW}, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0)
), places AS (
  SELECT row_id, size, words, unnest(range(1, CAST(len(words) - size + 2 AS BIGINT))) AS i
  FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size
), hits AS (
  SELECT row_id, p.size, i, item_id
  FROM places p JOIN windows w ON p.size = w.size
   AND array_to_string(words[i:i + p.size - 1], ' ') = w.win
), hit_words AS (
  SELECT row_id, count(DISTINCT word) AS n_hit
  FROM (SELECT row_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY row_id
), hit_items AS (
  SELECT row_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
  FROM hits GROUP BY row_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (row_id) LEFT JOIN hit_items USING (row_id)
"""
