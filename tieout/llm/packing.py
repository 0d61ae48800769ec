"""Sum-of-squares online packing of documents into sequences of a fixed window.

Documents longer than the window give full windows first. What is left of a document
is placed, in the order the documents come, by the sum-of-squares rule: with N(h) the
number of windows filled up to level h, not full yet, it goes to the level (or to a
new window) that makes the sum of all N(h)**2 least, so that no level collects
windows which nothing fits any more. N is an array of one count per level; a placement
reads it once and changes two places. Of equal levels the fuller one is taken.

Documents may be cut, and at the end that is used: windows still open are filled up
with pieces of the emptiest ones, at most one cut for each window filled, and the last one
is dealt into sequences whose lengths are powers of two. So nothing is padded.

Every task packs the documents it reads and moves none. It holds open windows only, and
fills them up in the same way whenever there are MOST_OPEN of them. Sequence ids are the
number of the task and a count.

Defined cases: a NULL text is an empty one and yields the end id alone. Rows that share
an id stay apart, each with its own pieces from 0; a NULL id stays NULL; ids are cast to
BIGINT, and a text that is no number raises. A very long text gives windows one after the
other. Ties of levels are settled as above, equal documents in the order they come. Other
columns are not read, whatever their names. An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import kept_in_worker, scratch_of, table
from tieout.llm.tokens import END_ID, Encoder, tokenizer_file

WINDOW = 2048
MOST_OPEN = 4096
SEQUENCES_AT_ONCE = 512
ID_BYTES = 4
TASK_BITS = 40  # of a sequence id, below the number of the task

PIECE = (
    "struct<doc_id: bigint, start: bigint, length: bigint, doc_tokens: bigint, offset: bigint>"
)
SEQUENCE = f"sequence_id bigint, n_tokens int, padded int, ids binary, pieces array<{PIECE}>"


@dataclass(slots=True)
class Piece:
    """Some consecutive ids of a document, as little-endian 32-bit integers."""

    doc_id: int | None
    start: int
    doc_tokens: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, at: int) -> tuple["Piece", "Piece"]:
        """The first `at` ids, and those after."""
        return (
            Piece(self.doc_id, self.start, self.doc_tokens, self.ids[: at * ID_BYTES]),
            Piece(self.doc_id, self.start + at, self.doc_tokens, self.ids[at * ID_BYTES :]),
        )


@dataclass(slots=True)
class Window:
    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece)


class Levels:
    """How many windows are filled up to each level, and where the next piece goes."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)  # N(h); empty and full are not counted

    def best(self, size: int) -> int:
        """The level whose choice leaves the least sum of squares; 0 for a new window."""
        full = self.window - size
        # Twice the change, less the same 2 everywhere, is the change of the sum.
        change = 2 * (self.count[size + 1 : self.window + 1] - self.count[1 : full + 1]) + 2
        if full:
            change[full - 1] -= 1  # a window that gets full leaves the count
            change[self.count[1 : full + 1] == 0] = np.iinfo(np.int64).max
            # Read from the fullest level down, so that it wins ties.
            level = full - int(change[::-1].argmin())
            new = 2 * self.count[size] + 1
            if self.count[level] and change[level - 1] <= new:
                return level
        return 0

    def move(self, level: int, to: int) -> None:
        if level:
            self.count[level] -= 1
        if to < self.window:
            self.count[to] += 1


class Packer:
    """Windows of one task. Every method gives the sequences that it completes."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.window, self.most_open = window, most_open
        self.levels = Levels(window)
        self.open: dict[int, list[Window]] = {}
        self.n_open = 0

    def place(self, doc_id: int | None, ids: bytes) -> Iterator[Window]:
        rest = Piece(doc_id, 0, len(ids) // ID_BYTES, ids)
        # Byte positions, not cut after cut: a very long document is copied once.
        whole = len(rest) - len(rest) % self.window
        for at in range(0, whole, self.window):
            part = ids[at * ID_BYTES : (at + self.window) * ID_BYTES]
            yield Window([Piece(doc_id, at, rest.doc_tokens, part)], self.window)
        if whole < len(rest):
            yield from self.put(rest.cut(whole)[1] if whole else rest)

    def put(self, piece: Piece) -> Iterator[Window]:
        level = self.levels.best(len(piece))
        if level:
            chosen = self.open[level].pop()
            self.n_open -= 1
        else:
            chosen = Window()
        chosen.add(piece)
        self.levels.move(level, chosen.fill)
        if chosen.fill == self.window:
            yield chosen
            return
        self.open.setdefault(chosen.fill, []).append(chosen)
        self.n_open += 1
        if self.n_open >= self.most_open:
            *filled, last = self.filled_up()
            yield from filled
            if last.fill == self.window:
                yield last
            else:
                self.open, self.n_open = {last.fill: [last]}, 1
                self.levels.move(0, last.fill)

    def filled_up(self) -> list[Window]:
        """All open windows, those with most in them filled up with pieces of the emptiest.

        All but the last are full. No window stays open.
        """
        windows = [w for level in sorted(self.open) for w in self.open[level]]
        self.open, self.n_open = {}, 0
        self.levels = Levels(self.window)
        done, emptiest = [], 0
        while emptiest < len(windows):
            fullest = windows.pop()
            while fullest.fill < self.window and emptiest < len(windows):
                donor = windows[emptiest]
                piece = donor.pieces.pop()
                donor.fill -= len(piece)
                gap = self.window - fullest.fill
                if len(piece) > gap:
                    piece, kept = piece.cut(gap)
                    donor.add(kept)
                fullest.add(piece)
                emptiest += not donor.pieces
            done.append(fullest)
        return done

    def close(self) -> Iterator[Window]:
        """What is still open: full windows, then lengths that are powers of two."""
        if not self.n_open:
            return
        *filled, last = self.filled_up()
        yield from filled
        for bit in reversed(range(last.fill.bit_length())):
            if last.fill >> bit & 1:
                part = Window()
                while part.fill < 1 << bit:
                    piece = last.pieces.pop(0)
                    if len(piece) > (1 << bit) - part.fill:
                        piece, kept = piece.cut((1 << bit) - part.fill)
                        last.pieces.insert(0, kept)
                    part.add(piece)
                last.fill -= part.fill
                yield part


def padded(fill: int, window: int) -> int:
    """Length of a sequence with its padding: a power of two stays as it is."""
    return fill if fill & (fill - 1) == 0 else window


def sequences(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """(sequence_id, n_tokens, padded, ids, pieces) of all documents.

    ids are little-endian 32-bit integers, without padding; `token_ids` makes an array
    of them. Store it before reading it twice: sequence ids follow the tasks' order.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    end = int(END_ID).to_bytes(ID_BYTES, "little")
    fields = ("doc_id", "start", "length", "doc_tokens", "offset")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(f"encoder {tokenizer_path}", lambda: Encoder(tokenizer_path))
        packer = Packer(window, most_open)
        task, made, waiting = TaskContext.get().partitionId() << TASK_BITS, 0, []

        def completed() -> Iterator[Window]:
            for batch in batches:
                for doc_id, ids in encoder.encoded(batch):
                    yield from packer.place(doc_id, ids + end)
            yield from packer.close()

        def batch_of(windows: list[Window]) -> pa.RecordBatch:
            fills = np.array([w.fill for w in windows])
            ids = [b"".join(p.ids for p in w.pieces) for w in windows]
            ends = np.concatenate([[0], np.cumsum(fills)]).astype(np.int32)
            pieces = [p for w in windows for p in w.pieces]
            lengths = np.array([len(p) for p in pieces])
            first = np.concatenate([[0], np.cumsum([len(w.pieces) for w in windows])])
            before = np.cumsum(lengths) - lengths
            offsets = before - np.repeat(ends[:-1], np.diff(first))
            columns = (
                [p.doc_id for p in pieces],
                [p.start for p in pieces],
                lengths,
                [p.doc_tokens for p in pieces],
                offsets,
            )
            parts = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(made, made + len(windows)) + task, pa.int64()),
                    pa.array(fills, pa.int32()),
                    pa.array([padded(w.fill, window) for w in windows], pa.int32()),
                    pa.array(ids, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), parts),
                ],
                ["sequence_id", "n_tokens", "padded", "ids", "pieces"],
            )

        for sequence in completed():
            waiting.append(sequence)
            if len(waiting) == SEQUENCES_AT_ONCE:
                yield batch_of(waiting)
                made, waiting = made + len(waiting), []
        if waiting:
            yield batch_of(waiting)

    return rows.mapInArrow(pack, SEQUENCE)


def token_ids(packed: DataFrame, padding: int | None = None) -> DataFrame:
    """Stored sequences with ids as array<int>, filled up with `padding` if it is given."""

    def decode(ids: pa.Array, lengths: pa.Array) -> pa.Array:
        rows = [np.frombuffer(i, "<i4") for i in ids.to_pylist()]
        if padding is not None:
            fill = [n - len(r) for r, n in zip(rows, lengths.to_pylist())]
            rows = [np.append(r, np.full(n, padding, "<i4")) for r, n in zip(rows, fill)]
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        values = np.concatenate([np.zeros(0, np.int32), *rows]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return packed.withColumn("ids", F.arrow_udf(decode, "array<int>")("ids", "padded"))


def pieces_of(packed: DataFrame) -> DataFrame:
    """A row per piece of stored sequences, with the CRC-32 of its ids."""
    names = ("doc_id", "start", "length", "doc_tokens", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, n_tokens, length, ids, pieces = batch.columns
            data = memoryview(b"".join(ids.to_pylist()))
            parts = pieces.flatten()
            owner = np.repeat(np.arange(len(batch)), pa.compute.list_value_length(pieces))
            lengths = parts.field("length").to_numpy(zero_copy_only=False)
            # Pieces fill sequences without gaps, so they lie one after the other here too.
            ends = np.cumsum(lengths) * ID_BYTES
            crcs = [zlib.crc32(data[e - n * ID_BYTES : e]) for e, n in zip(ends, lengths)]
            taken = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    *[parts.field(n) for n in names],
                    pa.array(crcs, pa.int64()),
                    *[c.take(taken) for c in (sequence, n_tokens, length)],
                ],
                [*names, "ids_crc32", "sequence_id", "n_tokens", "padded"],
            )

    return packed.select("sequence_id", "n_tokens", "padded", "ids", "pieces").mapInArrow(
        read,
        "doc_id bigint, start bigint, length bigint, doc_tokens bigint, offset bigint,"
        " ids_crc32 bigint, sequence_id bigint, n_tokens int, padded int",
    )


def op13_pack_sequences(spark, sf_dir):
    """Where every piece of every document lies in the packed sequences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = scratch_of(spark).keep(sequences(docs, tokenizer_file()), "sequences")
    return pieces_of(stored).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
        "n_tokens",
        "padded",
    )
