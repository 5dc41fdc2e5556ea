"""Packing documents into fixed windows by sum-of-squares placement.

A partition is one packer. Whole windows are cut from long documents at once; what is
left of a document is an item smaller than a window. An item of size s goes to the
fill level h (0 opens a window) that keeps the sum of N(h)^2 smallest, where N counts
the partially filled windows at each level: moving one window from level h to h + s
changes the sum by 2 (N(h+s) - N(h)) + 2, and a window that becomes full leaves it.
When the partition ends, the partly filled windows are dissolved from the emptiest on
and their pieces, cut where needed, fill the fullest ones. What then remains of the
last one is cut at powers of two, which need no padding, so a partition has no padding
at all. Open windows are at most a few for each level, so memory does not follow the
input.
"""

from __future__ import annotations

import base64
import collections
import functools
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

WINDOW = 1024
END = 0
#: How byte-level BPE splits a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A text with so many blanks in a row is left to the tokenizer.
BLANKS = 10_000
#: Pieces written together.
CHUNK = 4096

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Coder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    ``tokenizer`` is a tokenizer's JSON file, used with its own settings and without the
    special tokens it may put around a text; one that a text holds is its one id.
    ``ranks``, if given, is the same byte-level vocabulary as ranks with the pattern that
    splits texts; its encoder gives the same ids about four times as fast. It does not
    know added tokens, and its pattern overflows on about a million blanks in a row, so
    texts with either are left to the tokenizer.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str = PATTERN):
        coder = Tokenizer.from_file(tokenizer)
        self.ids = self.exact = lambda text: coder.encode(text, add_special_tokens=False).ids
        if ranks:
            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            added = [x.content for x in coder.get_added_tokens_decoder().values()]
            blank = re.compile(rf"\s{{{BLANKS}}}")

            def ids(text):
                if any(x in text for x in added) or len(text) >= BLANKS and blank.search(text):
                    return self.exact(text)
                return fast.encode_ordinary(text)

            self.ids = ids

    def encode(self, text: str) -> bytes:
        return np.array(self.ids(text), dtype="<u4").tobytes()


@functools.lru_cache(maxsize=2)
def _coder(tokenizer: str, ranks: str | None) -> Coder:
    return Coder(tokenizer, ranks)


class Packer:
    """Sum-of-squares placement into windows; pieces are (document, start, ids)."""

    def __init__(self, emit: Callable[[list], None], window: int = WINDOW):
        self.emit = emit
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)  # the level array
        self.open: list[list] = [[] for _ in range(window + 1)]

    def add(self, document, raw: bytes) -> None:
        size = 4 * self.window
        whole = len(raw) // size
        for k in range(whole):
            self.emit([(document, k * self.window, raw[k * size : (k + 1) * size])])
        if rest := raw[whole * size :]:
            self.place((document, whole * self.window, rest))

    def place(self, piece) -> None:
        s = len(piece[2]) // 4
        levels = self.window - s
        before, after = self.count[: levels + 1], self.count[s : self.window + 1]
        change = 2 * (after - before) + 2
        change[0] = 2 * self.count[s] + 1  # a new window
        change[levels] = 1 - 2 * self.count[levels]  # a full one leaves the sum
        allowed = before > 0
        allowed[0] = True
        level = int(np.where(allowed, change, np.iinfo(np.int64).max).argmin())
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
        pieces.append(piece)
        if level + s == self.window:
            self.emit(pieces)
        else:
            self.open[level + s].append(pieces)
            self.count[level + s] += 1

    def close(self) -> None:
        """Fill the fullest open windows with the pieces of the emptiest."""
        queue = collections.deque(
            (level, pieces) for level in range(self.window, 0, -1) for pieces in self.open[level]
        )
        while len(queue) > 1:
            level, pieces = queue.popleft()
            while level < self.window and queue:
                low, donors = queue.pop()
                document, start, raw = donors.pop()
                room = 4 * (self.window - level)
                pieces.append((document, start, raw[:room]))
                moved = min(room, len(raw)) // 4
                level += moved
                if len(raw) > room:
                    donors.append((document, start + moved, raw[room:]))
                if donors:
                    queue.append((low - moved, donors))
            if level == self.window:
                self.emit(pieces)
            else:
                queue.append((level, pieces))
        for level, pieces in queue:
            for bit in range(level.bit_length() - 1, -1, -1):
                if level >> bit & 1:
                    self.emit(self.take(pieces, 1 << bit))
        self.__init__(self.emit, self.window)

    @staticmethod
    def take(pieces: list, tokens: int) -> list:
        """Remove so many tokens from the front of a list of pieces."""
        out = []
        while tokens:
            document, start, raw = pieces.pop(0)
            size = min(tokens, len(raw) // 4)
            out.append((document, start, raw[: 4 * size]))
            if len(raw) > 4 * size:
                pieces.insert(0, (document, start + size, raw[4 * size :]))
            tokens -= size
        return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    ``tokenizer`` is a tokenizer's JSON file, ``ranks`` optionally the same vocabulary
    as ranks; both are read on the executors. Each document is its ids and id 0. Null
    and empty texts are that one id. Repeated rows are packed as often as they come,
    null ids are kept, other columns are not read, an empty table gives no pieces. No
    shuffle: every partition packs its own documents, its number makes sequence ids
    unique, and a partition read again gives the same pieces.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    end = END.to_bytes(4, "little")

    def packed(batches):
        coder = _coder(tokenizer, ranks)
        sequence = TaskContext.get().partitionId() << 36
        columns: list[list] = [[] for _ in range(7)]

        def emit(pieces):
            nonlocal sequence
            offset = 0
            for (doc_id, total), start, raw in pieces:
                size = len(raw) // 4
                row = (doc_id, start, size, zlib.crc32(raw), total, sequence, offset)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                offset += size
            sequence += 1

        def flushed():
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
            for column in columns:
                column.clear()
            return out

        packer = Packer(emit, window)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                raw = coder.encode(text.as_py() or "") + end
                packer.add((doc_id.as_py(), len(raw) // 4), raw)
                if len(columns[0]) >= CHUNK:
                    yield flushed()
        packer.close()
        yield flushed()

    return rows.mapInArrow(packed, SCHEMA)
