"""Packing documents into windows of a fixed number of tokens.

Sum-of-squares online packing: with N(h) the number of open windows filled to
level h, a document's part goes to the level whose choice makes the sum of
N(h)^2 smallest; the counts are one array of levels.  Parts of whole windows
are cut off a document first, so what is placed online is its last part.  At the
end of a task the windows still open are joined and cut anew: all but the
last of these sequences are full, and the last is cut at powers of two, which
need no padding.

Each task packs its own input partition as it reads it: no shuffle, memory for
the open windows only.  A sequence id holds the partition number in its
upper bits.  A repeated task packs the same rows the same way.

Token ids are those of the library for the vocabulary file: its merges run in
the faster of the two installed byte-level encoders, from the same file (see
README); long texts are split at safe boundaries (``tokens.safe_pieces``).  A
piece with ``LONG_SPACE`` white-space characters in a row, on which that
encoder's pattern runs out of stack at some length, goes to the library.

Nulls: a null text is empty and has only the end id; ids may be null or
repeat (each row is a document).  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import default_vocabulary, safe_pieces

WINDOW = 1024
END_ID = 0
LONG_SPACE = 10_000
_ROWS_OUT = 4096
_SPACES = re.compile(r"\s{%d}" % LONG_SPACE)


def _byte_letters() -> dict[str, int]:
    """Letter -> byte in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others follow from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """Function from a text to its ids, special strings as the library treats
    them by default (a special string in a text becomes its id)."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    enc = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    @functools.cache
    def library() -> Tokenizer:
        return Tokenizer.from_file(path)

    def ids(text: str) -> list[int]:
        out: list[int] = []
        for piece in safe_pieces(text):
            if len(piece) >= LONG_SPACE and _SPACES.search(piece):
                out += library().encode(piece, add_special_tokens=False).ids
            elif any(s in piece for s in special):
                out += enc.encode(piece, allowed_special="all")
            else:
                out += enc.encode_ordinary(piece)
        return out

    return ids


class Packer:
    """Online packing of parts into windows; ``add`` and ``finish`` give the
    sequences that are complete, as lists of parts (document, start, ids)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def level(self, size: int) -> int:
        """The level to put a part of ``size`` on (0: a new window)."""
        top = self.window - size
        filled = np.flatnonzero(self.count[1 : top + 1]) + 1
        best, at = 2 * int(self.count[size]) + 1, 0
        if len(filled):
            rise = 2 * (self.count[filled + size] - self.count[filled]) + 2
            if filled[-1] == top:  # a full window is open no more
                rise[-1] = 1 - 2 * self.count[top]
            i = len(rise) - 1 - int(np.argmin(rise[::-1]))
            if rise[i] <= best:
                at = int(filled[i])
        return at

    def add(self, doc, ids: np.ndarray) -> Iterator[list]:
        at = 0
        while len(ids) - at >= self.window:
            yield [(doc, at, ids[at : at + self.window])]
            at += self.window
        if at == len(ids):
            return
        part, level = (doc, at, ids[at:]), self.level(len(ids) - at)
        parts = [part]
        if level:
            self.count[level] -= 1
            parts = self.open[level].pop()
            parts.append(part)
        level += len(part[2])
        if level == self.window:
            yield parts
        else:
            self.count[level] += 1
            self.open[level].append(parts)

    def finish(self) -> Iterator[list]:
        """Join the open windows and cut them anew."""
        parts = [p for level in reversed(self.open) for bin_ in level for p in bin_]
        left = sum(len(p[2]) for p in parts)
        room, out = 0, []
        for doc, start, ids in parts:
            while len(ids):
                if not room:
                    room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                piece = ids[:room]
                out.append((doc, start, piece))
                ids, start = ids[len(piece) :], start + len(piece)
                room -= len(piece)
                left -= len(piece)
                if not room:
                    yield out
                    out = []
        self.count[:] = 0
        self.open = [[] for _ in range(self.window + 1)]


def pack(docs: DataFrame, vocabulary: str | None = None, *, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (id, start, length, ids binary of little-endian unsigned 32-bit
    ids, doc_tokens, sequence_id, offset): every id of every document lies in
    exactly one piece, and the pieces of a sequence lie end to end."""
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(path), Packer(window)
        sequence = TaskContext.get().partitionId() << 33
        cols: list[list] = [[] for _ in range(7)]
        id_type = None

        def flush() -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
            for c in cols:
                c.clear()
            return out

        def emit(parts: list) -> None:
            nonlocal sequence
            offset = 0
            for (doc, total), start, ids in parts:
                for c, v in zip(cols, (doc, start, len(ids), ids.tobytes(), total, sequence, offset)):
                    c.append(v)
                offset += len(ids)
            sequence += 1

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py()), end_id], dtype="<u4")
                for parts in packer.add((doc, len(ids)), ids):
                    emit(parts)
                if len(cols[0]) >= _ROWS_OUT:
                    yield flush()
        for parts in packer.finish():
            emit(parts)
            if len(cols[0]) >= _ROWS_OUT:
                yield flush()
        if cols[0]:
            yield flush()

    return rows.mapInArrow(packed, schema).withColumnRenamed("id", id_col)
