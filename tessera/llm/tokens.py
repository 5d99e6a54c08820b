"""Token counts with the library of a public tokenizer.

Texts are encoded in Arrow batches that return lengths only.  A long text is
split where a token must end anyway, so the pieces' counts add up to the
count of the whole; pieces are gathered into encoder batches of about equal
bytes, so memory is bounded by a batch whatever the texts are.

Safe boundary: between a character that is no white space and an ASCII white
space.  In the byte-level pattern white space only starts a token, so a
token ends there in the whole text too.  A text without such a place (one
unbroken run) is encoded as it is.  SentencePiece models and tokenizers
that normalise across white space get whole texts.

Because counts of such pieces add up, a worker remembers the counts of pieces
it met twice (a bounded table; a piece is a space and what follows up to the
next) and encodes only the other pieces of a text, joined.

Nulls: a null text counts as empty (0 tokens); ids may be null or repeat; rows
map one to one.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 1 << 16
BATCH_BYTES = 1 << 18
MEMO_PIECES = 400_000
#: White space after a space: not a boundary between single words.
_RUN = re.compile(r" \s")
#: White space after a graphic ASCII character or a letter beyond ASCII.
_CUT = re.compile(r"(?<=[!-~À-ɏЀ-ӿ])[ \n]")


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """``text`` in pieces of about ``limit`` characters, cut at safe
    boundaries only (a piece is longer where there is none)."""
    if len(text) <= limit:
        return [text]
    out, at = [], 0
    while len(text) - at > limit:
        found = _CUT.search(text, at + limit)
        if not found:
            break
        out.append(text[at : found.start()])
        at = found.start()
    out.append(text[at:])
    return out


def balanced(pieces: list[str], limit: int = BATCH_BYTES) -> Iterator[range]:
    """Consecutive runs of ``pieces`` of about ``limit`` UTF-8 bytes each."""
    first = total = 0
    for i, p in enumerate(pieces):
        total += len(p) if p.isascii() else len(p.encode())
        if total >= limit:
            yield range(first, i + 1)
            first, total = i + 1, 0
    if first < len(pieces):
        yield range(first, len(pieces))


class PieceCounts:
    """Token counts of pieces " word", learned when a piece is met again."""

    def __init__(self, lengths, special: tuple[str, ...], limit: int = MEMO_PIECES):
        self.lengths, self.special, self.limit = lengths, special, limit
        self.known: dict[str, int] = {}
        self.met: set[str] = set()
        self.learn: set[str] = set()

    def split(self, text: str) -> tuple[int, str]:
        """(tokens of the pieces known, the rest of the text joined)."""
        if _RUN.search(text) or any(s in text for s in self.special):
            return 0, text
        first, *pieces = text.split(" ")
        if pieces and not pieces[-1]:  # a space at the end stays with its piece
            return 0, text
        counts = list(map(self.known.get, pieces))
        if None not in counts:
            return sum(counts), first
        new = [p for p, c in zip(pieces, counts) if c is None]
        if len(self.known) < self.limit:
            self.learn.update(p for p in new if p in self.met and len(p) < 100)
            self.met.update(new)
        return sum(filter(None, counts)), " ".join([first, *new])

    def settle(self) -> None:
        """Count the pieces met again; forget pieces met once when many."""
        pieces = [p for p in self.learn if p not in self.known]
        self.known.update(zip(pieces, self.lengths([" " + p for p in pieces])))
        self.learn.clear()
        if len(self.met) > 2 * self.limit:
            self.met.clear()


@functools.lru_cache(maxsize=4)
def _lengths(path: str):
    """Function from a list of texts to their token counts, and piece counts
    where texts may be split; one for each Python worker and vocabulary."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), None
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    by_bytes = tok.normalizer is None and type(tok.pre_tokenizer).__name__ == "ByteLevel" and not tok.pre_tokenizer.add_prefix_space


    def lengths(texts: list[str]) -> list[int]:
        return [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]

    special = tuple(t.content for t in tok.get_added_tokens_decoder().values())
    return lengths, PieceCounts(lengths, special) if by_bytes else None


def default_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, vocabulary: str | None = None, *, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``docs``."""
    path = vocabulary or default_vocabulary()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memo = _lengths(path)
        for batch in batches:
            pieces, of, counts = [], [], [0] * batch.num_rows
            for row, text in enumerate(batch.column(1)):
                text = text.as_py()
                if memo:
                    counts[row], text = memo.split(text)
                own = safe_pieces(text) if memo else [text]
                pieces += own
                of += [row] * len(own)
            for run in balanced(pieces):
                for i, n in zip(run, encode([pieces[i] for i in run])):
                    counts[of[i]] += n
            if memo:
                memo.settle()
            size = batch.column(2)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(lengths, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
