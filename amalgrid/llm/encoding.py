"""Token ids of a byte-level public tokenizer for every text of a corpus.

A text is cut by the tokenizer's pattern; each piece is looked up whole, then in a bounded cache, and
else merged in a contiguous rank array: part boundaries beside the ranks of adjacent parts, scanned for
the smallest, whose boundary is deleted and whose neighbours are refreshed. Scanning is quadratic, so
pieces beyond ``SHORT`` bytes use a heap over the same boundaries, with the same result.
Vocabularies are read by path and never trained.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import chain, groupby
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabularies lie; a parameter everywhere.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern that cuts text before this family of vocabularies is applied.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: The same for ASCII text, in the faster of the two regular expression libraries.
_ASCII = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^ \t\n\r\x0b\x0cA-Za-z0-9]+|[ \t\n\r\x0b\x0c]+\Z|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]").findall
#: No piece spans this place: a piece holds blanks only before other signs, or nothing but blanks.
_BEFORE_BREAK = re.compile(r"(?<=[^\s\x1c-\x1f])(?=\n)")
SHORT = 96
CACHE = 200_000
_NONE = 1 << 60


def read_ranks(path: str | Path) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by the contiguous rank array."""
    bounds = list(range(len(word) + 1))
    near = [ranks.get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while near:
        best = min(near)
        if best == _NONE:
            break
        at = near.index(best)
        del bounds[at + 1], near[at]
        if at < len(near):
            near[at] = ranks.get(word[bounds[at] : bounds[at + 2]], _NONE)
        if at:
            near[at - 1] = ranks.get(word[bounds[at - 1] : bounds[at + 1]], _NONE)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids with a heap of (rank, place): for pieces too long to scan."""
    n = len(word)
    end = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    alive = bytearray(b"\1") * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        j = end[i]
        alive[j] = 0
        end[i] = stop
        if stop < n:
            left[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (k := left[i]) >= 0 and (r := ranks.get(word[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class Encoder:
    """Encodes texts with one vocabulary; keeps the ids of pieces seen, at most ``CACHE`` of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.known = ranks, {}
        self.any = regex.compile(pattern).findall
        self.pieces = self._mixed if pattern == PATTERN else self.any

    def _mixed(self, text: str) -> list[str]:
        """The pieces of a text, its ASCII stretches by the faster pattern."""
        if text.isascii():
            return _ASCII(text)
        out: list[str] = []
        for plain, lines in groupby(_BEFORE_BREAK.split(text), str.isascii):
            out += (_ASCII if plain else self.any)("".join(lines))
        return out

    def piece(self, piece: str) -> list[int]:
        word = piece.encode("utf-8", "replace")
        rank = self.ranks.get(word)
        ids = [rank] if rank is not None else merge_short(word, self.ranks) if len(word) <= SHORT else merge_long(word, self.ranks)
        if len(word) <= SHORT:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode_into(self, text: str, out: array) -> None:
        pieces = self.pieces(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            found = [self.piece(p) if ids is None else ids for p, ids in zip(pieces, found)]
        out.extend(chain.from_iterable(found))

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        if text:
            self.encode_into(text, out)
        return out.tolist()


_encoders: dict[int, Encoder] = {}


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", pattern: str = PATTERN) -> DataFrame:
    """(id, ids ARRAY<INT>): one row per row of ``docs``, without special tokens; null and empty texts give [].

    One narrow pass: a scan of two columns and no shuffle. The vocabulary is broadcast (some 50,000
    entries, about 1 MB, whatever the corpus).
    """
    source = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    id_field = pa.field(id_col, pa.int64())
    key = hash((vocabulary, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(key)
        if encoder is None:
            encoder = _encoders[key] = Encoder(ranks.value, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids, offsets = array("i"), array("i", [0])
                for text in batch.column(1).to_pylist():
                    if text:
                        encoder.encode_into(text, ids)
                    offsets.append(len(ids))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), lists], schema=pa.schema([id_field, pa.field("ids", lists.type)]))

    return source.mapInArrow(run, f"`{id_col}` long, ids array<int>")
