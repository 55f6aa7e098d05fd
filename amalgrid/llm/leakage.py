"""Evaluation passages inside training texts.

A leak is a run of ``WORDS`` words of an item (or ``SIGNS`` letters or digits of a script written without
spaces) standing in a document. Both sides are cut into windows of exactly that size (of the smallest passage: a
window as long as the whole item could not find a part of it), each window gets a
64-bit SimHash over its shingles (pairs of neighbours), and the fingerprints are indexed by ``radius + 1``
blocks: two fingerprints within ``radius`` bits agree in at least one block, so no window within it is
missed. A candidate is verified by the weighted similarity of its shingles and, where only equal passages
count, by its words. Equal windows have equal fingerprints, so every leak as defined is found.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgrid.session import cut

WORDS, SIGNS, RADIUS = 12, 20, 3
#: Item windows one broadcast index may hold (about 200 bytes each, 100 MB in all); more are joined by shuffle.
INDEX_WINDOWS = 500_000

_COMMAND = regex.compile(r"\\[A-Za-z]{2,}\s*(?=\{)")
_TAG = regex.compile(r"</?[A-Za-z][^<>]{0,300}>|<!--|-->")
_ENTITY = regex.compile(r"&(?:#\d{1,7}|#x[0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_ANSI = regex.compile(r"(?:\x1b|\\x1b|\\033|\\u001b)\[[0-9;]*[A-Za-z]")
_CODED = regex.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})")
_ESCAPE = regex.compile(r"\\+[ntrfvab0](?![A-Za-z]*:)")
_HIDDEN = regex.compile(r"\p{Cf}+")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}ー"
_ANY_UNSPACED = regex.compile(f"[{_UNSPACED}]")
_SIGN = regex.compile(rf"[{_UNSPACED}--\p{{M}}--\p{{P}}]|\p{{N}}|[\p{{L}}--[{_UNSPACED}]]+", regex.V1)


def plain(text: str) -> str:
    """The text in one form: escapes, entities, markup and colour codes as blanks, case folded."""
    if "\\" in text:
        text = _ANSI.sub(" ", text)
        text = _CODED.sub(lambda m: chr(int(m[1] or m[2], 16)) if not 0xD800 <= int(m[1] or m[2], 16) <= 0xDFFF else " ", text)
        text = _ESCAPE.sub(" ", _COMMAND.sub(" ", text))
    if "\x1b" in text:
        text = _ANSI.sub(" ", text)
    if "<" in text or "-->" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    return text.casefold()


class Hashes:
    """64-bit hashes of words, kept up to a bound."""

    def __init__(self, bound: int = 500_000):
        self.known: dict[str, int] = {}
        self.bound = bound

    def of(self, words: list[str]) -> list[int]:
        known = self.known
        if len(known) > self.bound:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            out.append(h)
        return out


_BREAK = 0


def sequences(text: str | None, hashes: Hashes) -> tuple[list[int], list[int]]:
    """Hashes of the words, and of the signs of unspaced scripts (0 where other letters break them)."""
    if not text:
        return [], []
    text = plain(text)
    words = hashes.of(_WORD.findall(text))
    signs: list[int] = []
    if _ANY_UNSPACED.search(text):
        found = _SIGN.findall(text)
        signs = [h if len(s) == 1 and (s.isnumeric() or _ANY_UNSPACED.match(s)) else _BREAK for s, h in zip(found, hashes.of(found))]
    return words, signs


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def windows(h: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, fingerprints) of all windows of ``size`` that stay in one owner and hold no break."""
    if len(h) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    broken = np.concatenate([[0], np.cumsum(h == _BREAK)])
    good = (owner[size - 1 :] == owner[: len(owner) - size + 1]) & (broken[size:] == broken[:-size])
    starts = np.nonzero(good)[0]
    prints = np.zeros(len(starts), np.uint64)
    shingles = _mixed(h[:-1], h[1:])
    n = size - 1
    step = 1 << 12
    for low in range(0, len(starts), step):
        part = starts[low : low + step]
        first, last = part[0], part[-1] + n
        bits = np.unpackbits(shingles[first:last].view(np.uint8).reshape(-1, 8), axis=1)
        # Sums may wrap around: a window's own sum, their difference, is below 256 (or they are wider).
        sums = np.zeros((len(bits) + 1, 64), np.uint8 if n < 256 else np.int64)
        np.cumsum(bits, axis=0, dtype=sums.dtype, out=sums[1:])
        at = part - first
        ones = sums[at + n] - sums[at]
        prints[low : low + step] = np.packbits(ones > n // 2, axis=1).reshape(-1, 8).copy().view(np.uint64).ravel()
    return starts, prints


class Index:
    """Item windows of one size by fingerprint block."""

    def __init__(self, size: int, radius: int):
        self.size, self.radius, self.owners, self.rows, self.prints = size, radius, [], [], []

    def add(self, item: int, print_: int, row: bytes) -> None:
        self.rows.append(np.frombuffer(row, np.uint64))
        self.prints.append(print_)
        self.owners.append(item)

    def close(self) -> "Index":
        self.prints = np.array(self.prints, np.int64).view(np.uint64)
        self.owners = np.array(self.owners, np.int64)
        self.rows = np.array(self.rows, np.uint64).reshape(-1, self.size)
        blocks = self.radius + 1
        width = 64 // blocks
        self.blocks = []
        for b in range(blocks):
            bits = min(width, 16)
            shift, mask = np.uint64(b * width), np.uint64((1 << bits) - 1)
            key = ((self.prints >> shift) & mask).astype(np.int64)
            order = np.argsort(key, kind="stable")
            starts = np.searchsorted(key[order], np.arange((1 << bits) + 1))
            self.blocks.append((shift, mask, order, starts))
        return self

    def hits(self, h: np.ndarray, owner: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
        """(owner, item) for each verified window; repeats are possible."""
        if not len(self.prints):
            return
        starts, prints = windows(h, owner, self.size)
        for shift, mask, order, bounds in self.blocks:
            key = ((prints >> shift) & mask).astype(np.int64)
            low, count = bounds[key], bounds[key + 1] - bounds[key]
            some = np.nonzero(count)[0]
            if not len(some):
                continue
            low, count = low[some], count[some]
            mine = np.repeat(some, count)
            theirs = order[np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
            near = np.bitwise_count(prints[mine] ^ self.prints[theirs]) <= self.radius
            mine, theirs = mine[near], theirs[near]
            if not len(mine):
                continue
            here = h[starts[mine][:, None] + np.arange(self.size)]
            there = self.rows[theirs]
            same = verified(here, there, threshold)
            yield from zip(owner[starts[mine[same]]].tolist(), self.owners[theirs[same]].tolist())


def similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weighted similarity of the shingles of paired windows: common weight over all weight, 1 for equal bags."""
    x, y = np.sort(_mixed(a[:, :-1], a[:, 1:]), axis=1), np.sort(_mixed(b[:, :-1], b[:, 1:]), axis=1)
    equal = (x == y).all(axis=1)
    out = equal.astype(float)
    for k in np.nonzero(~equal)[0]:
        u, cu = np.unique(x[k], return_counts=True)
        v, cv = np.unique(y[k], return_counts=True)
        _, iu, iv = np.intersect1d(u, v, return_indices=True)
        common = np.minimum(cu[iu], cv[iv]).sum()
        out[k] = common / (cu.sum() + cv.sum() - common)
    return out


def verified(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether paired windows are as similar as asked; at 1 they have to be equal word for word."""
    alike = similar(a, b) >= threshold
    return alike & (a == b).all(axis=1) if threshold >= 1 else alike


_WINDOW = "kind int, owner long, fingerprint long, words binary"


def _cut(words: int, signs: int):
    """(id, text) -> (kind, owner, fingerprint, words): all distinct windows of a text, of words (0) and of signs (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 20):
                batch = whole.slice(at, 20)
                out: set[tuple[int, int, int, bytes]] = set()
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for kind, (size, seq) in enumerate(zip((words, signs), sequences(text, known))):
                        h = np.array(seq, np.uint64)
                        starts, prints = windows(h, np.zeros(len(h), np.int64), size)
                        out.update((kind, key, p, h[s : s + size].tobytes()) for s, p in zip(starts.tolist(), prints.view(np.int64).tolist()))
                rows = sorted(out)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["kind", "owner", "fingerprint", "words"])

    return run


def _verify(threshold: float):
    """(doc, item, words of the one, words of the other) -> (doc, item) where these are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            mine, theirs = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            # Windows of words and of signs differ in length.
            for size in {len(m) for m in mine}:
                at = [k for k, m in enumerate(mine) if len(m) == size and len(theirs[k]) == size]
                a, b = (np.frombuffer(b"".join(side[k] for k in at), np.uint64).reshape(len(at), -1) for side in (mine, theirs))
                keep[at] = verified(a, b, threshold)
            yield batch.filter(pa.array(keep)).select([0, 1])

    return run


def _blocks(radius: int) -> str:
    """SQL: the keys of a fingerprint's blocks."""
    width = 64 // (radius + 1)
    bits = min(width, 16)
    return "array(" + ", ".join(f"struct({b} as block, shiftrightunsigned(fingerprint, {b * width}) & {(1 << bits) - 1}L as key)" for b in range(radius + 1)) + ")"


def _joined(docs: DataFrame, held: DataFrame, words: int, signs: int, radius: int, threshold: float) -> DataFrame:
    """The same leaks for items of any number: blocks of document windows shuffled against blocks of item windows."""
    mine = docs.mapInArrow(_cut(words, signs), _WINDOW).withColumn("b", F.explode(F.expr(_blocks(radius))))
    # Windows that several items share meet a document once.
    theirs = held.groupBy("kind", "fingerprint", "words").agg(F.collect_set("owner").alias("items")).withColumn("b", F.explode(F.expr(_blocks(radius))))
    near = mine.alias("x").join(theirs.alias("y"), F.expr(f"x.kind = y.kind and x.b = y.b and bit_count(x.fingerprint ^ y.fingerprint) <= {radius}"))
    pairs = near.select(F.col("x.owner").alias("doc_id"), F.explode("y.items").alias("item_id"), F.col("x.words").alias("mine"), F.col("y.words").alias("theirs"))
    return pairs.mapInArrow(_verify(threshold), "doc_id long, item_id long").distinct()


def leaks(docs: DataFrame, items: DataFrame, words: int = WORDS, signs: int = SIGNS, radius: int = RADIUS, threshold: float = 1.0, index_windows: int = INDEX_WINDOWS) -> DataFrame:
    """(doc_id, item_id): every document and item that share a passage, once.

    A passage is a window of ``words`` words (``signs`` signs). At a ``threshold`` of 1 it stands in both word for word,
    and every one is found, since equal windows have equal fingerprints. Below 1 a window also counts whose weighted
    shingles are as similar as that, if the fingerprints are within ``radius`` bits; all within it are compared.

    The windows of the items are counted first. Up to ``index_windows`` of them are one broadcast index, and documents
    are scanned once without a shuffle; more are joined with the documents' windows by block, with the same result.
    Null and empty texts, on either side, leak nothing.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null and text is not null")
    tests = items.select(F.col("item_id").cast("long"), "item_text").filter("item_id is not null and item_text is not null").distinct()
    held = cut(tests.mapInArrow(_cut(words, signs), _WINDOW).distinct())
    if held.count() > index_windows:
        return _joined(source, held, words, signs, radius, threshold)
    pair = (Index(words, radius), Index(signs, radius))
    for kind, owner, fingerprint, row in held.toLocalIterator():
        pair[kind].add(owner, fingerprint, bytes(row))
    shared = spark.sparkContext.broadcast([x.close() for x in pair])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                found: set[tuple[int, int]] = set()
                bags: tuple[list, list] = ([], [])
                sizes: tuple[list, list] = ([], [])
                ids = batch.column(0).to_pylist()
                for text in batch.column(1).to_pylist():
                    for bag, size, seq in zip(bags, sizes, sequences(text, known)):
                        bag.extend(seq)
                        size.append(len(seq))
                for index, bag, size in zip(shared.value, bags, sizes):
                    owner = np.repeat(np.arange(len(ids)), size)
                    found.update((ids[d], item) for d, item in index.hits(np.array(bag, np.uint64), owner, threshold))
                if found:
                    rows = sorted(found)
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["doc_id", "item_id"])

    return source.mapInArrow(run, "doc_id long, item_id long").distinct()
