"""Texts decoded with the wrong character encoding: find them, and give back the original where it is known.

Every distinct clean word of the corpus that holds a non-ASCII character is garbled along every
encoding chain (bytes written in one encoding and read in another, once or twice over), and so are the
foreign runs and the single foreign letters and marks of these words. The garbled forms are a table, and the
corpus' own tokens, with all their parts that can be such a form, are hash-joined against it. So a word that
has no clean twin is put together from the originals of its parts, all along one chain.
A hit is verified: its original has to be plausible, and another string.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgrid.llm.lookalikes import distinct_records, lookalike_table, script_of, widths
from amalgrid.session import cut

# Fixed values: (bytes written as, bytes read as), one step each.
_UNICODE_READ_AS = ("latin-1", "cp1252", "cp437", "cp850", "mac_roman", "cp1250", "cp1251", "koi8-r", "iso8859-2", "cp1253", "cp866", "cp1254")
_SINGLE = (
    ("cp1252", "latin-1"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"),
    ("cp1250", "cp1252"), ("iso8859-2", "cp1252"), ("cp1250", "latin-1"),
    ("cp1251", "cp1252"), ("cp1251", "latin-1"), ("koi8-r", "cp1252"), ("koi8-r", "latin-1"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1252"), ("cp1251", "mac_roman"),
    ("cp1252", "cp1251"), ("cp1252", "cp1253"), ("cp1252", "koi8-r"), ("cp1252", "cp866"), ("mac_roman", "latin-1"), ("cp1250", "cp437"), ("cp1250", "mac_roman"),
    ("cp1253", "cp1252"), ("cp1253", "latin-1"), ("iso8859-7", "cp1252"), ("cp1253", "cp1251"), ("cp1253", "mac_roman"), ("cp1251", "cp1253"),
    ("gbk", "latin-1"), ("gbk", "cp1252"), ("big5", "latin-1"), ("big5", "cp1252"), ("shift_jis", "latin-1"), ("shift_jis", "cp1252"), ("euc_jp", "latin-1"), ("euc_jp", "cp1252"), ("euc_kr", "latin-1"), ("euc_kr", "cp1252"),
    ("gbk", "big5"), ("big5", "gbk"), ("shift_jis", "gbk"), ("euc_jp", "shift_jis"), ("euc_kr", "gbk"), ("utf-8", "gbk"), ("utf-8", "shift_jis"), ("utf-8", "big5"), ("utf-8", "euc_kr"),
    ("gbk", "cp1251"), ("euc_kr", "cp1251"), ("shift_jis", "cp1251"), ("euc_jp", "cp1251"), ("shift_jis", "cp437"), ("gbk", "cp437"), ("euc_kr", "mac_roman"), ("gbk", "mac_roman"),
)
_LOSSY = tuple((e, "utf-8") for e in ("cp1252", "cp1250", "cp1251", "cp1253", "koi8-r", "mac_roman", "gbk", "big5", "shift_jis", "euc_jp", "euc_kr", "cp437"))
_ASCII_LOSSY = (("utf-8", "ascii"),)
_TWICE = ("latin-1", "cp1252", "cp437", "mac_roman", "cp1251")

CHAINS: tuple[tuple[tuple[str, str], ...], ...] = (
    *(((("utf-8", d)),) for d in _UNICODE_READ_AS),
    *((s,) for s in _SINGLE),
    *((s,) for s in _LOSSY + _ASCII_LOSSY),
    *((("utf-8", a), ("utf-8", b)) for a in _TWICE for b in _TWICE),
    (("utf-8", "cp1252"),) * 3,
)
#: Marks that belong in a name.
_GOOD_MARKS = set("’‘“”–—‐‑•…№™®©«»·`´")


@lru_cache(maxsize=64)
def _reading(encoding: str) -> str | None:
    """A one-byte encoding as 256 characters; a byte without meaning stays the control character of its number."""
    out = []
    for b in range(256):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            if encoding not in ("cp1252", "cp1250", "cp1251", "cp1253", "cp1254", "iso8859-7"):
                return None
            c = chr(b)
        if len(c) != 1:
            return None
        out.append(c)
    return "".join(out)


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text after the chain; None where it can't be written that way or is unchanged."""
    s = text
    for write, read in chain:
        try:
            raw = s.encode(write)
        except UnicodeEncodeError:
            return None
        table = _reading(read) if read not in ("utf-8", "ascii", "gbk", "big5", "shift_jis", "euc_jp", "euc_kr") else None
        s = "".join(table[b] for b in raw) if table else raw.decode(read, "replace")
    return s if s != text else None


@lru_cache(maxsize=64)
def _bytes_of(encoding: str) -> dict[str, int] | None:
    table = _reading(encoding)
    return {c: b for b, c in reversed(list(enumerate(table)))} if table else None


def undone(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text before the chain, where every step can be taken back; else None."""
    for write, read in reversed(chain):
        back = _bytes_of(read) if read not in ("utf-8", "ascii", "gbk", "big5", "shift_jis", "euc_jp", "euc_kr") else None
        try:
            raw = bytes(back[c] for c in text) if back else text.encode(read)
            text = raw.decode(write)
        except (KeyError, UnicodeError):
            return None
    return text


_FOREIGN = regex.compile("[^\x00-\x7f]+")
_UGLY = regex.compile("[�\x00-\x08\x0e-\x1f\x7f-\x9f]|\\p{Co}|\\p{Cn}|[─-▟]")
#: Unicode bytes read in a one-byte Western encoding: a lead byte and its continuations.
_CONT = "[\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]"
_BYTES = regex.compile(f"[\xc2-\xdf]{_CONT}|[\xe0-\xef]{_CONT}{{2}}", regex.I)


def plausible(token: str, lookalike: frozenset[str] = frozenset()) -> bool:
    """Whether a word could be a clean one: letters of one script (look-alikes aside), no stray symbols."""
    if token.isascii():
        return True
    # Bytes taken apart may hold a no-break space, which is a blank afterwards.
    if _BYTES.search(token):
        return False
    token = widths(token)
    if _UGLY.search(token) or _BYTES.search(token):
        return False
    scripts: set[str] = set()
    ascii_letters = letters = 0
    for c in token:
        if c.isascii():
            ascii_letters += c.isalpha()
            letters += c.isalpha()
            continue
        category = unicodedata.category(c)
        if category[0] == "L":
            letters += 1
            if category == "Lm" and script_of(c) is None and not 0x3000 <= ord(c) <= 0x30FF:
                return False
            if c not in lookalike:
                scripts.add(script_of(c) or ("wide" if ord(c) > 0x2E7F else "other"))
        elif category in ("Zs", "Cf") or category[0] == "M" or c in _GOOD_MARKS:
            continue
        elif category[0] == "P" and ord(c) > 0x2E7F:
            continue
        else:
            return False
    if ascii_letters and scripts - {"latin"} or len(scripts) > 1:
        return False
    return not (scripts == {"latin"} and letters >= 3 and not ascii_letters)


_MULTI = ("utf-8", "ascii", "gbk", "big5", "shift_jis", "euc_jp", "euc_kr")
#: Bits of the filter on forms: 16 a piece, and never more than this, 16 MB; what passes it is decided by the join.
FILTER_BITS = 1 << 27
#: The longest form of one character that a piece of a token is compared with; a run or a word may be longer.
LONGEST = 20


def _read_all(text: str, chain: tuple[tuple[str, str], ...]) -> str:
    """``garble`` for text that can be written: line breaks stay."""
    for write, read in chain:
        raw = text.encode(write)
        table = _reading(read) if read not in _MULTI else None
        text = codecs.charmap_decode(raw, "strict", table)[0] if table else raw.decode(read, "replace")
    return text


def _writable(words: list[str], encoding: str) -> list[int]:
    if encoding == "utf-8":
        return list(range(len(words)))
    out = []
    for k, w in enumerate(words):
        try:
            w.encode(encoding)
        except UnicodeEncodeError:
            continue
        out.append(k)
    return out


def all_forms(words: list[str], passes=None) -> Iterator[tuple[int, str, int]]:
    """(place in words, form, chain) of every form; of longer words only the first chain that gives a form.

    ``passes(lower-case forms) -> places`` keeps forms out that nothing can hold.
    """
    writable = {e: _writable(words, e) for e in {c[0][0] for c in CHAINS}}
    seen: set[tuple[int, str]] = set()
    for k, chain in enumerate(CHAINS):
        places = writable[chain[0][0]]
        if not places:
            continue
        mine = [words[p] for p in places]
        text = _read_all("\n".join(mine), chain)
        low = text.lower().split("\n")
        forms = text.split("\n")
        if len(forms) != len(mine):
            forms = [garble(w, chain) or w for w in mine]
            low = [f.lower() for f in forms]
        for at in range(len(forms)) if passes is None else passes(low):
            word, form, p = mine[at], forms[at], places[at]
            if form == word or form.isascii() or not form.strip("?�") or any(x in form for x in " \t\r\n"):
                continue
            if len(word) > 1:
                if (p, form) in seen:
                    continue
                seen.add((p, form))
            yield p, form, k


def _forms(bitmap, bits: int):
    """Units -> (low, form, unit, chain), for forms that the corpus may hold according to its bitmap."""
    from zlib import crc32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bitmap.value, np.uint8)

        def passes(low: list[str]) -> list[int]:
            bit = np.fromiter(map(crc32, map(str.encode, low)), np.int64, len(low)) & (bits - 1)
            return np.nonzero(held[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)[0].tolist()

        for batch in batches:
            units = batch.column(0).to_pylist()
            found = list(all_forms(units, passes))
            forms = [f for _, f, _ in found]
            yield pa.RecordBatch.from_arrays([pa.array([f.lower() for f in forms], pa.string()), pa.array(forms, pa.string()), pa.array([units[p] for p, _, _ in found], pa.string()), pa.array([k for _, _, k in found], pa.int32())], names=["low", "form", "unit", "chain"])

    return run


def _bitmap(pieces: DataFrame, bits: int) -> bytes:
    """One bit for each checksum of a lower-case piece: of fixed size, whatever the corpus."""
    place = pieces.select((F.crc32("low") % bits + 1).alias("bit"))  # these functions count from 1
    parts = place.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    out = bytearray(bits // 8 + 4096 * 2)
    for bucket, part in parts.toLocalIterator():
        at = (bucket - 1) * 4096
        out[at : at + 4096] = part
    return bytes(out)


def _pieces(token: str) -> set[str]:
    """What of an implausible token can be a form: itself, its foreign runs, and its short foreign parts."""
    out = {token, *_FOREIGN.findall(token)}
    odd = [k for k, c in enumerate(token) if not c.isascii()]
    for n, i in enumerate(odd):
        for j in odd[n:]:
            if j - i >= LONGEST:
                break
            out.add(token[i : j + 1])
    return out


def _cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, ok) -> (token, ok, low): the lower-case pieces to look up; of a plausible token itself alone."""
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            batch = whole.slice(at, 2000)
            tokens, oks, lows = [], [], []
            for token, ok in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for low in {p.lower() for p in ({token} if ok else _pieces(token))}:
                    tokens.append(token)
                    oks.append(ok)
                    lows.append(low)
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(oks, pa.bool_()), pa.array(lows, pa.string())], names=["token", "ok", "low"])


#: ASCII letters that have a twin in Cyrillic or Greek; a word of these alone may be such a word.
_TWINS = (frozenset("ABCEHIJKMOPSTXYaceiopsxy"), frozenset("ABEHIKMNOPTXYZopuvxy"))


def _byte_evidence(token: str, lookalike: frozenset[str]) -> bool:
    """Whether letters taken one for one can be a misreading: a sign or foreign letter inside an ASCII word,
    which the word's own letters do not explain as look-alikes; or a word without any ASCII letter."""
    plain = {c for c in token if c.isascii() and c.isalpha()}
    if not plain:
        return True
    odd = [c for c in token if not c.isascii() and (c not in lookalike or unicodedata.category(c) in ("Lm", "Sk")) and (unicodedata.category(c) not in ("Lu", "Ll") or script_of(c) != "latin")]
    odd = [c for c in odd if unicodedata.category(c)[0] not in "ZM" and unicodedata.category(c) != "Cf" and (c not in _GOOD_MARKS or c == "·")]
    return bool(odd) and not any(plain <= twins for twins in _TWINS)


def tiled(token: str, hits: list[tuple[str, str, int]], lookalike: frozenset[str]) -> tuple[str, int] | None:
    """The token with joined (form, unit, chain) put back along one chain: the shortest plausible original and its chain.

    Unicode bytes read apart may stand beside letters that survived; letters read one for one go all or none.
    """
    chains: dict[int, dict[str, str]] = {}
    for form, unit, k in sorted(hits, key=lambda x: (x[2], len(x[0]), x)):
        table = chains.setdefault(k, {})
        table[form] = unit
        for shifted in (form.lower(), form.upper()):
            if len(shifted) == len(form):
                table.setdefault(shifted, unit)
    best: tuple[int, int, str] | None = None
    for k, table in chains.items():
        many = CHAINS[k][0][0] == "utf-8"
        longest = max(map(len, table))
        out, at, found, bad = [], 0, 0, False
        while at < len(token) and not bad:
            c = token[at]
            for n in range(min(longest, len(token) - at), 0, -1):
                if (to := table.get(token[at : at + n])) is not None:
                    out.append(to)
                    at += n
                    found += 1
                    break
            else:
                bad = not c.isascii() and (not many or unicodedata.category(c)[0] not in "LZMP" and c not in _GOOD_MARKS)
                out.append(c)
                at += 1
        if found and not bad and (fixed := "".join(out)) != token and plausible(fixed, lookalike):
            if not many and not _byte_evidence(token, lookalike):
                continue
            best = min(best or (len(fixed), k, fixed), (len(fixed), k, fixed))
    return (best[2], best[1]) if best else None


def _solved(lookalike: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, originals, chains = [], [], []
            for token, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (hit := tiled(token, [(f["form"], f["unit"], f["chain"]) for f in found], lookalike)) is not None:
                    tokens.append(token)
                    originals.append(hit[0])
                    chains.append(hit[1])
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(originals, pa.string()), pa.array(chains, pa.int32())], names=["token", "original", "chain"])

    return run


_SPLIT = "[ \\t\\r\\n]+"
#: Nats a letter pair by which an original must read better than a plausible token, whatever their counts.
BETTER = 0.5


def _pairs_of(token: str):
    """The letter pairs of a token with its ends, in lower case: a name typed with the shift lock on is no other."""
    ends = F.concat(F.lit("\x02"), F.lower(token), F.lit("\x03"))
    return F.transform(F.sequence(F.lit(1), F.length(ends) - 1), lambda i: F.substring(ends, i, F.lit(2)))


def _readings(texts: DataFrame, clean: DataFrame) -> DataFrame:
    """(text, score, follows): the mean log share of a text's letter pairs among those of all distinct clean tokens,
    and the mean log share among the pairs that begin with the same letter, in which the size of a script doesn't count."""
    pairs = clean.select(F.explode(_pairs_of("token")).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("m"))
    begun = pairs.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("m").alias("f"))
    wanted = texts.select("text", F.explode(_pairs_of("text")).alias("pair")).withColumn("first", F.substring("pair", 1, 1))
    m, f = F.coalesce("m", F.lit(0)) + 0.1, F.coalesce("f", F.lit(0)) + 5
    return wanted.join(pairs, "pair", "left").join(begun, "first", "left").groupBy("text").agg(F.avg(F.log(m)).alias("score"), F.avg(F.log(m / f)).alias("follows"))


def garbled_tokens(rows: DataFrame) -> DataFrame:
    """(token, original, chain): the garbled tokens of ``rows(id, name)``; original is null where it is lost."""
    spark = rows.sparkSession
    lookalike = frozenset(c for p, s in lookalike_table(spark).items() if (c := chr(p)) and s.isascii())

    from pyspark.sql.functions import arrow_udf

    @arrow_udf("boolean")
    def is_plausible(values: pa.Array) -> pa.Array:
        return pa.array([plausible(v, lookalike) for v in values.to_pylist()], pa.bool_())

    foreign = "[^\\x00-\\x7F]"
    strange = rows.select("name").filter(F.col("name").rlike(foreign)).distinct()
    tokens = strange.select(F.explode(F.array_distinct(F.split("name", _SPLIT))).alias("token")).filter(F.col("token").rlike(foreign))
    # Counted over distinct names: copies say nothing about a word.
    tokens = cut(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("ok", is_plausible("token")))
    clean = tokens.filter("ok")
    pieces = cut(tokens.select("token", "ok").mapInArrow(_cut_up, "token string, ok boolean, low string"))
    count = pieces.count()
    bits = min(FILTER_BITS, 1 << max(16, (16 * count).bit_length()))
    # Most forms occur nowhere; the filter keeps them out of the shuffle, and the join decides about the rest.
    bitmap = spark.sparkContext.broadcast(_bitmap(pieces, bits))
    tasks = max(spark.sparkContext.defaultParallelism, count // 50_000)
    # The units of the corpus: its clean words, the foreign runs within them, and their foreign letters.
    runs, letters = F.regexp_extract_all("token", F.lit("[^\\x00-\\x7F]+"), F.lit(0)), F.split(F.regexp_replace("token", "[\\x00-\\x7F]+", ""), "")
    units = clean.select(F.explode(F.concat(F.array("token"), runs, letters)).alias("unit")).filter("unit <> ''")
    units = units.unionByName(spark.createDataFrame([(c,) for c in sorted({*_GOOD_MARKS, "\xa0", "€"})], "unit string")).distinct()
    forms = units.repartition(tasks).mapInArrow(_forms(bitmap, bits), "low string, form string, unit string, chain int")
    hits = cut(pieces.join(forms, "low").filter("low <> lower(unit)"))
    # Within a token there are at most so many pieces, chains and letters as its length allows.
    found = hits.filter("not ok").groupBy("token").agg(F.collect_set(F.struct("form", "unit", "chain")).alias("found"))
    sure = found.mapInArrow(_solved(lookalike), "token string, original string, chain int")
    # Where both read as words, the letters decide which is the accident; only where they don't, the counts of names.
    unsure = hits.filter("ok").join(clean.select(F.col("token").alias("unit"), F.col("n").alias("n_unit")), "unit").join(clean.select("token", "n"), "token")
    unsure = cut(unsure.select("token", F.col("unit").alias("original"), "chain", "n", "n_unit"))
    texts = _readings(unsure.select(F.col("token").alias("text")).unionByName(unsure.select(F.col("original").alias("text"))).distinct(), clean)
    texts = texts.withColumn("low", F.lower("text")).join(clean.groupBy(F.lower("token").alias("low")).agg(F.sum("n").alias("all")), "low")
    read = unsure.join(texts.select(F.col("text").alias("token"), F.col("score").alias("s"), F.col("follows").alias("f"), F.col("all").alias("all_n")), "token")
    read = read.join(texts.select(F.col("text").alias("original"), F.col("score").alias("s_unit"), F.col("follows").alias("f_unit"), F.col("all").alias("all_unit")), "original")
    # Letters and counts together have to speak for the accident: a short word of a rare script reads worse than its
    # reading in a frequent one, and is not the accident if a hundred times as many names have it.
    together = "(f_unit - f) * (least(length(original), length(token)) + 1) + ln(all_unit / all_n) > ln(2)"
    unsure = read.filter(f"(s_unit - s > {BETTER} or n_unit > 2 * n) and {together}").select("token", "original", "chain")
    lost = tokens.filter("token like '%�%'").select("token", F.lit(None).cast("string").alias("original"), F.lit(None).cast("int").alias("chain"))
    both = sure.unionByName(unsure).unionByName(lost)
    return both.groupBy("token").agg(F.min(F.struct(F.col("original").isNull().alias("lost"), F.length("original").alias("n"), "chain", "original")).alias("b")).select("token", "b.original", "b.chain")


def garbled_records(df: DataFrame, id_col: str = "record_id", name_col: str = "record_name") -> DataFrame:
    """(id, restored): each record with a garbled part, once per distinct name.

    ``restored`` is what ``restored_name`` makes of it; null where a token is lost. Null names and
    names without a non-ASCII character are never garbled.
    """
    rows = distinct_records(df, id_col, name_col)
    fixes = cut(garbled_tokens(rows))
    strange = rows.filter(F.col("name").rlike("[^\\x00-\\x7F]"))
    parts = strange.select("id", "name", F.posexplode(F.split("name", _SPLIT)).alias("at", "token"))
    hit = parts.filter(F.col("token").rlike("[^\\x00-\\x7F]")).join(fixes, "token")
    # At most one row per token of a name: bounded by the name's own length.
    found = hit.groupBy("id", "name").agg(F.to_json(F.collect_set(F.struct("at", "original", "chain")), {"ignoreNullFields": "false"}).alias("found"))

    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def restore(names: pa.Array, parts: pa.Array) -> pa.Array:
        return pa.array([restored_name(n, json.loads(f)) for n, f in zip(names.to_pylist(), parts.to_pylist())], pa.string())

    return found.select(F.col("id").alias(id_col), F.col("name").alias(name_col), restore("name", "found").alias("restored"))


def restored_name(name: str, found: list[dict]) -> str | None:
    """The name with its garbled tokens replaced; null where one is lost.

    A chain that one token went through took the whole name along: it is undone in the other non-ASCII
    tokens too, where that gives a plausible word.
    """
    if any(f["original"] is None for f in found):
        return None
    tokens = regex.split(r"[ \t\r\n]+", name)
    fixed = {f["at"]: f["original"] for f in found}
    chains = {f["chain"] for f in found if f["chain"] is not None}
    for at, token in enumerate(tokens):
        if at in fixed or token.isascii():
            continue
        for k in sorted(chains):
            original = undone(token, CHAINS[k])
            if original is not None and original != token and plausible(original):
                fixed[at] = original
                break
    return " ".join(fixed.get(at, token) for at, token in enumerate(tokens))
