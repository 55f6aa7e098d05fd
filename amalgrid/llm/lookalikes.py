"""One form for texts that look the same: decompose, replace by prototype, decompose again.

The table of look-alike characters is that of Unicode's security mechanisms (UTS 39), asked once
from the ICU library that ships with Spark. ASCII keeps its own identity (``I``, ``l`` and ``1`` stay
apart, so case can still be folded), and a foreign character goes to the ASCII one of its own kind.
The table is bounded by Unicode, some ten thousand entries, whatever the data.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgrid.session import cut

_WIDTH = ("<wide>", "<narrow>", "<noBreak>", "<font>")
_UNSEEN = regex.compile(r"[\p{Cf}\p{Default_Ignorable_Code_Point}]")
_BLANKS = re.compile(r"\s+")
#: Composed syllables decompose before they are looked up; surrogates, private and unassigned places have no look.
_COMPOSED = range(0xAC00, 0xD7A4)

_tables: dict[str, dict[int, str]] = {}


def lookalike_table(spark: SparkSession) -> dict[int, str]:
    """Code point -> prototype, without the entries that change nothing. Kept for the session."""
    if "chars" in _tables:
        return _tables["chars"]
    jvm = spark.sparkContext._jvm
    checker = jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    points = [p for p in range(0x21, sys.maxunicode + 1) if p not in _COMPOSED and unicodedata.category(chr(p))[0] in "LMNPS"]
    skeletons = []
    step = 5000
    for at in range(0, len(points), step):
        part = points[at : at + step]
        found = checker.getSkeleton("\n".join(map(chr, part))).split("\n")
        skeletons += found if len(found) == len(part) else [checker.getSkeleton(chr(p)) for p in part]
    ascii_of: dict[str, list[str]] = {}
    for p, s in zip(points, skeletons):
        if p < 0x80:
            ascii_of.setdefault(s, []).append(chr(p))

    def kind(c: str) -> str:
        category = unicodedata.category(c)
        return category if category in ("Lu", "Ll", "Nd") else category[0]

    def back(source: str, skeleton: str) -> str:
        """The skeleton with ASCII prototypes replaced by the ASCII character of the source's kind."""
        if skeleton in ascii_of:
            options = ascii_of[skeleton]
            return next((c for c in options if kind(c) == kind(source)), next((c for c in options if kind(c)[0] == kind(source)[0]), options[0]))
        return skeleton

    table = {}
    for p, s in zip(points, skeletons):
        c = chr(p)
        if p >= 0x80 and (to := back(c, s)) != c and to != unicodedata.normalize("NFD", c):
            table[p] = to
    _tables["chars"] = table
    return table


def widths(text: str) -> str:
    """Full-width, half-width, font and no-break forms as the plain character; every blank as a space."""
    if text.isascii():
        return text
    out = []
    for c in text:
        d = unicodedata.decomposition(c)
        if d.startswith(_WIDTH):
            c = unicodedata.normalize("NFKC", c)
        elif unicodedata.category(c) == "Zs":
            c = " "
        out.append(c)
    return "".join(out)


def skeleton(text: str, table: dict[int, str]) -> str:
    """The look of a text, case kept; unseen characters dropped, runs of blanks as one space."""
    if not text.isascii():
        text = unicodedata.normalize("NFD", _UNSEEN.sub("", widths(text))).translate(table)
        text = unicodedata.normalize("NFD", text)
    return _BLANKS.sub(" ", text).strip()


_SCRIPTS = (("latin", regex.compile(r"\p{Latin}")), ("cyrillic", regex.compile(r"\p{Cyrillic}")), ("greek", regex.compile(r"\p{Greek}")))


@lru_cache(maxsize=1 << 16)
def script_of(c: str) -> str | None:
    return next((name for name, r in _SCRIPTS if r.match(c)), None)


class NativeFold:
    """Brings look-alike letters home to the script their word is written in, so that case can be folded.

    The script is that of the letters that no other script's letter looks like; failing those, that of
    the most letters. Latin wins ties.
    """

    def __init__(self, table: dict[int, str]):
        self.to_latin = {chr(p): s for p, s in table.items() if len(s) == 1 and s.isascii() and s.isalpha()}
        self.table = table
        self.home: dict[str, dict[str, str]] = {}
        for name, low, high in (("cyrillic", 0x410, 0x44F), ("greek", 0x391, 0x3C9)):
            self.home[name] = {self.to_latin[chr(p)]: chr(p) for p in range(high, low - 1, -1) if chr(p) in self.to_latin}
        self.ambiguous = {c for m in self.home.values() for c in m}

    def __call__(self, text: str) -> str:
        """NFC, in lower case; accents are kept."""
        if text.isascii():
            return text.casefold()
        text = unicodedata.normalize("NFC", _UNSEEN.sub("", widths(text)))
        sure: dict[str, int] = {}
        some: dict[str, int] = {}
        strange = False
        for c in text:
            s = script_of(c)
            if s is None:
                strange = strange or c in self.to_latin or ord(c) in self.table
                continue
            some[s] = some.get(s, 0) + 1
            latin = c if s == "latin" else self.to_latin.get(c)
            if latin is None or s == "latin" and c not in self.ambiguous:
                sure[s] = sure.get(s, 0) + 1
        if some and (len(some) > 1 or strange or "latin" in some):
            votes = sure or some
            script = max(votes, key=lambda s: (votes[s], s == "latin"))
            if script == "latin":
                text = "".join(c if c.isascii() or script_of(c) == "latin" and c not in self.to_latin else self.table.get(ord(c), c) if not unicodedata.category(c) == "So" else c for c in text)
            else:
                home = self.home[script]
                # A Latin word is a disguised one only if every letter of it has a twin here.
                text = "".join(w if w.isascii() and any(c.isalpha() and c not in home for c in w) else "".join(c if script_of(c) == script else home.get(c) or home.get(self.to_latin.get(c, ""), c) for c in w) for w in re.split(r"(\s+)", text))
        return unicodedata.normalize("NFC", text.casefold())


def python_column(df: DataFrame, function, source: str, target: str, kind: str = "string") -> DataFrame:
    """``df`` with ``target`` = function(source) in Arrow batches; null stays null."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf(kind)
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else function(v) for v in values.to_pylist()], pa.string())

    # Declared so, it is evaluated once: a filter on its result would else be pushed down with a copy of it.
    return df.withColumn(target, run.asNondeterministic()(F.col(source)))


def add_skeleton(df: DataFrame, source: str, target: str) -> DataFrame:
    """``df`` with the text's look in ``target``: null for null, empty for blank or invisible texts."""
    table = lookalike_table(df.sparkSession)
    return python_column(df, lambda s: skeleton(s, table), source, target)


def squeezed(c: Column) -> Column:
    """A text without regard to the number and place of ordinary spaces and tabs."""
    return F.trim(F.regexp_replace(c, "[ \\t]+", " "))


def distinct_records(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """(id, name), each delivered pair once, without null names."""
    return df.select(F.col(id_col).alias("id"), F.col(name_col).alias("name")).filter("id is not null and name is not null").distinct()


def same_look_pairs(df: DataFrame, id_col: str = "record_id", name_col: str = "record_name") -> DataFrame:
    """(id_a, id_b): records whose names look the same, but are not the same string.

    Spellings of one look are classes; classes are paired, not rows, and the pairs are then given their ids: many
    copies of one spelling meet another spelling once, and never each other. Blank and null names have no look.
    What it yields is exactly the pairs asked for.
    """
    rows = add_skeleton(distinct_records(df, id_col, name_col), "name", "look").filter("look <> ''").withColumn("spelling", squeezed(F.col("name")))
    rows = cut(rows.select("look", "id", F.unhex(F.md5("spelling")).alias("spelling")))
    looks = rows.groupBy("look").agg(F.min("spelling").alias("low"), F.max("spelling").alias("high")).filter("low <> high").select("look")
    mixed = cut(rows.join(looks, "look", "left_semi").select(F.unhex(F.md5("look")).alias("look"), "spelling", "id").distinct())
    classes = mixed.select("look", "spelling").distinct()
    pairs = classes.join(classes.select("look", F.col("spelling").alias("other")), "look").filter("spelling < other").select("spelling", "other", "look")
    left = pairs.join(mixed, ["look", "spelling"]).select("look", "other", F.col("id").alias("x"))
    both = left.join(mixed.select("look", F.col("spelling").alias("other"), F.col("id").alias("y")), ["look", "other"])
    return both.filter("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
