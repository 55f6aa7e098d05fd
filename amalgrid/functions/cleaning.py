"""The advanced sanitiser: normal form, record type, display and canonical names, match keys.

Every function maps a Column to a Column; null reads as the empty text. All but Unicode compatibility
normalisation are built-in expressions; that one goes through Arrow and leaves ASCII texts alone.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amalgrid.functions.text import col, fold, title

# Patterns and word lists of the sanitiser.
SECURITY = r"(?:\d{1,2}\.\d{1,3}%|\b(?:class|series)\s+[a-z0-9\-]+|\b(?:adr|american depositary)\b|\b\d{8}\b)"
GOVERNMENT = r"\b(ministry|department|council|university|hospital|city of|state of)\b"
TRUST = r"\b(the trustee for|trust|superannuation|pension fund|fund)\b"
TRADING_AS = r"\b(t/a|t\/a|trading as|dba|t-as|t as)\b"
DESIGNATORS = (
    (r"\bproprietary\s+limited\b", "pty ltd"),
    (r"\bpty\.?\s*ltd\.?\b", "pty ltd"),
    (r"\binc(?:orporated)?\.?\b", "inc"),
    (r"\blimited\b", "ltd"),
    (r"\bltd\.?\b", "ltd"),
    (r"\bplc\b", "plc"),
    (r"\bgmbh\b", "gmbh"),
    (r"\bs\.?a\.?\b", "sa"),
    (r"\bs\.?r\.?l\.?\b", "srl"),
    (r"\baktiengesellschaft\b|\bag\b", "ag"),
    (r"\bco\.?\b", "co"),
    (r"\bcompany\b", "co"),
)
STOPWORDS = "holdings holding group company co services service international australia australian aust pty ltd plc inc sa srl gmbh ag bv llc llp lp limited pt pte pte.".split()
DESIGNATOR_WORDS = "pty ltd plc sa ag llc llp bv gmbh srl inc co".split()
PLACES = r"\((?:australia|au|nsw|vic|qld|wa|sa|tas|act|nt|singapore|china|uk|usa|us|canada)\)"
EDGES = ((r"\s+", " "), (r"^[\s,.;:/\\&-]+", ""), (r"[\s,.;:/\\&-]+$", ""))
DASHES_AND_QUOTES = ("–—− “”‘’", "--- \"\"''")
MODEL_CONFIDENCE = 0.6


@F.arrow_udf(T.StringType())
def _compatible(values: pa.Array) -> pa.Array:
    return pa.array([s if s is None or s.isascii() else unicodedata.normalize("NFKC", s) for s in values.to_pylist()], pa.string())


def nfkc(c: Column | str) -> Column:
    return _compatible(col(c))


def plain_marks(c: Column | str) -> Column:
    return F.translate(col(c), *DASHES_AND_QUOTES)


def trim_edges(c: Column | str) -> Column:
    return fold(col(c), EDGES)


def normalize(c: Column | str, ascii_only: bool = False) -> Column:
    """Lower case, compatibility form, plain marks, trimmed edges; ``ascii_only`` skips the Arrow step."""
    low = F.lower(F.coalesce(col(c), F.lit("")))
    return trim_edges(plain_marks(low if ascii_only else nfkc(low)))


def route_type(c: Column | str) -> Column:
    """security, trust, government or company: the first that applies."""
    c = col(c)
    return F.when(c.rlike("(?U)" + SECURITY), "security").when(c.rlike("(?U)" + TRUST), "trust").when(c.rlike("(?U)" + GOVERNMENT), "government").otherwise("company")


def strip_trading_as(c: Column | str) -> Column:
    return trim_edges(fold(col(c), ((r"^\bthe trustee for\b\s+", ""), (TRADING_AS, " "))))


def designators(c: Column | str) -> Column:
    return trim_edges(fold(col(c), DESIGNATORS))


def drop_places(c: Column | str) -> Column:
    return trim_edges(fold(col(c), ((PLACES, ""),)))


def display_name(c: Column | str) -> Column:
    return designators(drop_places(strip_trading_as(c)))


def canonical_name(c: Column | str, shown: Column | None = None) -> Column:
    """``shown`` is ``designators(c)`` where that is at hand, here and below."""
    parts = F.transform(F.split(designators(c) if shown is None else shown, " "), lambda w: F.when(w.isin(DESIGNATOR_WORDS), F.upper(w)).otherwise(title(w)))
    return trim_edges(F.array_join(parts, " "))


def match_key_strict(c: Column | str, shown: Column | None = None) -> Column:
    return trim_edges(fold(designators(c) if shown is None else shown, ((r"\b(?:" + "|".join(DESIGNATOR_WORDS) + r")\b", " "), (r"[^a-z0-9]+", " "))))


def match_key_aggressive(c: Column | str, shown: Column | None = None) -> Column:
    spaced = fold(designators(c) if shown is None else shown, (("&", " and "), (r"[^a-z0-9 ]+", " ")))
    kept = F.filter(F.split(spaced, " +"), lambda w: (w != "") & ~w.isin(STOPWORDS))
    return trim_edges(F.array_join(kept, " "))


def final_type(type_hint: Column | str, model_type: Column | str, confidence: Column | str, least: float = MODEL_CONFIDENCE) -> Column:
    """The model's type where it is sure enough, else the rule's."""
    return F.when(F.coalesce(col(confidence), F.lit(0.0)) >= F.lit(least), col(model_type)).otherwise(col(type_hint))


def sanitise(df: DataFrame, source: str = "record_name", ascii_only: bool = False, model: tuple[str, str] | None = None) -> DataFrame:
    """``df`` with orig, norm, type_hint, display_name, canonical_name, match_key_strict and match_key_aggressive.

    Columns of these names that ``df`` already has are replaced. ``model`` names the columns of a
    classifier's type and confidence. Works on batches and streams alike: no state, no shuffle.
    """
    out = df.withColumn("orig", F.coalesce(F.col(source), F.lit(""))).withColumn("norm", normalize(source, ascii_only))
    hint = route_type("norm") if model is None else final_type(route_type("norm"), *model)
    shown = display_name("norm")
    out = out.withColumns({"type_hint": hint, "display_name": shown})
    # The designators of the shown name are folded once for all three.
    again = F.col("_shown")
    made = out.withColumn("_shown", designators("display_name"))
    return made.withColumns({"canonical_name": canonical_name("display_name", again), "match_key_strict": match_key_strict("display_name", again), "match_key_aggressive": match_key_aggressive("display_name", again)}).drop("_shown")
