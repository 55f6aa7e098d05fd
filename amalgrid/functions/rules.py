"""The simple sanitiser: an ordered cascade of replacements, then casing."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgrid.functions.casing import cased_suffixes, smart_title
from amalgrid.functions.text import col, fold, title

# The cascade, in order: name, pattern, replacement.
RULES: tuple[tuple[str, str, str], ...] = (
    ("remove_percentages", r"\d+(?:\.\d+)?%\s+(?=\d)", ""),
    ("remove_dates", r"\d{1,2}/\d{1,2}/\d{2,4}", ""),
    ("remove_dates_iso", r"\b\d{4}-\d{2}-\d{2}\b", ""),
    ("remove_dates_european", r"\b\d{1,2}[-.]\d{1,2}[-.]\d{2,4}\b", ""),
    ("remove_long_numbers", r"\b\d{4,}\b(?!\s*(?:series|model|type|version))", ""),
    ("remove_leading_zz_marker", r"^z{2,}\s*", ""),
    ("remove_trailing_zz_marker", r"\s+z{2,}$", ""),
    ("remove_product_location_metadata", r"\s*\|.*$", ""),
    ("remove_parentheses", r"\s*\([^)]*\)", ""),
    ("normalize_dashes", r"\s+[-–—]\s+", " "),
    ("australian_proprietary_limited", r"\bproprietary\s+limited\b", "pty ltd"),
    ("australian_pty_ltd", r"\bpty\.?\s*ltd\.?\b", "pty ltd"),
    ("australian_pl_shorthand", r"\bp/?l\b\.?", "pty ltd"),
    ("singapore_pte_ltd", r"\bpte\.?\s*ltd\.?\b", "pte ltd"),
    ("malaysia_sdn_bhd", r"\bsdn\.?\s*bhd\.?\b", "sdn bhd"),
    ("malaysia_bhd", r"\bbhd\b\.?", "bhd"),
    ("us_incorporated", r"\binc(?:orporated)?\b\.?", "inc"),
    ("us_llc", r"\bl\.?l\.?c\.?\b", "llc"),
    ("partnership_llp", r"\bl\.?l\.?p\.?\b", "llp"),
    ("uk_commonwealth_limited", r"\blimited\b(?!\s+(?:liability|partnership))", "ltd"),
    ("remove_ltd_period", r"\bltd\b\.?", "ltd"),
    ("uk_public_company", r"\bplc\b\.?", "plc"),
    ("europe_sa", r"\bs\.?a\.?\b", "sa"),
    ("europe_srl", r"\bs\.?r\.?l\.?\b", "srl"),
    ("german_gmbh", r"\bgmbh\b\.?", "gmbh"),
    ("german_ag", r"\baktiengesellschaft\b", "ag"),
    ("asian_co_ltd_format", r"\bco\.?,?\s*ltd\.?", "company ltd"),
    ("asian_co_limited_format", r"\bco\.?,?\s*limited\b", "company ltd"),
    ("expand_co_to_company", r"\b(?<!pty\s)(?<!pte\s)(?<!&\s)co\b\.?(?!\s*ltd)(?!\s*kg)", "company"),
    ("expand_corp_to_corporation", r"\bcorp\b\.?(?!\s*(?:pty|ltd))", "corporation"),
    ("normalize_and_symbol", r"\s*&\s*", " and "),
    ("normalize_spaces", r"\s+", " "),
)
# What the older cascade has instead; it lacks the two rules named last and the one for "&".
LEGACY_PATTERNS = {
    "remove_percentages": r"\d+\.?\d*%.*?\b",
    "remove_long_numbers": r"\b\d{4,}\b",
    "remove_trailing_zz_marker": r"\s*z{2,}$",
    "australian_pty_ltd": r"\bpty\.?\s*ltd?\.?\b",
    "singapore_pte_ltd": r"\bpte\.?\s*ltd?\.?\b",
}
LEGACY_MISSING = ("normalize_and_symbol", "remove_dates_iso", "remove_dates_european")
LEGACY_RULES = tuple((n, LEGACY_PATTERNS.get(n, p), r) for n, p, r in RULES if n not in LEGACY_MISSING)


def load_rules(path: str | Path) -> tuple[tuple[str, str, str], ...]:
    """An ordered rule file: a JSON list of objects with name, pattern and replacement."""
    return tuple((r["name"], r["pattern"], r["replacement"]) for r in json.loads(Path(path).read_text(encoding="utf-8")))


def apply_rules(c: Column | str, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The cascade over a text as it stands (lower it first), then trimmed; null stays null."""
    return F.trim(fold(col(c), ((p, r) for _, p, r in rules)))


def clean_name(c: Column | str, rules: Sequence[tuple[str, str, str]] = RULES, smart: bool = False) -> Column:
    """Lower, cascade, title case (``smart``: by word), legal suffixes cased. Null reads as empty."""
    base = apply_rules(F.lower(F.coalesce(col(c), F.lit(""))), rules)
    return cased_suffixes(smart_title(base) if smart else title(base))


def clean_frame(df: DataFrame, source: str = "Name", target: str = "Clean_Name", rules: Sequence[tuple[str, str, str]] = RULES, smart: bool = False) -> DataFrame:
    if source not in df.columns:
        raise ValueError(f"no column {source!r}; there are {df.columns}")
    return df.withColumn(target, clean_name(F.col(f"`{source}`"), rules, smart))
