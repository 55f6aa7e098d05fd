"""Casing of names: title case by word, legal suffixes, acronyms."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from amalgrid.functions.text import col, fold, title, words

# Casing tables.
UPPER_WORDS = "pty ltd inc llc llp plc sa srl gmbh ag pte bhd sdn nz au uk us eu".split()
SPECIAL_WORDS = {"3m": "3M", "ibm": "IBM", "hp": "HP", "it": "IT", "ai": "AI", "io": "IO"}
SMALL_WORDS = "of and the a an for at by to in on".split()
SUFFIXES = (
    (r"\bPTY\s+LTD\b", "Pty Ltd"),
    (r"\bPTY\s+LIMITED\b", "Pty Limited"),
    (r"\bPTE\s+LTD\b", "Pte Ltd"),
    (r"\bLTD\b", "Ltd"),
    (r"\bLIMITED\b", "Limited"),
    (r"\bINC\b", "Inc"),
    (r"\bCORP\b", "Corp"),
    (r"\bCORPORATION\b", "Corporation"),
    (r"\bCO\b", "Co"),
    (r"\bGMBH\b", "GmbH"),
    (r"\bAG\b", "AG"),
    (r"\bSA\b", "SA"),
    (r"\bNV\b", "N.V."),
    (r"\bBV\b", "B.V."),
    (r"\bAB\b", "AB"),
    (r"\bSDN\s+BHD\b", "Sdn Bhd"),
    (r"\bPVT\b", "Pvt"),
    (r"\bPVT\s+LTD\b", "Pvt Ltd"),
    (r"\bLLC\b", "LLC"),
    (r"\bLLP\b", "LLP"),
    (r"\bPLC\b", "PLC"),
    (r"\bL\.P\.\b", "L.P."),
    (r"\bL\.L\.C\.\b", "LLC"),
    (r"\bS\.A\.R\.L\.\b", "S.à r.l."),
    (r"\bS\.A\.R\.L\b", "S.à r.l."),
)
ACRONYMS = "IBM HP AT&T IT AI UK US NSW QLD VIC ACT NT SA WA TAS ABN ACN NZ USA EU UAE CEO CFO CTO HR IT PR RD IP TV BMW VW GM GE BP CVS UPS FedEx DHL".split()


def smart_title(c: Column | str) -> Column:
    """By word: known special forms, upper-case designators, small words inside, title case else."""
    special = F.create_map(*[F.lit(x) for kv in SPECIAL_WORDS.items() for x in kv])

    def one(w: Column, i: Column) -> Column:
        low = F.lower(w)
        return F.when(special[low].isNotNull(), special[low]).when(low.isin(UPPER_WORDS), F.upper(w)).when((i > 0) & low.isin(SMALL_WORDS), low).otherwise(title(w))

    return F.array_join(F.transform(words(c), one), " ")


def suffix_case(c: Column | str) -> Column:
    """Legal suffixes in their usual case wherever they stand as words; null and empty pass."""
    return fold(col(c), SUFFIXES, "(?iu)")


def cased_suffixes(c: Column | str, acronyms: bool = True) -> Column:
    """``suffix_case``, then each listed acronym in its listed case, whole words only."""
    c = suffix_case(c)
    return fold(c, ((r"\b" + re.escape(a) + r"\b", a) for a in ACRONYMS), "(?iu)") if acronyms else c


def config_hash(config: dict) -> str:
    """md5 of the configuration as JSON with sorted keys."""
    return hashlib.md5(json.dumps(config, sort_keys=True).encode()).hexdigest()
