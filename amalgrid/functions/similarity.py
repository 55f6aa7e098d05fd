"""Explainable similarities of two names, from 0 to 1, on the normal form of pair scoring.

All but two are built-in expressions. The edit distance with swaps and the phonetic one have no
built-in form and run on Arrow batches.
"""

from __future__ import annotations

import difflib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amalgrid.functions.pairnames import company_name, core_name
from amalgrid.functions.text import col, words

BASE_FEATURES = ["levenshtein", "jaccard", "cosine", "hamming", "damerau_levenshtein", "editex"]
ALL_FEATURES = [*BASE_FEATURES, "token_jaccard", "token_overlap", "core_name_similarity"]


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _both(a: Column, b: Column, value: Column) -> Column:
    """0 where either side is empty."""
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(value)


def levenshtein(a: Column, b: Column) -> Column:
    return _both(a, b, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def _bigrams(s: Column) -> Column:
    return F.when(F.length(s) < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - 1, F.lit(1))), lambda i: F.substr(s, i, F.lit(2)))))


def _set_ratio(x: Column, y: Column, both: float, one: float) -> Column:
    union = F.size(F.array_union(x, y))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(both)).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(one)).otherwise(F.size(F.array_intersect(x, y)) / union)


def jaccard(a: Column, b: Column) -> Column:
    """Of the sets of letter pairs; two names without any are alike, however they differ."""
    return _both(a, b, _set_ratio(_bigrams(a), _bigrams(b), 1.0, 0.0))


def cosine(a: Column, b: Column) -> Column:
    """Of the letter counts, blanks included."""

    def count(s: Column, c: Column) -> Column:
        return (F.length(s) - F.length(F.replace(s, c, F.lit("")))).cast("double")

    def total(s: Column, value) -> Column:
        return F.aggregate(F.array_distinct(_chars(s)), F.lit(0.0), lambda acc, c: acc + value(c))

    dot = total(a, lambda c: count(a, c) * count(b, c))
    return _both(a, b, dot / (F.sqrt(total(a, lambda c: count(a, c) * count(a, c))) * F.sqrt(total(b, lambda c: count(b, c) * count(b, c)))))


def hamming(a: Column, b: Column) -> Column:
    """Places that agree, the shorter name filled up with blanks."""
    n = F.greatest(F.length(a), F.length(b))
    same = F.zip_with(_chars(F.rpad(a, n, " ")), _chars(F.rpad(b, n, " ")), lambda x, y: F.when(x == y, 1).otherwise(0))
    return _both(a, b, F.aggregate(same, F.lit(0), lambda acc, x: acc + x) / n)


def swap_distance(a: str, b: str, restricted: bool = True) -> int:
    """Edits with swaps of neighbours. ``restricted``: no part is edited twice; else swaps may span edits."""
    if not restricted:
        last: dict[str, int] = {}
        far = len(a) + len(b)
        d = {(-1, -1): far}
        for i in range(len(a) + 1):
            d[i, -1], d[i, 0] = far, i
        for j in range(len(b) + 1):
            d[-1, j], d[0, j] = far, j
        for i in range(1, len(a) + 1):
            seen = 0
            for j in range(1, len(b) + 1):
                k, m = last.get(b[j - 1], 0), seen
                cost = a[i - 1] != b[j - 1]
                if not cost:
                    seen = j
                d[i, j] = min(d[i - 1, j - 1] + cost, d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1))
            last[a[i - 1]] = i
        return d[len(a), len(b)]
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                best = min(best, two[j - 2] + 1)
            row.append(best)
        two, one = one, row
    return one[-1]


# Groups of letters that sound alike.
_SOUNDS = [set(g) for g in ("AEIOUY", "BP", "CKQ", "DT", "LR", "MN", "GJ", "FPV", "SXZ", "CSZ")]


def phonetic_distance(a: str, b: str) -> int:
    """Edit costs by sound: 0 for the same letter, 1 within a group (or beside a silent H or W), 2 else."""
    a, b = a.upper(), b.upper()

    def swap(x: str, y: str) -> int:
        return 0 if x == y else 1 if any(x in g and y in g for g in _SOUNDS) else 2

    def drop(x: str, y: str) -> int:
        return 1 if x in "HW" and x != y else swap(x, y)

    a, b = " " + a, " " + b
    row = [0]
    for j in range(1, len(b)):
        row.append(row[-1] + drop(b[j - 1], b[j]))
    for i in range(1, len(a)):
        before, row = row, [row[0] + drop(a[i - 1], a[i])]
        for j in range(1, len(b)):
            row.append(min(before[j] + drop(a[i - 1], a[i]), row[j - 1] + drop(b[j - 1], b[j]), before[j - 1] + swap(a[i], b[j])))
    return row[-1]


def _arrow_pair(function):
    @F.arrow_udf(T.DoubleType())
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else function(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())

    return run


damerau_levenshtein = _arrow_pair(lambda x, y: 1 - swap_distance(x, y) / max(len(x), len(y)) if x and y else 0.0)
damerau_levenshtein_full = _arrow_pair(lambda x, y: 1 - swap_distance(x, y, False) / max(len(x), len(y)) if x and y else 0.0)
editex = _arrow_pair(lambda x, y: 1 - min(phonetic_distance(x, y) / (2 * max(len(x), len(y))), 1.0) if x and y else 0.0)
sequence_ratio = _arrow_pair(lambda x, y: difflib.SequenceMatcher(None, x.lower(), y.lower()).ratio())


def token_jaccard(a: Column, b: Column) -> Column:
    return _set_ratio(F.array_distinct(words(a)), F.array_distinct(words(b)), 1.0, 0.0)


def token_overlap(a: Column, b: Column) -> Column:
    x, y = F.array_distinct(words(a)), F.array_distinct(words(b))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.least(F.size(x), F.size(y)))


def lower_token_overlap(a: Column | str, b: Column | str) -> Column:
    """``token_jaccard`` of two texts as they stand, in lower case; two empty ones are 1."""
    return token_jaccard(F.lower(col(a)), F.lower(col(b)))


def add_features(df: DataFrame, left: str = "company1", right: str = "company2", python: bool = True) -> DataFrame:
    """``df`` with the nine features of each pair; ``python=False`` leaves out the two without a built-in form.

    Names are normalised once per row; null counts as empty.
    """
    made = df.withColumns({"_a": company_name(left), "_b": company_name(right), "_ca": core_name(company_name(left)), "_cb": core_name(company_name(right))})
    a, b = F.col("_a"), F.col("_b")
    made = made.withColumns({"levenshtein": levenshtein(a, b), "jaccard": jaccard(a, b), "cosine": cosine(a, b), "hamming": hamming(a, b)})
    if python:
        made = made.withColumns({"damerau_levenshtein": damerau_levenshtein(a, b), "editex": editex(a, b)})
    made = made.withColumns({"token_jaccard": token_jaccard(a, b), "token_overlap": token_overlap(a, b), "core_name_similarity": levenshtein(F.col("_ca"), F.col("_cb"))})
    return made.drop("_a", "_b", "_ca", "_cb")


# --- comparison of a name with its cleaned form ---------------------------------------------------

# Endings that count as a standard legal suffix.
STANDARD_SUFFIXES = ["PTY LTD", "LTD", "LIMITED", "INC", "LLC", "PLC", "CORPORATION", "CORP", "CO.", "GMBH", "SA", "AB", "NV", "BV", "SDN BHD", "PTE LTD"]


def edit_distance_lower(a: Column | str, b: Column | str) -> Column:
    return F.levenshtein(F.lower(col(a)), F.lower(col(b)))


def distance_percent(distance: Column, original: Column | str) -> Column:
    n = F.length(col(original))
    return F.when(n > 0, distance / n * 100).otherwise(F.lit(0.0))


def closer(first: Column, second: Column) -> Column:
    """Which of two cleaned forms is nearer: cleaned, sanitised or same."""
    return F.when(first < second, "cleaned").when(second < first, "sanitised").otherwise("same")


def change_kind(original: Column | str, changed: Column | str) -> Column:
    o, m = col(original), col(changed)
    d = edit_distance_lower(o, m)
    return (
        F.when(d == 0, "no_change").when(F.lower(o) == F.lower(m), "case_only").when(F.length(m) > F.length(o) * F.lit(1.5), "major_expansion").when(F.length(m) < F.length(o) * F.lit(0.7), "major_reduction").when(d <= 5, "minor_edit").otherwise("major_edit")
    )


def has_standard_suffix(c: Column | str) -> Column:
    return F.coalesce(F.upper(col(c)).rlike("(" + "|".join(s.replace(".", r"\.") for s in STANDARD_SUFFIXES) + ")$"), F.lit(False))


def is_title_case(c: Column | str) -> Column:
    w = words(c)
    return (F.size(w) > 0) & F.forall(w, lambda x: x.rlike(r"^\p{Lu}"))


def count_of(c: Column | str, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(col(c), F.lit("")), F.lit(pattern))
