"""Sentence units of the prose in many languages and scripts.

What a period means is learned from the corpus itself, without labels, per language: abbreviations
(words that keep their period), frequent sentence starters and collocations across a period, each by a
log-likelihood ratio over counts of all documents. Each period is then classified with these statistics
and the letter case of what follows. Marks that can only end a sentence need no statistics.
The counts are three partial aggregations; the model holds only what passes its test.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgrid.session import cut

ABBREVIATION, STARTER, COLLOCATION = 0.3, 30.0, 7.88
#: Rows of one broadcast model; beyond it, each language gets a pass and a model of its own.
MODEL_ROWS = 1_000_000

# --- languages --------------------------------------------------------------------------------

# Frequent words that tell languages of the Latin script apart.
_FREQUENT = {
    "en": "the of and is to in that this are no it we for with not only on by from all".split(),
    "de": "der die das und ist für den wir im am von sind wird zu als nicht ein auf mit".split(),
    "fr": "le la les est à des du nous dans et un une trop sont il que pour sur ce au".split(),
    "es": "el los las es por la del se una que como y en con para lo su un más al".split(),
    "pt": "o os as é do da e se na ao com um uma que por não em parece está".split(),
    "it": "il lo gli è di che per una con non sono della nel più alla dei questo si ha le".split(),
    "nl": "de het een van en is op te dat niet voor met zijn er aan ook als bij naar om".split(),
}
_VOTES: dict[str, list[str]] = {}
for _lang, _words in _FREQUENT.items():
    for _w in _words:
        _VOTES.setdefault(_w, []).append(_lang)
_SCRIPTS = [(name, regex.compile(rf"\p{{{script}}}")) for name, script in (("ru", "Cyrillic"), ("el", "Greek"), ("hi", "Devanagari"), ("ar", "Arabic"), ("am", "Ethiopic"), ("th", "Thai"), ("lo", "Lao"), ("ja", "Hiragana"), ("zh", "Han"), ("ko", "Hangul"), ("he", "Hebrew"), ("hy", "Armenian"), ("ka", "Georgian"), ("km", "Khmer"), ("my", "Myanmar"), ("bo", "Tibetan"), ("bn", "Bengali"), ("pa", "Gurmukhi"), ("gu", "Gujarati"), ("or", "Oriya"), ("ta", "Tamil"), ("te", "Telugu"), ("kn", "Kannada"), ("ml", "Malayalam"), ("si", "Sinhala"))]
_BY_SCRIPT = frozenset(name for name, _ in _SCRIPTS)
#: The share of frequent words that prose of a listed language has at least.
_LISTED = 0.15
_OTHER = regex.compile("[" + "".join(r.pattern for _, r in _SCRIPTS) + "]")
_LATIN = regex.compile(r"\p{Latin}")
_WORDS = re.compile(r"[^\W\d_]+")


def language(text: str, declared: str | None = None) -> str:
    """The language of a piece of prose: by script, and for Latin script by its most frequent words.

    What the document declares decides between equal votes, and where too few of the words are frequent ones of
    any language listed: other languages have statistics of their own, not those of a listed one.
    """
    if not text.isascii() and _OTHER.search(text):
        counts = {name: n for name, r in _SCRIPTS if (n := len(r.findall(text)))}
        name = "ja" if "ja" in counts else max(counts, key=lambda k: counts[k])
        if name in ("th", "ja", "zh") or counts[name] * 2 >= len(_LATIN.findall(text)):
            return name
    votes: dict[str, int] = {}
    words = _WORDS.findall(text.lower())
    for w in words:
        for lang in _VOTES.get(w, ()):
            votes[lang] = votes.get(lang, 0) + 1
    declared = declared if declared and declared != "und" and declared not in _BY_SCRIPT else None
    best = max(_FREQUENT, key=lambda k: (votes.get(k, 0), k == declared)) if votes else declared or "en"
    if declared and declared not in _FREQUENT and votes.get(best, 0) < _LISTED * len(words):
        return declared
    return best


# --- units ------------------------------------------------------------------------------------

_HEADING = regex.compile(r"[ \t]{0,3}#{1,6}[ \t]+(?:\d+(?:\.\d+)*\.?[ \t]+)?")
_ITEM = regex.compile(r"[ \t]*(?:[-*+•‣◦]|\(?\d{1,9}[.)]|\(?[a-zA-Z]\))[ \t]+")
_QUOTE = regex.compile(r"[ \t]{0,3}>[ \t>]*")
_MARKED = frozenset(" \t#>-*+•‣◦([0123456789")


def units(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, body): headings, list lines and paragraphs; the body begins after the leading mark."""
    begin = body = end = -1
    quoted = False
    start = 0
    for line in text.split("\n"):
        after = start + len(line) + 1
        line = line.rstrip("\r")
        stop = start + len(line)
        if not line or line.isspace():
            if begin >= 0:
                yield begin, end, body
            begin, quoted = -1, False
            start = after
            continue
        mark, quote, m = start, None, None
        if line[0] in _MARKED or line[1:2] in (")", "."):
            quote = _QUOTE.match(line)
            mark = start + (quote.end() if quote else 0)
            inner = text[mark:stop]
            m = _HEADING.match(inner) or _ITEM.match(inner)
        if m:
            if begin >= 0:
                yield begin, end, body
            yield start, stop, mark + m.end()
            begin, quoted = -1, False
            start = after
            continue
        if begin >= 0 and bool(quote) != quoted:
            yield begin, end, body
            begin = -1
        if begin < 0:
            begin, body, quoted = start, mark, bool(quote)
        end = stop
        start = after
    if begin >= 0:
        yield begin, end, body


# --- tokens and candidates --------------------------------------------------------------------

_OPEN, _CLOSE = "([{“„«‹「『（【《〈‘¿¡", ")]}”»›」』）】》〉’"
_PAIRS = {"(": ")", "[": "]", "{": "}", "“": "”", "„": "“", "«": "»", "‹": "›", "「": "」", "『": "』", "（": "）", "【": "】", "《": "》", "〈": "〉"}
_CLOSERS = "\"'*_`" + _CLOSE + "“"
#: A mark that ends a sentence, what closes after it, and whether a blank or the end follows.
_END = re.compile(rf"(\.{{2,}}|…+|[.。．｡！？!?؟।॥።፧᙮։۔;;⁇⁈⁉‽។៕။།༎]+)([  ](?=»)|)([{re.escape(_CLOSERS)}»]*)")
_TOKEN = regex.compile(r"\S+")
_STRIP = "\"'`*_~" + _OPEN + _CLOSE + "“,:;!?…"
_NUMBER = regex.compile(r"[-+]?\p{Nd}+(?:[.,:/]\p{Nd}+)*%?")
_WIDE = "。．｡！？"
_FINAL = "।॥።፧᙮؟۔։⁇⁈⁉‽។៕။།༎"


@lru_cache(maxsize=1 << 17)
def word_type(token: str) -> str:
    """A token without its outer marks and final period, in lower case; one type for all numbers."""
    t = token.strip(_STRIP)
    t = t[:-1] if t.endswith(".") else t
    return "#" if _NUMBER.fullmatch(t) else t.lower()


@lru_cache(maxsize=1 << 17)
def first_letter(token: str) -> str:
    for c in token:
        if c.isalnum():
            return c
    return ""


_PAIRED = re.compile("[" + re.escape('"' + "".join(_PAIRS) + "".join(_PAIRS.values())) + "]")


class Marks:
    """What stands inside quotes and brackets that close within the unit."""

    def __init__(self, s: str):
        self.inside = bytearray(len(s) + 1)
        self.starts: dict[int, int] = {}
        stack: list[tuple[str, int]] = []
        for i, c in ((m.start(), m[0]) for m in _PAIRED.finditer(s)):
            if c == '"':
                if stack and any(x[0] == '"' for x in stack):
                    while stack[-1][0] != '"':
                        stack.pop()
                    self._close(stack.pop()[1], i)
                elif i + 1 < len(s) and not s[i + 1].isspace():
                    stack.append(('"', i))
            elif stack and c == stack[-1][0]:
                self._close(stack.pop()[1], i)
            elif c in _PAIRS and not (c == "“" and any(x[0] == "“" for x in stack)):
                stack.append((_PAIRS[c], i))
            elif c in ")]}”“»›」』）】》〉" and any(x[0] == c for x in stack):
                while stack[-1][0] != c:
                    stack.pop()
                self._close(stack.pop()[1], i)

    def _close(self, low: int, high: int) -> None:
        self.starts[high] = low
        self.inside[low:high] = b"\1" * (high - low)


class Model:
    """The learned statistics of one or more languages."""

    def __init__(self, rows: list[tuple[str, str, str]]):
        self.abbr: dict[str, set[str]] = {}
        self.start: dict[str, set[str]] = {}
        self.pair: dict[str, set[str]] = {}
        self.lower: dict[str, set[str]] = {}
        self.inner: dict[str, set[str]] = {}
        for lang, kind, value in rows:
            getattr(self, kind).setdefault(lang, set()).add(value)

    def breaks(self, lang: str, token: str, following: str) -> bool:
        """Whether the period at the end of ``token`` ends a sentence when ``following`` comes next."""
        t, n = word_type(token), word_type(following)
        c = first_letter(following)
        none: frozenset[str] = frozenset()
        initial = len(t) == 1 and t.isalpha()
        tail = t.rsplit("-", 1)[-1]
        abbr = t in self.abbr.get(lang, none) or (tail != t and tail in self.abbr.get(lang, none))
        lower_seen, inner_seen = n in self.lower.get(lang, none), n in self.inner.get(lang, none)
        starts = c.isupper() and lower_seen and not inner_seen
        if f"{t}\t{n}" in self.pair.get(lang, none) and not starts:
            return False
        if abbr:
            return (starts or (c.isupper() and n in self.start.get(lang, none))) and not (initial and not starts)
        if initial or t == "#":
            if c.islower() and (t == "#" or not c == following[:1]) and "_" not in following and "." not in following[:-1]:
                return False
            if initial and c.isupper() and not lower_seen:
                return n in self.start.get(lang, none)
        return True


def boundaries(s: str, lang: str, model: Model | None, on_period=None) -> Iterator[int]:
    """Ends of the sentences of one unit's body. ``on_period(token, following, inside)`` sees each open period."""
    n = len(s)
    if lang in ("th", "lo"):
        for m in regex.finditer(r"\s+", s):
            yield m.start()
        yield n
        return
    marks = Marks(s) if _PAIRED.search(s) else None
    if marks and not marks.starts:
        marks = None
    search = _END.search
    greek = lang == "el"
    at = 0
    while m := search(s, at):
        mark, spaced, close = m.groups()
        stop = at = m.end()
        close_from = m.end(1)
        if stop < n and not close and not spaced and mark == "." and not s[stop].isspace():
            continue
        # A closing mark belongs to this sentence only if it closes something opened before.
        if close and close[-1] in "“\"«" and not (marks and stop - 1 in marks.starts):
            stop -= 1
        if spaced and not close:
            stop = close_from
        gap = stop >= n or s[stop].isspace()
        if not greek and not mark.strip(";;"):
            continue
        quoted = False
        if marks:
            inside = marks.inside
            if inside[m.start()] and (inside[close_from] if stop <= close_from else inside[stop - 1] and stop < n and inside[stop]):
                continue
            if stop < n and inside[stop] and stop not in marks.starts.values():
                continue
            quoted = any(k in marks.starts for k in range(close_from, stop))
        rest = s[stop:].lstrip()
        if not rest:
            break
        if quoted and rest[0] in ",;:–—-،、，":
            continue
        last = mark[-1]
        plain = mark == "."
        wide = not plain and any(c in _WIDE for c in mark)
        if wide or (mark[0] == "…" and not gap and ord(rest[0]) > 0x2E7F):
            if quoted and not gap and rest[0] not in "「『“《（【":
                continue
            yield stop
            continue
        if not plain and any(c in _FINAL for c in mark):
            if not (quoted and first_letter(rest).islower()):
                yield stop
            continue
        if not gap:
            continue
        following = rest.split(None, 1)[0]
        letter = first_letter(following)
        if quoted:
            head = s[marks.starts[max(k for k in range(close_from, stop) if k in marks.starts)]]
            if letter.islower() and "_" not in following and "." not in following.rstrip("."):
                continue
            if head in "([{" and not (marks.starts and letter):
                continue
            yield stop
            continue
        if mark[0] == "…" or (len(mark) > 1 and set(mark) == {"."}):
            if not letter.islower() and rest[0] not in ",;:–—-":
                yield stop
            continue
        if last in "!?;;" or "!" in mark or "?" in mark:
            # French sets a blank before the mark; a mark alone still ends what stands before it.
            if rest[0] not in ",;:–—" and not (last in ";;" and not regex.search(r"\p{Greek}\W*$", s[max(0, m.start() - 3) : m.start()])):
                yield stop
            continue
        left = s.rfind(" ", 0, m.start()) + 1
        left = max(left, s.rfind("\n", 0, m.start()) + 1, s.rfind("\t", 0, m.start()) + 1)
        token = s[left : close_from]
        if on_period:
            on_period(token, following)
        if model is None or model.breaks(lang, token, following):
            yield stop
    yield n


def unit_sentences(unit: str, lead: int, lang: str, model: Model) -> Iterator[tuple[int, int]]:
    """(start, end) of every sentence of one unit, without surrounding blanks."""
    begin = 0
    for stop in boundaries(unit[lead:], lang, model):
        piece = unit[begin : lead + stop]
        a = begin + len(piece) - len(piece.lstrip())
        b = begin + len(piece.rstrip())
        if a < b:
            yield a, b
        begin = lead + stop


def sentences(text: str, model: Model) -> Iterator[tuple[int, int]]:
    """(start, end) of every sentence of one piece of prose."""
    whole = language(text)
    for start, end, body in units(text):
        lang = language(text[body:end]) if end - body > 20 else whole
        for a, b in unit_sentences(text[start:end], body - start, lang, model):
            yield start + a, start + b


# --- statistics over all documents ------------------------------------------------------------


def _prose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> units of their text cells: (doc_id, at, lead, lang, unit). Cells beyond the text are clipped."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()]
    names = ["doc_id", "at", "lead", "lang", "unit"]
    for whole in batches:
        for low in range(0, whole.num_rows, 1000):
            batch = whole.slice(low, 1000)
            out: tuple[list, ...] = ([], [], [], [], [])
            cells = batch.column(2)
            flat = cells.flatten()
            kind, start_at, end_at = (pc.struct_field(flat, f).to_pylist() for f in ("kind", "start_at", "end_at"))
            at = 0
            for doc, text, size, declared in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pc.list_value_length(cells).to_pylist(), batch.column(3).to_pylist()):
                mine = range(at, at + (size or 0))
                at += size or 0
                if not text:
                    continue
                for k in mine:
                    if kind[k] != "text" or start_at[k] is None or end_at[k] is None:
                        continue
                    a, b = max(0, start_at[k]), min(len(text), end_at[k])
                    if a >= b:
                        continue
                    prose, whole_lang = text[a:b], None
                    for start, end, body in units(prose):
                        if end - body > 20:
                            lang = language(prose[body:end], declared)
                        else:
                            lang = whole_lang = whole_lang or language(prose, declared)
                        for c, v in zip(out, (doc, a + start, body - start, lang, prose[start:end])):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)


def prose_units(docs: DataFrame) -> DataFrame:
    """(doc_id, at, lead, lang, unit): headings, list lines and paragraphs of the text cells of all documents."""
    declared = F.lower(F.substring_index(F.col("lang").cast("string"), "-", 1)) if "lang" in docs.columns else F.lit(None).cast("string")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "cells", declared.alias("lang"))
    return source.mapInArrow(_prose, "doc_id long, at int, lead int, lang string, unit string")


def _bodies(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    for lead, lang, unit in zip(*(batch.column(k).to_pylist() for k in range(2, 5))):
        yield lang, unit[lead:]


def _emit(counts: Counter) -> pa.RecordBatch:
    rows = list(counts.items())
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()), pa.array([k[2] for k, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["lang", "kind", "value", "n"])


_FLUSH = 200_000


@lru_cache(maxsize=1 << 17)
def _dotted(token: str) -> tuple[str, str] | None:
    """(kind, type) of a token for the count of final periods; a quoted or bracketed end tells nothing of the word."""
    core = token.strip(_STRIP)
    t = word_type(token)
    if not t or (core.endswith(".") and not token.endswith(".") and token[-1] in _CLOSERS):
        return None
    return "dot" if core.endswith(".") and not core.endswith("..") else "bare", t


def _count_types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens with and without a final period."""
    tokens: dict[str, Counter] = {}
    for batch in batches:
        for lang, s in _bodies(batch):
            if lang not in tokens:
                tokens[lang] = Counter()
            tokens[lang].update(s.split())
        if sum(map(len, tokens.values())) > _FLUSH:
            yield _emit(_by_type(tokens))
            tokens = {}
    if tokens:
        yield _emit(_by_type(tokens))


def _by_type(tokens: dict[str, Counter]) -> Counter:
    counts: Counter = Counter()
    for lang, c in tokens.items():
        for token, n in c.items():
            if (k := _dotted(token)) is not None:
                counts[lang, k[0], k[1]] += n
    return counts


@lru_cache(maxsize=1 << 17)
def _seen(token: str) -> tuple[str, str, bool, bool]:
    """(type, letter case, may stand within a sentence, is a number or an initial)."""
    t, c = word_type(token), first_letter(token)
    case = "lower" if c.islower() else "upper" if c.isupper() else ""
    return t, case, token[0] not in _OPEN + "\"'", t == "#" or len(t) == 1 and t.isalpha()


def _count_contexts(abbr: dict[str, set[str]]):
    """Letter case, starters and pairs across a period, given the abbreviations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model([(lang, "abbr", t) for lang, ts in abbr.items() for t in ts])
        counts: Counter = Counter()
        plain: dict[str, Counter] = {}
        first: Counter = Counter()
        pairs: Counter = Counter()

        def flush() -> pa.RecordBatch:
            for lang, c in plain.items():
                for token, n in c.items():
                    t, case, within, _ = _seen(token)
                    counts[lang, "total", ""] += n
                    if t:
                        counts[lang, "all", t] += n
                        if case == "lower":
                            counts[lang, "lower", t] += n
                        elif case == "upper" and within and n > first[lang, token]:
                            counts[lang, "inner", t] += n - first[lang, token]
            for (lang, token, following), n in pairs.items():
                t, f = word_type(token), word_type(following)
                counts[lang, "pair", f"{t}\t{f}"] += n
                counts[lang, "dotted", t] += n
            made = _emit(counts)
            for c in (counts, plain, first, pairs):
                c.clear()
            return made

        for batch in batches:
            for lang, s in _bodies(batch):
                words = s.split()
                if not words:
                    continue
                if lang not in plain:
                    plain[lang] = Counter()
                plain[lang].update(words)
                first[lang, words[0]] += 1
                if lang in ("th", "lo"):
                    continue

                def on_period(token: str, following: str, lang: str = lang) -> None:
                    pairs[lang, token, following] += 1
                    # What follows a period of whatever kind stands neither at a start nor within for sure.
                    first[lang, following] += 1

                for stop in boundaries(s, lang, model, on_period):
                    if stop >= len(s) or not (m := _TOKEN.search(s, stop)):
                        continue
                    token = m[0]
                    if s[stop - 1] != ".":
                        first[lang, token] += 1
                    # After a number or an initial a break is not sure enough to learn from.
                    before = s[max(0, stop - 60) : stop].split()
                    if (t := word_type(token)) and before and not _seen(before[-1])[3]:
                        counts[lang, "start", t] += 1
                        counts[lang, "starts", ""] += 1
            if len(counts) + len(pairs) + len(first) > _FLUSH:
                yield flush()
        if plain:
            yield flush()

    return run


def _ll_col(k, m, q):
    q = F.least(F.greatest(q, F.lit(1e-12)), F.lit(1 - 1e-12))
    return k * F.log(q) + (m - k) * F.log(1 - q)


def _llr_col(a, b, ab, n):
    p, p1, p2 = b / n, ab / a, (b - ab) / F.greatest(n - a, F.lit(1))
    return -2 * (_ll_col(ab, a, p) + _ll_col(b - ab, n - a, p) - _ll_col(ab, a, p1) - _ll_col(b - ab, n - a, p2))


def abbreviations(prose: DataFrame) -> DataFrame:
    """(lang, value, score): words whose period belongs to them."""
    counts = prose.mapInArrow(_count_types, "lang string, kind string, value string, n long").groupBy("lang", "value").agg(F.sum(F.when(F.col("kind") == "dot", F.col("n")).otherwise(0)).alias("dot"), F.sum(F.when(F.col("kind") == "bare", F.col("n")).otherwise(0)).alias("bare"))
    counts = cut(counts)
    totals = counts.groupBy("lang").agg(F.sum("dot").alias("dots"), F.sum(F.col("dot") + F.col("bare")).alias("total"))
    # One row per language: never more than a few hundred.
    c = counts.filter("dot > 0 and value <> '#'").join(F.broadcast(totals), "lang")
    k, n = F.col("dot").cast("double"), (F.col("dot") + F.col("bare")).cast("double")
    ratio = -2 * (_ll_col(k, n, F.col("dots") / F.col("total")) - _ll_col(k, n, F.lit(0.99)))
    inner = F.length(F.regexp_replace("value", "[^.]", "")).cast("double")
    size = F.length("value") - inner
    score = ratio * F.exp(-size) * (inner + 1) * F.pow(F.greatest(size, F.lit(1.0)), -F.col("bare").cast("double"))
    return c.withColumn("score", score).filter((F.col("score") >= ABBREVIATION) & F.col("value").rlike("^[\\p{L}\\p{M}.\\-]*[\\p{L}\\p{M}]$")).select("lang", "value", "score")


def _passes(model: DataFrame, prose: DataFrame, most: int) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Parts of a model that one broadcast may hold, each with its prose: everything, or else language by language."""
    sizes = {lang: n for lang, n in model.groupBy("lang").count().collect()}
    if sum(sizes.values()) <= most:
        yield model, prose
        return
    if max(sizes.values()) > most:
        raise ValueError(f"a language's model has more than {most} rows; raise model_rows and the executors' memory")
    for lang in sorted(r[0] for r in prose.select("lang").distinct().collect()):
        yield model.filter(F.col("lang") == lang), prose.filter(F.col("lang") == lang)


def learn(prose: DataFrame, model_rows: int = MODEL_ROWS) -> DataFrame:
    """(lang, kind, value): the model of ``prose_units``: kinds abbr, start, pair, lower, inner."""
    abbr = cut(abbreviations(prose))
    found = None
    for rows, part in _passes(abbr, prose, model_rows):
        known: dict[str, set[str]] = {}
        for lang, value in rows.select("lang", "value").toLocalIterator():
            known.setdefault(lang, set()).add(value)
        seen = part.mapInArrow(_count_contexts(known), "lang string, kind string, value string, n long")
        found = seen if found is None else found.unionByName(seen)
    counts = found.groupBy("lang", "kind", "value").agg(F.sum("n").cast("double").alias("n"))
    counts = cut(counts)
    everything = counts.filter("kind = 'all'").select("lang", "value", F.col("n").alias("n_all"))
    totals = counts.filter("kind in ('total', 'starts')").groupBy("lang").agg(F.sum(F.when(F.col("kind") == "total", F.col("n")).otherwise(0)).alias("n_total"), F.sum(F.when(F.col("kind") == "starts", F.col("n")).otherwise(0)).alias("n_starts"))
    starters = counts.filter("kind = 'start' and value <> '#'").join(everything, ["lang", "value"]).join(F.broadcast(totals), "lang")
    starters = starters.filter((_llr_col(F.col("n_starts"), F.col("n_all"), F.col("n"), F.col("n_total")) >= STARTER) & (F.col("n_total") / F.col("n_starts") > F.col("n_all") / F.col("n"))).select("lang", F.lit("start").alias("kind"), "value")
    dotted = counts.filter("kind = 'dotted'").select("lang", F.col("value").alias("first"), F.col("n").alias("n_first"))
    pairs = counts.filter("kind = 'pair'").withColumn("first", F.split("value", "\t")[0]).withColumn("second", F.split("value", "\t")[1])
    seconds = everything.select("lang", F.col("value").alias("second"), F.col("n_all").alias("n_second"))
    firsts = abbr.select("lang", F.col("value").alias("first"), F.lit(True).alias("is_abbr"))
    pairs = pairs.join(dotted, ["lang", "first"]).join(seconds, ["lang", "second"]).join(F.broadcast(totals), "lang").join(firsts, ["lang", "first"], "left")
    pairs = pairs.join(starters.select("lang", F.col("value").alias("second")), ["lang", "second"], "left_anti")
    # Across a period a number may follow any word; another word only an abbreviation, a number or an initial.
    fit = (F.col("second") == "#") | F.coalesce("is_abbr", F.lit(False)) | (F.col("first") == "#") | (F.length("first") == 1)
    strong = (_llr_col(F.col("n_first"), F.col("n_second"), F.col("n"), F.col("n_total")) >= COLLOCATION) & (F.col("n_total") / F.col("n_first") > F.col("n_second") / F.col("n")) & (F.col("n") > 1)
    # After an abbreviation only a word that is also written small could begin a sentence at all.
    small = counts.filter("kind = 'lower'").select("lang", F.col("value").alias("second"), F.lit(True).alias("is_small"))
    pairs = pairs.join(small, ["lang", "second"], "left").filter((F.col("second") == "#") | (F.col("first") == "#") | F.col("is_small"))
    pairs = pairs.filter(fit & strong).select("lang", F.lit("pair").alias("kind"), "value")
    # Letter case matters only for words that ever follow a period.
    after = counts.filter("kind = 'pair'").select("lang", F.split("value", "\t")[1].alias("value")).distinct()
    lower = counts.filter("kind = 'lower'").select("lang", "kind", "value").join(after, ["lang", "value"], "left_semi")
    inner = counts.filter("kind = 'inner'").select("lang", "kind", "value").join(lower.select("lang", "value"), ["lang", "value"], "left_semi")
    case = lower.select("lang", "kind", "value").unionByName(inner.select("lang", "kind", "value"))
    return abbr.select("lang", F.lit("abbr").alias("kind"), "value").unionByName(starters).unionByName(pairs).unionByName(case)


def split_corpus(docs: DataFrame, model_rows: int = MODEL_ROWS) -> DataFrame:
    """(doc_id, start_at, end_at): the sentence units of every text cell, in code points of ``text``.

    ``docs`` needs doc_id, text and cells. Null or empty texts, null or empty cells and cells of code or
    output give no rows; a row delivered twice is split twice.
    """
    spark = docs.sparkSession
    prose = cut(prose_units(docs))
    model = cut(learn(prose, model_rows))
    out = None
    for mine, part in _passes(model, prose, model_rows):
        shared = spark.sparkContext.broadcast([tuple(r) for r in mine.toLocalIterator()])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            learned = Model(shared.value)
            for batch in batches:
                docs_, starts, ends = [], [], []
                for doc, at, lead, lang, unit in zip(*(batch.column(k).to_pylist() for k in range(5))):
                    for a, b in unit_sentences(unit, lead, lang, learned):
                        docs_.append(doc)
                        starts.append(at + a)
                        ends.append(at + b)
                yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["doc_id", "start_at", "end_at"])

        rows = part.mapInArrow(run, "doc_id long, start_at int, end_at int")
        out = rows if out is None else out.unionByName(rows)
    return out
