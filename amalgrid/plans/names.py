"""Queries of the name functions. The SQL-checked ones run over names made from the whole part table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgrid.functions import casing, cleaning, pairnames, rules, similarity, tfidf
from amalgrid.functions.text import title
from amalgrid.session import table

CORPUS = """
SELECT p_partkey AS record_id, concat(CASE p_partkey % 32 WHEN 30 THEN 'zzz ' WHEN 29 THEN 'The Trustee for ' ELSE '' END, p_name, ' ', p_brand, CASE p_partkey % 32
  WHEN 0 THEN ' PTY. LTD.' WHEN 1 THEN ' Proprietary  Limited' WHEN 2 THEN ' & Co (NSW)' WHEN 3 THEN ' Family Trust'
  WHEN 4 THEN ' Incorporated.' WHEN 5 THEN ' 3.25% 20300101' WHEN 6 THEN ' trading as City of Shops' WHEN 7 THEN ' L.L.C.'
  WHEN 8 THEN ' Holdings Limited' WHEN 9 THEN ' Corp' WHEN 10 THEN ' (Australia) Pty Ltd' WHEN 11 THEN ', 12/03/2021 zz'
  WHEN 12 THEN ' - S.A. | Dept 7' WHEN 13 THEN ' GmbH' WHEN 14 THEN ' University Hospital, Intl. Svcs' WHEN 15 THEN ' 2021-03-04 Pte. Ltd.'
  WHEN 16 THEN ' Sdn. Bhd.' WHEN 17 THEN ' Bhd.' WHEN 18 THEN ' L.L.P.' WHEN 19 THEN ' Limited Partnership 12345' WHEN 20 THEN ' 2040 Series PLC.'
  WHEN 21 THEN ' S.R.L. 3-4-21' WHEN 22 THEN ' Aktiengesellschaft' WHEN 23 THEN ' Co., Ltd.' WHEN 24 THEN ' Co. Limited' WHEN 25 THEN ' Pty Co KG'
  WHEN 26 THEN ' Co.' WHEN 27 THEN ' Corp Pty' WHEN 28 THEN ' P/L' WHEN 31 THEN ' Limited Liability Co. KG' ELSE '' END) AS record_name
FROM part
"""


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    made = CORPUS.strip().removeprefix("SELECT ").split("\nFROM")[0]
    first, _, second = made.partition(", concat")
    return table(spark, sf, "part").selectExpr(first, "concat" + second)


_all: dict[str, tuple[Callable, str | None]] = {}


def query(sql: str | None = None):
    def keep(f):
        _all[f.__name__] = (f, sql)
        return f

    return keep


def queries():
    return {k: f for k, (f, _) in _all.items()}


def oracle_sql():
    return {k: sql for k, (_, sql) in _all.items() if sql}


# --- the same functions in SQL -------------------------------------------------------------------


def _sub(x: str, *rules: tuple[str, str]) -> str:
    for p, r in rules:
        x = f"regexp_replace({x}, '{p}', '{r}', 'g')"
    return x


def _trim(x: str) -> str:
    return _sub(x, (r"\s+", " "), (r"^[\s,.;:/\\&-]+", ""), (r"[\s,.;:/\\&-]+$", ""))


def _title(x: str) -> str:
    return rf"array_to_string(list_transform(regexp_extract_all({x}, '\p{{L}}+|[^\p{{L}}]+'), lambda w: upper(w[1]) || lower(w[2:])), '')"


_DESIGNATE = list(cleaning.DESIGNATORS)
_WORDS = "'pty','ltd','plc','sa','ag','llc','llp','bv','gmbh','srl','inc','co'"
_STOP = ",".join(f"'{w}'" for w in cleaning.STOPWORDS)
_CLEAN = f"""
WITH corpus AS ({CORPUS}), a AS (SELECT record_id, record_name, {_trim("lower(record_name)")} AS norm FROM corpus),
b AS (SELECT *, CASE WHEN regexp_matches(norm, '\\d{{1,2}}\\.\\d{{1,3}}%|\\b(class|series)\\s+[a-z0-9-]+|\\badr\\b|\\bamerican depositary\\b|\\b\\d{{8}}\\b') THEN 'security'
  WHEN regexp_matches(norm, '\\b(the trustee for|trust|superannuation|pension fund|fund)\\b') THEN 'trust'
  WHEN regexp_matches(norm, '\\b(ministry|department|council|university|hospital|city of|state of)\\b') THEN 'government' ELSE 'company' END AS type_hint,
  {_trim(_sub("regexp_replace(norm, '^the trustee for\\s+', '')", (r"\b(t/a|trading as|dba|t-as|t as)\b", " ")))} AS n1 FROM a),
c AS (SELECT *, {_trim(_sub("n1", (r"\((?:australia|au|nsw|vic|qld|wa|sa|tas|act|nt|singapore|china|uk|usa|us|canada)\)", "")))} AS n2 FROM b),
d AS (SELECT *, {_trim(_sub("n2", *_DESIGNATE))} AS display_name FROM c),
e AS (SELECT *, {_trim(_sub("display_name", *_DESIGNATE))} AS again FROM d),
f AS (SELECT record_id, norm, type_hint, display_name,
  array_to_string(list_transform(string_split(again, ' '), lambda w: CASE WHEN w IN ({_WORDS}) THEN upper(w) ELSE {_title("w")} END), ' ') AS c0,
  {_trim(_sub("again", (r"\b(pty|ltd|plc|sa|ag|llc|llp|bv|gmbh|srl|inc|co)\b", " "), ("[^a-z0-9]+", " ")))} AS match_key_strict,
  {_trim("array_to_string(list_filter(string_split(" + _sub("again", ("&", " and "), ("[^a-z0-9 ]+", " ")) + f", ' '), lambda w: w <> '' AND w NOT IN ({_STOP})), ' ')")} AS match_key_aggressive FROM e),
clean AS (SELECT record_id, norm, type_hint, display_name, {_trim("c0")} AS canonical_name, match_key_strict, match_key_aggressive FROM f)
"""


@query(_CLEAN + "SELECT * FROM clean")
def sanitise_names(spark, sf):
    return cleaning.sanitise(corpus(spark, sf)).select("record_id", "norm", "type_hint", "display_name", "canonical_name", "match_key_strict", "match_key_aggressive")


@query(_CLEAN + "SELECT match_key_aggressive AS match_key, count(*) AS n, min(record_id) AS first_id FROM clean WHERE match_key_aggressive <> '' GROUP BY 1 HAVING count(*) > 1")
def probable_duplicates(spark, sf):
    keyed = sanitise_names(spark, sf).filter("match_key_aggressive <> ''")
    return keyed.groupBy(F.col("match_key_aggressive").alias("match_key")).agg(F.count(F.lit(1)).alias("n"), F.min("record_id").alias("first_id")).filter("n > 1")


@query(_CLEAN + "SELECT record_id, CASE WHEN coalesce((record_id % 10) / 10.0, 0) >= 0.6 THEN 'person' ELSE type_hint END AS final_type FROM clean")
def final_types(spark, sf):
    base = sanitise_names(spark, sf).withColumns({"m": F.lit("person"), "c": (F.col("record_id") % 10) / 10})
    return base.select("record_id", cleaning.final_type("type_hint", "m", "c").alias("final_type"))


@query()
def sanitise_records(spark, sf):
    """The whole sanitiser over the delivered names, Unicode included (rows only: SQL has no compatibility form)."""
    return cleaning.sanitise(table(spark, sf, "processed_records").select("record_id", "record_name").distinct()).drop("record_name")


# The 32 rules without look-around: what must stay is marked with ~ first, and unmarked at the end.
_PLAIN = {name: (p, r) for name, p, r in rules.RULES if "(?=" not in p and "(?!" not in p and "(?<" not in p}
_AROUND = {
    "remove_percentages": [(r"\d+(?:\.\d+)?%\s+(\d)", r"\1")],
    "remove_long_numbers": [(r"\b(\d{3,})(\d\s*(?:series|model|type|version))", r"\1~\2"), (r"\b\d{4,}\b", "")],
    "uk_commonwealth_limited": [(r"\blimited(\s+(?:liability|partnership))", r"lim~ited\1"), (r"\blimited\b", "ltd")],
    "expand_co_to_company": [(r"(pty\s|pte\s|&\s)co\b", r"\1c~o"), (r"\bco(\s*(?:ltd|kg))", r"c~o\1"), (r"\bco\b\.(\s*(?:ltd|kg))", r"company.\1"), (r"\bco\b\.?", "company")],
    "expand_corp_to_corporation": [(r"\bcorp(\s*(?:pty|ltd))", r"c~orp\1"), (r"\bcorp\b\.(\s*(?:pty|ltd))", r"corporation.\1"), (r"\bcorp\b\.?", "corporation")],
}
_RULE_SQL = [step for name, _, _ in rules.RULES for step in _AROUND.get(name) or [_PLAIN[name]]] + [("~", "")]
_RULED = f"WITH corpus AS ({CORPUS}), ruled AS (SELECT record_id, trim({_sub('lower(record_name)', *_RULE_SQL)}) AS clean FROM corpus) "


@query(_RULED + "SELECT * FROM ruled")
def rule_cascade(spark, sf):
    return corpus(spark, sf).select("record_id", rules.apply_rules(F.lower("record_name")).alias("clean"))


_SPECIAL = "CASE lower(w) WHEN '3m' THEN '3M' WHEN 'ibm' THEN 'IBM' WHEN 'hp' THEN 'HP' WHEN 'it' THEN 'IT' WHEN 'ai' THEN 'AI' WHEN 'io' THEN 'IO'"
_SMART = f"list_transform(list_filter(string_split_regex(clean, '\\s+'), lambda w: w <> ''), lambda w, i: {_SPECIAL} ELSE CASE WHEN lower(w) IN ({','.join(repr(w) for w in casing.UPPER_WORDS)}) THEN upper(w) WHEN i > 1 AND lower(w) IN ({','.join(repr(w) for w in casing.SMALL_WORDS)}) THEN lower(w) ELSE {_title('w')} END END)"


@query(_RULED + f"SELECT record_id, {_title('clean')} AS titled, array_to_string({_SMART}, ' ') AS smart FROM ruled")
def title_cases(spark, sf):
    return rule_cascade(spark, sf).select("record_id", title("clean").alias("titled"), casing.smart_title("clean").alias("smart"))


def _suffixes(x: str, acronyms: bool) -> str:
    for p, r in casing.SUFFIXES:
        x = f"regexp_replace({x}, '{p}', '{r}', 'gi')"
    for a in casing.ACRONYMS if acronyms else ():
        x = f"regexp_replace({x}, '\\b{a}\\b', '{a}', 'gi')"
    return x


@query(f"WITH corpus AS ({CORPUS}) SELECT record_id, {_suffixes('record_name', False)} AS cased, {_suffixes('record_name', True)} AS with_acronyms FROM corpus")
def suffix_cases(spark, sf):
    return corpus(spark, sf).select("record_id", casing.suffix_case("record_name").alias("cased"), casing.cased_suffixes("record_name").alias("with_acronyms"))


@query()
def simple_sanitiser(spark, sf):
    """The simple sanitiser over the delivered names (rows only: five of its rules look around)."""
    return rules.clean_frame(table(spark, sf, "processed_records").select("record_id", "record_name").distinct(), "record_name", "clean_name").select("record_id", "clean_name")


def _abbr(x: str) -> str:
    return f"array_to_string(list_transform(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> ''), lambda w: CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairnames.ABBREVIATIONS.items()) + " ELSE w END), ' ')"


def _company(x: str, drop: bool = False) -> str:
    spaced = f"regexp_replace(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    y = _sub(_abbr(spaced), *[(rf"\b{s}\b", "" if drop else r) for s, r in pairnames.LEGAL_SUFFIXES.items()])
    return f"array_to_string(list_filter(string_split_regex({y}, '\\s+'), lambda w: w <> ''), ' ')"


@query(f"WITH corpus AS ({CORPUS}) SELECT record_id, {_company('record_name')} AS name, {_company('record_name', True)} AS core, list_filter(string_split({_company('record_name')}, ' '), lambda w: w <> '') AS tokens, substr({_company('record_name')}, 1, 1) AS letter FROM corpus")
def pair_names(spark, sf):
    return corpus(spark, sf).select("record_id", pairnames.company_name("record_name").alias("name"), pairnames.core_name("record_name").alias("core"), pairnames.name_tokens("record_name").alias("tokens"), pairnames.first_letter("record_name").alias("letter"))


@query(_CLEAN + "SELECT record_id, CASE WHEN norm = '' THEN 'unknown' ELSE type_hint END AS gliner_type, CASE WHEN norm = '' THEN 0 ELSE 1 END::DOUBLE AS gliner_confidence FROM clean")
def rule_types(spark, sf):
    from amalgrid.operators.learning import classify_by_rules

    return classify_by_rules(sanitise_names(spark, sf)).select("record_id", "gliner_type", "gliner_confidence")


@query(f"WITH corpus AS ({CORPUS}) SELECT record_id, 'Classify the following: ' || record_name AS neutral, record_name || ' could be a company name, person''s name, address, financial instrument, or other type of entity.' AS explicit, 'Entity: ' || record_name AS minimal, record_name AS plain FROM corpus")
def model_prompts(spark, sf):
    from amalgrid.operators.learning import prompt

    return corpus(spark, sf).select("record_id", *[prompt("record_name", s).alias("plain" if s == "none" else s) for s in ("neutral", "explicit", "minimal", "none")])


@query()
def legacy_sanitiser(spark, sf):
    """The older cascade over the delivered names."""
    names = table(spark, sf, "processed_records").select("record_id", "record_name").distinct()
    return names.select("record_id", rules.clean_name("record_name", rules.LEGACY_RULES).alias("clean_name"))


@query()
def sequence_ratios(spark, sf):
    """How alike each stored name and its display form are by longest matching blocks."""
    names = table(spark, sf, "processed_records").select("record_id", "record_name", "display_name").distinct()
    return names.select("record_id", similarity.sequence_ratio(F.col("record_name"), F.col("display_name")).alias("ratio"))


# --- similarities --------------------------------------------------------------------------------

_PAIRS = f"""
WITH raw AS (SELECT DISTINCT company1, company2, label FROM labelled_pairs),
norm AS (SELECT *, {_company('company1')} AS a, {_company('company2')} AS b FROM raw),
core AS (SELECT *, {_company('a', True)} AS ca, {_company('b', True)} AS cb,
  list_distinct(list_transform(range(1, length(a)), lambda i: substr(a, i, 2))) AS ga, list_distinct(list_transform(range(1, length(b)), lambda i: substr(b, i, 2))) AS gb,
  list_filter(list_distinct(string_split(a, ' ')), lambda w: w <> '') AS ta, list_filter(list_distinct(string_split(b, ' ')), lambda w: w <> '') AS tb,
  list_distinct(string_split(a, '')) AS la, list_distinct(string_split(b, '')) AS lb, greatest(length(a), length(b)) AS n FROM norm),
scored AS (SELECT company1, company2, label,
  CASE WHEN a = '' OR b = '' THEN 0 ELSE 1 - levenshtein(a, b) / n::DOUBLE END AS levenshtein,
  CASE WHEN a = '' OR b = '' THEN 0 WHEN len(ga) = 0 AND len(gb) = 0 THEN 1 WHEN len(ga) = 0 OR len(gb) = 0 THEN 0 ELSE len(list_intersect(ga, gb)) / len(list_distinct(list_concat(ga, gb)))::DOUBLE END AS jaccard,
  CASE WHEN a = '' OR b = '' THEN 0 ELSE list_sum(list_transform(la, lambda c: (length(a) - length(replace(a, c, ''))) * (length(b) - length(replace(b, c, ''))))) /
    (sqrt(list_sum(list_transform(la, lambda c: (length(a) - length(replace(a, c, ''))) ** 2))) * sqrt(list_sum(list_transform(lb, lambda c: (length(b) - length(replace(b, c, ''))) ** 2)))) END AS cosine,
  CASE WHEN a = '' OR b = '' THEN 0 ELSE hamming(rpad(a, n::INT, ' '), rpad(b, n::INT, ' ')) END AS h,
  CASE WHEN len(ta) = 0 AND len(tb) = 0 THEN 1 WHEN len(ta) = 0 OR len(tb) = 0 THEN 0 ELSE len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb)))::DOUBLE END AS token_jaccard,
  CASE WHEN len(ta) = 0 AND len(tb) = 0 THEN 1 WHEN len(ta) = 0 OR len(tb) = 0 THEN 0 ELSE len(list_intersect(ta, tb)) / least(len(ta), len(tb))::DOUBLE END AS token_overlap,
  CASE WHEN ca = '' OR cb = '' THEN 0 ELSE 1 - levenshtein(ca, cb) / greatest(length(ca), length(cb))::DOUBLE END AS core_name_similarity, n, a, b FROM core)
"""


@query(_PAIRS + "SELECT company1, company2, label, round(jaccard, 9) AS jaccard, round(cosine, 9) AS cosine, round(token_jaccard, 9) AS token_jaccard, round(token_overlap, 9) AS token_overlap FROM scored")
def pair_set_features(spark, sf):
    made = similarity.add_features(table(spark, sf, "labelled_pairs").select("company1", "company2", "label").distinct(), python=False)
    return made.select("company1", "company2", "label", *[F.round(c, 9).alias(c) for c in ("jaccard", "cosine", "token_jaccard", "token_overlap")])


_PART_PAIRS = f"""
WITH corpus AS ({CORPUS}), named AS (SELECT record_id, {_company('record_name')} AS a FROM corpus), cored AS (SELECT *, {_company('a', True)} AS c FROM named),
pairs AS (SELECT x.record_id AS idx1, y.record_id AS idx2, x.a, y.a AS b, x.c, y.c AS d, greatest(length(x.a), length(y.a)) AS n FROM cored x JOIN cored y ON y.record_id = x.record_id + 1)
SELECT idx1, idx2, round(1 - levenshtein(a, b) / n::DOUBLE, 9) AS levenshtein, round((n - hamming(rpad(a, n::INT, ' '), rpad(b, n::INT, ' '))) / n::DOUBLE, 9) AS hamming,
  round(CASE WHEN c = '' OR d = '' THEN 0 ELSE 1 - levenshtein(c, d) / greatest(length(c), length(d))::DOUBLE END, 9) AS core_name_similarity FROM pairs
"""


@query(_PART_PAIRS)
def neighbour_edit_features(spark, sf):
    """Edit features of each name and the next, over all of them (byte-safe: these names are ASCII)."""
    a = corpus(spark, sf).select(F.col("record_id").alias("idx1"), F.col("record_name").alias("company1"))
    b = corpus(spark, sf).select((F.col("record_id") - 1).alias("idx1"), F.col("record_id").alias("idx2"), F.col("record_name").alias("company2"))
    made = similarity.add_features(a.join(b, "idx1"), python=False)
    return made.select("idx1", "idx2", F.round("levenshtein", 9).alias("levenshtein"), F.round("hamming", 9).alias("hamming"), F.round("core_name_similarity", 9).alias("core_name_similarity"))


@query()
def pair_features(spark, sf):
    """All nine features of the labelled pairs."""
    return similarity.add_features(table(spark, sf, "labelled_pairs").select("company1", "company2", "label").distinct())


_SUF = "|".join(s.replace(".", r"\.") for s in similarity.STANDARD_SUFFIXES)
_COMPARE = _RULED.rstrip() + f""", forms AS (SELECT c.record_id, c.record_name AS o, r.clean AS m, levenshtein(lower(c.record_name), lower(r.clean)) AS d FROM corpus c JOIN ruled r USING (record_id)),
compared AS (SELECT record_id, d AS distance, round(d * 100.0 / length(o), 9) AS distance_percent,
  length(m) - length(o) AS length_change, len(list_filter(string_split_regex(m, '\\s+'), lambda w: w <> '')) - len(list_filter(string_split_regex(o, '\\s+'), lambda w: w <> '')) AS token_change,
  CASE WHEN d = 0 THEN 'no_change' WHEN lower(o) = lower(m) THEN 'case_only' WHEN length(m) > length(o) * 1.5 THEN 'major_expansion' WHEN length(m) < length(o) * 0.7 THEN 'major_reduction' WHEN d <= 5 THEN 'minor_edit' ELSE 'major_edit' END AS kind,
  regexp_matches(upper(o), '({_SUF})$') AS suffix_before, regexp_matches(upper(m), '({_SUF})$') AS suffix_after,
  len(list_filter(list_filter(string_split_regex(o, '\\s+'), lambda w: w <> ''), lambda w: NOT regexp_matches(w, '^\\p{{Lu}}'))) = 0 AS title_case,
  len(regexp_extract_all(m, '\\d')) - len(regexp_extract_all(o, '\\d')) AS digit_change,
  len(regexp_extract_all(m, '[^a-zA-Z0-9_\\s]')) - len(regexp_extract_all(o, '[^a-zA-Z0-9_\\s]')) AS special_change,
  len(regexp_extract_all(m, '[A-Z]')) - len(regexp_extract_all(o, '[A-Z]')) AS upper_change FROM forms)
"""


@query(_COMPARE + "SELECT * FROM compared")
def cleaning_changes(spark, sf):
    c = corpus(spark, sf).withColumn("clean", rules.apply_rules(F.lower("record_name")))
    o, m = F.col("record_name"), F.col("clean")
    from amalgrid.functions.text import words

    d = similarity.edit_distance_lower(o, m)
    n = similarity.count_of
    return c.select(
        "record_id", d.alias("distance"), F.round(similarity.distance_percent(d, o), 9).alias("distance_percent"), (F.length(m) - F.length(o)).alias("length_change"), (F.size(words(m)) - F.size(words(o))).alias("token_change"), similarity.change_kind(o, m).alias("kind"),
        similarity.has_standard_suffix(o).alias("suffix_before"), similarity.has_standard_suffix(m).alias("suffix_after"), similarity.is_title_case(o).alias("title_case"),
        (n(m, r"\d") - n(o, r"\d")).alias("digit_change"), (n(m, r"[^\w\s]") - n(o, r"[^\w\s]")).alias("special_change"), (n(m, "[A-Z]") - n(o, "[A-Z]")).alias("upper_change"),
    )


@query(_COMPARE + """SELECT count(*) AS n, round(avg(distance), 9) AS avg_distance, round(avg(distance_percent), 6) AS avg_percent, round(avg(length_change), 9) AS avg_length, round(avg(token_change), 9) AS avg_tokens,
  round(100.0 * count(*) FILTER (WHERE suffix_after) / count(*), 9) AS suffix_percent, round(100.0 * count(*) FILTER (WHERE title_case) / count(*), 9) AS title_percent,
  round(avg(abs(digit_change)), 9) AS avg_digits, round(corr(length_change, distance), 6) AS length_corr, round(quantile_cont(distance, 0.5), 9) AS median_distance FROM compared""")
def cleaning_summary(spark, sf):
    c = cleaning_changes(spark, sf)
    share = lambda f: F.round(100.0 * F.count_if(f) / F.count(F.lit(1)), 9)
    return c.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("distance"), 9).alias("avg_distance"), F.round(F.avg("distance_percent"), 6).alias("avg_percent"), F.round(F.avg("length_change"), 9).alias("avg_length"), F.round(F.avg("token_change"), 9).alias("avg_tokens"),
        share(F.col("suffix_after")).alias("suffix_percent"), share(F.col("title_case")).alias("title_percent"), F.round(F.avg(F.abs("digit_change")), 9).alias("avg_digits"), F.round(F.corr(F.col("length_change").cast("double"), F.col("distance").cast("double")), 6).alias("length_corr"), F.round(F.percentile("distance", F.lit(0.5)), 9).alias("median_distance"),
    )


@query(_COMPARE + "SELECT record_id, distance FROM compared ORDER BY distance DESC, record_id LIMIT 5")
def largest_changes(spark, sf):
    return cleaning_changes(spark, sf).select("record_id", "distance").orderBy(F.desc("distance"), "record_id").limit(5)


# --- letter triples ------------------------------------------------------------------------------

_GRAM = f"""' ' || trim(regexp_replace({_title("regexp_replace(replace(regexp_replace(lower(t), '[)(.|\\[\\]{}'']', '', 'g'), '&', 'and'), '[,-]', ' ', 'g')")}, ' +', ' ', 'g')) || ' '"""
_TF = f"""
WITH corpus AS ({CORPUS}), spelled AS (SELECT record_name AS t, min(record_id) AS idx FROM corpus GROUP BY 1), texts AS (SELECT idx, {_GRAM} AS s FROM spelled),
grams AS (SELECT idx, unnest(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))) AS gram FROM texts),
tf AS (SELECT idx, gram, count(*) AS tf FROM grams GROUP BY ALL), df AS (SELECT gram, count(*) AS df FROM tf GROUP BY 1),
raw AS (SELECT idx, gram, tf * (ln((1 + (SELECT count(*) FROM texts)) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN df USING (gram)),
weights AS (SELECT idx, gram, w / sqrt(sum(w * w) OVER (PARTITION BY idx)) AS w FROM raw)
"""


@query(_TF + "SELECT gram, count(*) AS names, round(sum(w), 6) AS weight FROM weights GROUP BY gram")
def gram_weights(spark, sf):
    spelled = corpus(spark, sf).groupBy(F.col("record_name").alias("company")).agg(F.min("record_id").alias("idx"))
    return tfidf.tfidf(spelled).groupBy("gram").agg(F.count(F.lit(1)).alias("names"), F.round(F.sum("weight"), 6).alias("weight"))


_CLOSE = _TF + """, close AS (SELECT a.idx AS i, b.idx AS j, sum(a.w * b.w) AS s FROM weights a JOIN weights b ON a.gram = b.gram AND a.idx < b.idx GROUP BY 1, 2 HAVING sum(a.w * b.w) > 0.9),
ids AS (SELECT s.idx, c.record_id FROM corpus c JOIN spelled s ON c.record_name = s.t),
pairs AS (SELECT least(x.record_id, y.record_id) AS idx1, greatest(x.record_id, y.record_id) AS idx2, s FROM close JOIN ids x ON x.idx = i JOIN ids y ON y.idx = j
  UNION ALL SELECT x.record_id, y.record_id, 1 FROM ids x JOIN ids y ON x.idx = y.idx AND x.record_id < y.record_id)
"""


@query(_CLOSE + "SELECT idx1, idx2, round(s, 6) AS similarity FROM pairs")
def tfidf_pairs(spark, sf):
    pairs = tfidf.similar_pairs(corpus(spark, sf).select(F.col("record_id").alias("idx"), F.col("record_name").alias("company")))
    return pairs.select("idx1", "idx2", F.round("similarity", 6).alias("similarity"))


_BOTH = _CLOSE + ", ways AS (SELECT idx1 AS idx, idx2 AS match, round(s, 6) AS s FROM pairs UNION ALL SELECT idx2, idx1, round(s, 6) FROM pairs)"


@query(_BOTH + "SELECT idx, match, s AS similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY s DESC, match) AS rank FROM ways) WHERE rank <= 100")
def tfidf_top_matches(spark, sf):
    return tfidf.best_matches(tfidf_pairs(spark, sf), 100)


@query(_BOTH + "SELECT idx, list_sort(list_distinct(list(match))) AS matches FROM ways GROUP BY idx")
def tfidf_match_lists(spark, sf):
    return tfidf.match_lists(tfidf_pairs(spark, sf))


@query("SELECT n_nationkey, n_nationkey::DOUBLE * 1000 * 2000 * 8 / 1073741824 AS gib FROM nation")
def matrix_memory(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", tfidf.matrix_gib(F.col("n_nationkey") * 1000, F.lit(2000), 8).alias("gib"))
