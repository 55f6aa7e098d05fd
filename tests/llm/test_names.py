"""Look-alikes, copies and variants of names on small fixtures."""

import itertools
import random

import pytest

from amalgrid.llm.copies import CopyLedger, collapse
from amalgrid.llm.lookalikes import NativeFold, lookalike_table, same_look_pairs, skeleton
from amalgrid.llm.variants import Align, build_trie, candidate_pairs, edits, name_words, variant_pairs, within

RECORDS = "record_id long, record_name string"


@pytest.fixture(scope="module")
def table(spark):
    return lookalike_table(spark)


def test_skeleton(table):
    same = [("Acme Ltd", "Аcmе Ltd"), ("Acme", "Ａｃｍｅ"), ("Acme Ltd", "Acme Ltd"), ("Ac​me", "Acme"), ("é", "é"), ("Roofing", "Rooﬁng"), ("A　B", "A B")]
    for a, b in same:
        assert skeleton(a, table) == skeleton(b, table), (a, b)
    for a, b in [("acme", "Acme"), ("é", "e"), ("Il", "ll"), ("O", "0"), ("m", "rn")]:
        assert skeleton(a, table) != skeleton(b, table), (a, b)


def test_native_fold_keeps_scripts_apart(table):
    fold = NativeFold(table)
    assert fold("ООО ВЕНСЕММАР") == fold("ооо венсеммар")
    assert fold("γΙΑΣ ΕΠΕ") == fold("γιασ επε")
    assert fold("Ноld Сo") == "hold co"
    assert fold("The ООО Ромашка") == "the ооо ромашка"


def test_same_look_pairs(spark):
    df = spark.createDataFrame([(1, "Acme Ltd"), (2, "Аcme Ltd"), (3, "Acme  Ltd"), (4, "Acme Ltd"), (5, "acme ltd"), (6, None), (7, " "), (8, " "), (2, "Аcme Ltd")], RECORDS)
    got = {tuple(r) for r in same_look_pairs(df).collect()}
    assert got == {(1, 2), (2, 3), (2, 4)}
    assert same_look_pairs(df.limit(0)).count() == 0


def test_marks_and_ideographs_have_looks(table):
    for a, b in [("s\u0327", "s\u0326"), ("a\u0302", "a\u0311"), ("\u58eb", "\u571f"), ("\U0001fbf7", "7")]:
        assert skeleton(a, table) == skeleton(b, table), (a, b)


def test_hot_spelling_is_not_paired_with_itself(spark):
    """A hundred thousand copies of one spelling and one disguised copy: as many pairs, not their square."""
    from pyspark.sql import functions as F

    many = spark.range(1, 100_001).select(F.col("id").alias("record_id"), F.lit("Acme Ltd").alias("record_name"))
    df = many.unionByName(spark.createDataFrame([(0, "Аcme Ltd")], RECORDS))
    got = same_look_pairs(df)
    assert got.count() == 100_000 and got.filter("id_a = 0").count() == 100_000


def test_copies(spark):
    rows = [
        (5, "Foo Bar Pty Ltd"), (3, "BAR, foo (pty) ltd."), (9, "Foo Bar Pty-Ltd"), (9, "Foo Bar Pty-Ltd"), (4, "Fоo Bar Pty Ltd"), (6, "FooBar Pty Ltd"), (7, "Foo Bár Pty Ltd"), (8, "Foo Bar 1 Pty Ltd"),
        (10, None), (11, "  "), (12, "()"), (13, "O'Neil L L C"), (14, "oneil llc"), (15, "x" * 10_000), (16, "X" * 10_000),
    ]
    ledger, members = collapse(spark.createDataFrame(rows, RECORDS))
    assert sorted(tuple(r) for r in ledger.copies(members).collect()) == [(3, 4), (3, 5), (3, 6), (3, 9), (13, 14), (15, 16)]


def test_copies_with_moved_single_letters(spark):
    names = ["Korundost & Folhulble L L C", "C Korundost & Folhulble L L", "A B Smith", "B A Smith", "L Korundost", "Oneil L L C", "C, O'Neil L L", "A Smith B", "AB Smith C"]
    ledger, members = collapse(spark.createDataFrame(list(enumerate(names)), RECORDS))
    assert sorted(tuple(r) for r in ledger.copies(members).collect()) == [(0, 1), (2, 3), (2, 7), (5, 6)]


BATCHED = [
    (1, "FooBar Ltd"), (2, "Foo-Bar Ltd"), (3, "Foo Bar Ltd"), (4, "ltd foo bar"), (5, "A b"), (6, "b, a"), (7, "E"), (7, "E"), (8, "e"), (9, "O Neil L L C"), (10, "L ONeil L C"), (11, None), (12, " "), (13, "E"), (5, "A b"), (5, "Other"),
]


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1], [1, 2, 0]])
def test_ledger_is_the_same_for_any_batches(spark, order, tmp_path):
    """Names that meet only by a second key, and redelivered records, in one batch or in several."""
    schema = "record_id long, record_name string"
    whole = CopyLedger(spark, str(tmp_path / "whole"))
    everyone = whole.add(spark.createDataFrame(BATCHED, schema))
    want = sorted(map(tuple, whole.names().collect()))
    assert (1, "FooBar Ltd", 4) in want and (5, "A b", 2) in want and (7, "E", 3) in want and sum(r[2] for r in want) == 12
    place = str(tmp_path / "parts")
    members = []
    for k in order:
        # Every batch opens the stored ledger anew, and redelivers a third of another one.
        part = [r for i, r in enumerate(BATCHED) if i % 3 == k or i % 9 == k]
        members.append(CopyLedger(spark, place).add(spark.createDataFrame(part, schema)))
    again = CopyLedger(spark, place)
    assert again.version == 3
    assert sorted(map(tuple, again.names().collect())) == want
    rows = sorted(map(tuple, again.copies(members[0].union(members[1]).union(members[2])).collect()))
    assert rows == sorted(map(tuple, whole.copies(everyone).collect()))
    assert again.add(spark.createDataFrame(BATCHED, schema)).count() == 0
    last = CopyLedger(spark, place)
    assert sorted(map(tuple, last.names().collect())) == want
    last.close()
    assert sorted(map(tuple, last.names().collect())) == want


def test_ledger_of_nothing(spark):
    empty = spark.createDataFrame([], "record_id long, record_name string, node string, forms int")
    ledger, members = collapse(empty)
    assert ledger.names().count() == 0 and ledger.copies(members).count() == 0


def test_automaton_against_brute_force():
    r = random.Random(1)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(2, 7))) for _ in range(250)})
    trie = build_trie(words)
    for w in r.sample(words, 60):
        for k in (1, 2):
            assert within(trie, w, k) == {v: edits(w, v, k) for v in words if edits(w, v, k) <= k}


VARIANTS = [
    ["Lumtel Garvendor Foods Pty Ltd", "LUMTEL GARVENDOR FDS P/L", "Lumtel Garvednor Foods Proprietary Limited", "Foods Pty Ltd, Lumtel Garvendor", "Lumtell Garvendor Foods Pty"],
    ["Lumtel Garvendor Roofing Pty Ltd"],
    ["Gregory Pondarsul Velkrast", "Greg Pondarsul Velkrast", "Pondarsul Velkrast, G", "Gregory Pondarsul-Velkrast"],
    ["Katherine Pondarsul Velkrast"],
    ["Torbriand Unit Trust No 12"], ["Torbriand Unit Trust No 13"],
    ["Wystor Hargim Consulting Mellmouth"], ["Wystor Hargim Consulting Ardhaven"],
    ["Вендорбал Сулкемгим Торг", "ВЕНДОРБАЛ СУЛКЕМГИМ ТОРГ"],
]


def test_variants(spark):
    rows = list(enumerate(n for g in VARIANTS for n in g))
    ids = iter(range(len(rows)))
    want = {p for g in VARIANTS for p in itertools.combinations([next(ids) for _ in g], 2)}
    # Other entities make trades, given names and forms established words.
    r = random.Random(5)
    syllables = "bak dor fen gul hom jes kal lum mot nir pev qua rud sab tix vom wen yul zad".split()
    names = ["Foods Pty Ltd", "Roofing Pty Ltd", "Consulting Mellmouth", "Consulting Ardhaven", "Unit Trust No 7"]
    filler = [f"{''.join(r.sample(syllables, 3)).title()} {''.join(r.sample(syllables, 3)).title()} {names[i % 5]}" for i in range(150)]
    filler += [f"{('Gregory', 'Katherine')[i % 2]} {''.join(r.sample(syllables, 3)).title()} {''.join(r.sample(syllables, 3)).title()}" for i in range(60)]
    df = spark.createDataFrame(rows + [(1000 + i, n) for i, n in enumerate(filler)] + [(5000, None), (5001, ""), (5002, "()"), (0, rows[0][1])], "internal_id long, name string")
    got = {tuple(p) for p in variant_pairs(df).collect()}
    assert {p for p in got if p[0] < 1000 and p[1] < 1000} == want
    assert not {p for p in got if (p[0] < 1000) != (p[1] < 1000)}
    assert variant_pairs(df.limit(0)).count() == 0


def test_alignment_refuses_contradictions(table):
    fold = NativeFold(table)
    align = Align(5)
    align.counts = {"foods": 50, "roofing": 50, "henry": 9, "harry": 9, "anna": 9}
    say = lambda a, b: align.match(name_words(a, fold), name_words(b, fold))
    assert say("Abcdel Fghijk Foods", "Abcdel Fghijk Foods Limited")
    assert not say("Abcdel Fghijk Foods", "Abcdel Fghijk Roofing")
    assert not say("Anna Abcdel Fghijk", "Henry Abcdel Fghijk")
    assert say("Harry Abcdel Fghijk", "Henry Abcdel Fghijk")
    assert not say("Abcdel 1.25% 20300101", "Abcdel 1.35% 20300101")


def test_candidates_hold_every_match(spark):
    """All pairs by brute force, with anchors whole and split."""
    from pyspark.sql import functions as F

    r = random.Random(3)
    surnames = ["lixjinharkryponrud", "smith", "corneral", "undrudiroelectrical", "velkrast", "pondarsul", "torbriand"]
    names = ["gregory lixjinhar kryponrud", "the gregory lixjinharkryponrud", "ironessha undrudiro electrical inc", "ironessha undrudiroelectrical", "bob smith", "robert smith", "r smith", "uni of velkrast", "university of velkrast", "robert pondarsul torbri", "robert pondarsul torbriand", "smtih", "comeral"]
    for _ in range(260):
        w = r.choice(surnames)
        i = r.randrange(len(w))
        typo = w[:i] + r.choice(["", "e", w[i] * 2]) + w[i + 1 :]
        names.append(" ".join(r.sample([r.choice(["robert", "bob", "r", "gregory", "greg", "g"]), typo, r.choice(["foods", "university", "trust", "pty"])], r.randint(1, 3))))
    lists = spark.createDataFrame([(n,) for n in sorted(set(names))], "spell string").withColumn("h", F.xxhash64("spell")).withColumn("ws", F.split("spell", " "))
    counts = lists.select(F.explode(F.array_distinct("ws")).alias("word"), F.array_sort("ws").alias("k")).distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    spells = {x.h: x.spell.split(" ") for x in lists.collect()}
    align = Align(5)
    align.counts = {x.word: x.n for x in counts.collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(spells), 2) if align.match(spells[a], spells[b])}
    assert len(want) > 100
    for block in (2000, 3):
        got = {tuple(p) for p in candidate_pairs(lists, counts, 5, block).collect()}
        assert not [(spells[a], spells[b]) for a, b in want - got], block


def test_variants_of_lost_blanks(spark):
    names = ["gregory lixjinhar kryponrud", "the gregory lixjinharkryponrud", "ironessha undrudiro electrical inc", "ironessha undrudiroelectrical"]
    got = {tuple(p) for p in variant_pairs(spark.createDataFrame(list(enumerate(names)), "internal_id long, name string")).collect()}
    assert got == {(0, 1), (2, 3)}
