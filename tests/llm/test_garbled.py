"""Encoding repair: planted garblings are found, clean names are not, lost text is null."""

import pytest

from amalgrid.llm.garbled import CHAINS, garble, garbled_records, plausible

CLEAN = ["Müller Bäckerei Zürich", "Jörg Straße GmbH", "ООО Ромашка Торг", "Łódź Société Générale", "Plain Name Ltd", "Acme™ Tools", "ООО Ромашка Строй", "ООО Ландыш Торг", "株式会社 タナカ"]


@pytest.mark.parametrize("word, chain", [("Müller", (("utf-8", "cp1252"),)), ("Jörg", (("utf-8", "latin-1"),)), ("Straße", (("utf-8", "cp437"),)), ("Générale", (("utf-8", "cp1252"),) * 2), ("Ромашка", (("cp1251", "cp1252"),)), ("株式会社", (("euc_jp", "latin-1"),))])
def test_garble_makes_implausible_words(word, chain):
    assert chain in CHAINS and plausible(word)
    assert not plausible(garble(word, chain))


def test_finds_planted_forms(spark):
    rows = [(i, n) for i, n in enumerate(CLEAN)]
    planted = [
        (100, "MÃ¼ller Bäckerei ZÃ¼rich", "Müller Bäckerei Zürich"),
        (101, "JÃ¶rg StraÃŸe GmbH", "Jörg Straße GmbH"),
        (102, garble("Ромашка", (("cp1251", "cp1252"),)) + " Ltd", "Ромашка Ltd"),
        (106, " ".join(garble(w, (("koi8-r", "cp1251"),)) for w in ("ООО", "Верин", "Торг")), "ООО Верин Торг"),
        (103, "Fooâ„¢ Tools", "Foo™ Tools"),
        (104, "Lost � Name", None),
        (105, "mÃ¼ller".upper() + " AG", None),
    ]
    df = spark.createDataFrame(rows + [(i, n) for i, n, _ in planted] + [(200, None), (201, ""), (202, "x" * 20_000)], "record_id long, record_name string")
    got = {r.record_id: r.restored for r in garbled_records(df).collect()}
    assert set(got) == {100, 101, 102, 103, 104, 105, 106}
    for i, _, want in planted[:6]:
        assert got[i] == want


def test_letters_decide_not_copies(spark):
    """Garbled words that read as words: found though they are as common as their originals; toggled case is no garbling."""
    koi = lambda s: garble(s, (("koi8-r", "cp1251"),))
    clean = [f"Компания {w} Торг" for w in ("Ромашка", "Ландыш", "Василек", "Мак", "Гвоздика", "Ромашково", "Компас", "Маяк")]
    rows = [(i, n) for i, n in enumerate(clean)] + [(50 + i, koi(n)) for i, n in enumerate(clean[:6])] + [(80, "кОМПАНИЯ тОРГ"), (81, "CafÂ\xa0e Ltd"), (82, "City of Golvˆrd¸r")]
    rows += [(90, "Möller Jürgen")]
    df = spark.createDataFrame(rows, "record_id long, record_name string")
    got = {r.record_id: r.restored for r in garbled_records(df).collect()}
    assert set(got) == {50, 51, 52, 53, 54, 55, 81, 82}
    assert got[50] == clean[0] and got[82] == "City of Golvördür"


def test_a_common_word_of_a_rare_script_is_no_accident(spark):
    """Cyrillic names outnumber the Greek ones, so the letters of the Cyrillic misreading of a Greek word read better."""
    wrong = garble("ΕΠΕ", (("cp1253", "cp1251"),))
    assert plausible(wrong) and wrong == "ЕРЕ"
    endings = ("на", "сов", "лин", "ма", "рик", "тор")
    cyrillic = [f"{a}{b}{c} {d}" for a in ("Вере", "Море", "Ели", "Река", "Перо") for b in endings for c in ("", "к", "ск") for d in ("Торг", "Строй", "Сервис")]
    greek = [f"{a}{b} ΕΠΕ" for a in ("Ελε", "Παπα", "Νικο", "Επα", "Μεπ") for b in ("νης", "δος", "λος", "ρας", "κης")]
    rows = [(i, n) for i, n in enumerate(cyrillic + greek)] + [(500, f"Ζευς {wrong}"), (501, "Ζευς επε")]
    df = spark.createDataFrame(rows, "record_id long, record_name string")
    assert {r.record_id: r.restored for r in garbled_records(df).collect()} == {500: "Ζευς ΕΠΕ"}


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "record_id long, record_name string")
    assert garbled_records(empty).count() == 0
    odd = spark.createDataFrame([(1, "JÃ¶rg", "x", 2), (2, "Jörg", "y", 3)], "record_id long, record_name string, token string, chain int")
    assert [r.record_id for r in garbled_records(odd).collect()] == [1]
