"""Leaks and sentences on small fixtures."""

import random

from amalgrid.llm.leakage import SIGNS, WORDS, _WORD, leaks, plain
from amalgrid.llm.sentences import Model, language, sentences, split_corpus

DOCS = "doc_id long, text string"
ITEM = "Between Cretorg and Arkcreven lie 292 crooked turbine stations. Name the ferry that Jinkordur lent to Vellixv during the festival."


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, DOCS)
    i = spark.createDataFrame(items, "item_id long, item_text string")
    return sorted(tuple(r) for r in leaks(d, i, **kw).collect())


def test_leaks_in_many_disguises(spark):
    words = ITEM.split()
    docs = [
        (1, "x " + ITEM + " y"), (2, " ".join(words[2:14])), (3, " ".join(words[2:13])), (4, "# " + "\n# ".join(words[4:18])), (5, "<td>" + "</td><td>".join(words) + "</td>"),
        (6, '"' + "\\n".join(words) + '"'), (7, ITEM.upper().replace(" ", "  --  ")), (8, None), (9, ""), (10, " ".join(words[:6] + ["other"] + words[6:])), (11, ("foo bar " * 30_000) + ITEM), (1, "x " + ITEM + " y"),
    ]
    items = [(7, ITEM), (8, ITEM + " More words that follow it here."), (9, None), (10, ""), (11, "too short to leak")]
    got = found(spark, docs, items)
    hit = {1, 2, 4, 5, 6, 7, 10, 11}
    want = sorted({(d, i) for d in hit for i in (7, 8)})
    assert got == want


def test_unspaced_scripts(spark):
    item = "岚楠先生的仓库里放着58箱竹果，每箱重4.5斤。如果槿漪河上有90座铁桥"
    docs = [(1, "print('" + item[:10] + "\n" + item[10:24] + "')"), (2, item[:18]), (3, item[:9] + "abc" + item[9:25])]
    assert found(spark, docs, [(1, item)]) == [(1, 1)]


def test_same_as_brute_force(spark):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(8, 40)))) for i in range(12)]
    docs = []
    for d in range(40):
        text = r.choices(vocabulary, k=50)
        if r.random() < 0.7:
            source = r.choice(items)[1].split()
            n = r.randint(9, 16)
            at = r.randrange(max(1, len(source) - n))
            text[20:20] = source[at : at + n]
        docs.append((d, " ".join(text)))
    grams = lambda t, n: {tuple(w[k : k + n]) for w in [_WORD.findall(plain(t))] for k in range(len(w) - n + 1)}
    want = sorted((d, i) for d, t in docs for i, x in items if grams(t, WORDS) & grams(x, WORDS))
    assert found(spark, docs, items) == want and want
    assert found(spark, docs, items, index_windows=40) == want
    assert found(spark, docs, items, index_windows=0) == want
    assert SIGNS == 20


def test_edited_passages(spark):
    """Below a threshold of 1: windows with a changed word, by the index and by the join, against all pairs."""
    import numpy as np

    from amalgrid.llm.leakage import Hashes, sequences, similar

    r = random.Random(8)
    items = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(20))) for i in range(10)]
    docs = []
    for d in range(60):
        words = [f"x{r.randrange(400)}" for _ in range(30)]
        passage = r.choice(items)[1].split()[3:15]
        if d % 3:
            passage[r.choice([0, 11]) if d % 3 == 1 else 6] = "changed"
        words[10:10] = passage
        docs.append((d, " ".join(words)))
    known = Hashes()

    def cuts(text):
        h = sequences(text, known)[0]
        return np.array([h[k : k + WORDS] for k in range(len(h) - WORDS + 1)], np.uint64)

    want = []
    for d, t in docs:
        a = cuts(t)
        for i, x in items:
            b = cuts(x)
            if (similar(np.repeat(a, len(b), axis=0), np.tile(b, (len(a), 1))) >= 0.8).any():
                want.append((d, i))
    assert len(want) > 30
    for most in (1000, 0):
        got = found(spark, docs, items, threshold=0.8, radius=15, index_windows=most)
        assert set(got) <= set(want) and len(got) >= 0.9 * len(want), (len(got), len(want))


def cut(text, model=None):
    return [text[a:b] for a, b in sentences(text, model or Model([("en", "abbr", t) for t in ("dr", "e.g", "etc", "p.m", "sec")] + [("en", "start", "however")]))]


def test_sentences_of_one_text():
    assert cut("Dr. Foo came. It works?! See e.g. the list etc. alike. The end") == ["Dr. Foo came.", "It works?!", "See e.g. the list etc. alike.", "The end"]
    assert cut('"Does it?" asked Ann. He wrote: "Stop here. Go on." Then he left (all of it.) Yes.') == ['"Does it?" asked Ann.', 'He wrote: "Stop here. Go on."', "Then he left (all of it.)", "Yes."]
    assert cut("# A title. Here\nA line\nbroken. Next\n\n- one\n- two. three\n> quoted. yes") == ["# A title.", "Here", "A line\nbroken.", "Next", "- one", "- two.", "three", "> quoted.", "yes"]
    assert cut("Version 1.2.3 costs 4.5 %. It is so … or not. Hmm... maybe.") == ["Version 1.2.3 costs 4.5 %.", "It is so … or not.", "Hmm... maybe."]
    assert cut("阈值是3.5，是不是太高了？结果很好！他问：“为什么是空的？”然后重新运行。") == ["阈值是3.5，是不是太高了？", "结果很好！", "他问：“为什么是空的？”然后重新运行。"]
    assert cut("「もう一度。」と彼女は言った。完了！") == ["「もう一度。」と彼女は言った。", "完了！"]
    assert cut("## ข้อมูล\n\nผลลัพธ์ถูกต้อง กรุณารันเซลล์") == ["## ข้อมูล", "ผลลัพธ์ถูกต้อง", "กรุณารันเซลล์"]
    assert cut("यह क्यों है? काम हुआ।\nबस।") == ["यह क्यों है?", "काम हुआ।", "बस।"]
    assert cut("Γιατί είναι κενή η στήλη; Τέλος!") == ["Γιατί είναι κενή η στήλη;", "Τέλος!"]
    assert cut("ខ្ញុំទៅផ្សារ។ គាត់នៅផ្ទះ៕") == ["ខ្ញុំទៅផ្សារ។", "គាត់នៅផ្ទះ៕"]
    assert cut("ကျွန်တော်သွားမယ်။ သူနေတယ်။") == ["ကျွန်တော်သွားမယ်။", "သူနေတယ်။"]
    assert cut("བོད་ཡིག། ཡི་གེ།") == ["བོད་ཡིག།", "ཡི་གེ།"]
    assert cut("„Läuft das?“, fragte er. Ja.") == ["„Läuft das?“, fragte er.", "Ja."]
    assert cut("") == [] and cut(" \n\r\n ") == []


def test_languages():
    assert [language(t) for t in ("The cat is on it", "Der Hund ist im Haus", "Le chat est dans la rue", "Привет всем", "ქართული ენა")] == ["en", "de", "fr", "ru", "ka"]


def test_declared_language_helps_where_words_tell_little():
    swedish = "Katten sitter på mattan och hunden springer en lång väg hem varje kväll"
    assert language(swedish, "sv") == "sv" and language(swedish, None) != "sv"
    assert language("The cat is on the mat and it is not in the house", "sv") == "en"
    assert language("Привет всем", "en") == "ru" and language("zzz qqq", "und") == "en" and language("zzz qqq", "pl") == "pl"
    assert language("ខ្ញុំទៅ") == "km"


def test_models_go_language_by_language(spark):
    kind = "array<struct<kind:string,exec_count:int,start_at:int,end_at:int>>"
    texts = {d: t for d, t in enumerate(["The list is here. It is done.", "Der Hund ist im Haus. Das ist gut.", "Привет всем. Это конец."])}
    df = spark.createDataFrame([(d, t, [("text", None, 0, len(t))]) for d, t in texts.items()], f"doc_id long, text string, cells {kind}")
    whole = sorted(map(tuple, split_corpus(df).collect()))
    assert len(whole) == 6 and sorted(map(tuple, split_corpus(df, model_rows=3).collect())) == whole


def test_learns_from_the_corpus(spark):
    r = random.Random(4)
    name = lambda: "".join(r.choice("bdfgklmnprst") + r.choice("aeiou") for _ in range(3)).title()
    kind = "array<struct<kind:string,exec_count:int,start_at:int,end_at:int>>"
    rows, want = [], {}
    for d in range(120):
        parts = [r.choice([f"Qz. {name()} saw the list.", f"The list of {name()} is long.", f"We took approx. {d} of the rows.", "However, it is the end.", "However, long rows and an end are said to be on the list."]) for _ in range(6)]
        text = "head\n" + " ".join(parts) + "\ncode. Here. There."
        end = 5 + len(" ".join(parts))
        rows.append((d, text, [("text", None, 5, end), ("code", 1, end + 1, len(text))]))
        want[d] = parts
    extra = [(900, None, None), (901, "", []), (902, "x. Y.", None), (903, "Clipped cell. Beyond end.", [("text", None, 0, 99)]), (904, "Z" * 50_000, [("text", None, 0, 50_000), None])]
    df = spark.createDataFrame(rows + extra, f"doc_id long, text string, cells {kind}")
    texts = {x[0]: x[1] for x in rows + extra}
    got = {}
    for row in sorted(split_corpus(df).collect()):
        got.setdefault(row.doc_id, []).append(texts[row.doc_id][row.start_at : row.end_at])
    assert {d: got[d] for d in want} == want
    assert got[903] == ["Clipped cell.", "Beyond end."] and len(got[904]) == 1 and not {900, 901, 902} & set(got)
    assert split_corpus(df.limit(0)).count() == 0
