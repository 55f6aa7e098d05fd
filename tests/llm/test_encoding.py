"""Token ids against the public library's own encoder."""

import os

import pytest

from amalgrid.llm.encoding import PATTERN, TOKENIZERS, Encoder, encode_corpus, merge_long, merge_short, read_ranks

FILE = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no vocabulary here")
TEXTS = [
    "Hello world, it's 3.14!\n\n  def f(x):\n\treturn x  \n", "naïve café – “quoted” … 日本語のテキスト、한국어\nплюс Ελληνικά\n", " " * 300 + "x", "\n \n\t a b 　c\r\n\r\nd", "a" * 3000, "=-" * 1500 + "\n",
    "\x1c\x1d \x1f\x85  z", "mix é\n  ascii line \n\n\x1c\nü\n   ", "👩‍👩‍👧 emoji 🙂.", "don't we'll I've you're he'd I'm 'S 'tx", "1234567 12a34 ½²",
]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(FILE)


@pytest.fixture(scope="module")
def public(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_public_encoder(ranks, public):
    mine = Encoder(ranks)
    for text in TEXTS + ["".join(TEXTS)]:
        assert mine.encode(text) == public.encode_ordinary(text), text[:40]


def test_random_texts(ranks, public):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    mine = Encoder(ranks)

    @settings(max_examples=400, deadline=None)
    @given(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x0c\x1c\x85 aZé0'._字"), st.characters(exclude_categories=["Cs"])), max_size=40))
    def check(text):
        assert mine.encode(text) == public.encode_ordinary(text)

    check()


def test_both_merges_agree(ranks):
    for word in ("tokenization", "ﬁﬂ", "aaaaaaab", "日本語テキスト", "x" * 130):
        b = word.encode()
        assert merge_short(b, ranks) == merge_long(b, ranks)


def test_nulls_empty_repeats_and_extra_columns(spark, ranks):
    df = spark.createDataFrame([(1, None, 7), (2, "", 8), (3, "hello", 9), (3, "hello", 9), (4, "x" * 100_000, 1)], "doc_id long, text string, ids int")
    rows = sorted((r.doc_id, list(r.ids)) for r in encode_corpus(df).collect())
    assert rows[0] == (1, []) and rows[1] == (2, []) and rows[2] == rows[3] and rows[2][1]
    assert b"".join({v: k for k, v in ranks.items()}[i] for i in rows[4][1]) == b"x" * 100_000
    assert encode_corpus(df.limit(0)).count() == 0
