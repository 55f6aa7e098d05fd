"""The recovering record parser against the rules, one by one and by brute force."""

import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from amalgrid.sources.delimited import COLUMN_COUNT, QUOTING, VALUE, failing, parse_lines, parse_record, parse_records, valid, with_delimiters, list_texts, parse_batch

GOOD = "7,Acme Ltd,company,,0.5,3,2024-02-29 23:59:59"


def line(**kw):
    f = dict(zip("record_id name hint kind conf batch at".split(), GOOD.split(",")))
    return ",".join({**f, **kw}.values())


@pytest.mark.parametrize(
    "text, reason",
    [
        (GOOD, None), (line(name='"a, ""b""\nc"'), None), (line(conf=".5"), None), (line(conf="1"), None), (line(conf=""), None), (line(name="007"), None), (line(record_id="0007"), None), (line(name="a\tb"), None), (line(name="a\\b"), None),
        (line(name='a "b"'), QUOTING), (line(name='"ab'), QUOTING), (line(name='"a"b'), QUOTING), (line(name='"a\\"b"'), QUOTING), (line(at='"2024-02-29 00:00:00'), QUOTING), (line(record_id="x", name='b"'), QUOTING),
        ("", COLUMN_COUNT), (None, COLUMN_COUNT), (GOOD + ",", COLUMN_COUNT), ("a,b", COLUMN_COUNT), (GOOD.replace(",", ";"), COLUMN_COUNT),
        (line(record_id="0"), VALUE), (line(record_id="2147483648"), VALUE), (line(record_id="１"), VALUE), (line(record_id=" 7"), VALUE), (line(name='""'), VALUE), (line(name="()"), VALUE), (line(name="a\x0bb"), VALUE), (line(name="a\x85b"), VALUE), (line(hint="Company"), VALUE),
        (line(conf="1.1"), VALUE), (line(conf="1e-1"), VALUE), (line(conf="nan"), VALUE), (line(batch="3.5"), VALUE), (line(at="2023-02-29 00:00:00"), VALUE), (line(at="2024-01-01T00:00:00"), VALUE), (line(at="2024-01-01 24:00:00"), VALUE),
    ],
)
def test_reasons(text, reason):
    assert parse_record(text, ",").reason == reason


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from('ab ",;\n\\é'), max_size=8), min_size=7, max_size=7))
def test_round_trip_with_quoted_fields(fields):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(fields)
    assert parse_record(out.getvalue(), ",").reason != QUOTING


def test_resumes_at_validated_anchors():
    bad = '8,"open quote,company,,,3,2024-01-01 00:00:00'
    text = "\n".join([GOOD, bad, "no, anchor", line(name='"two\nlines"'), "1,2", GOOD]) + "\r\n"
    got = list(parse_records(text, ","))
    assert [p.reason for p in got] == [None, QUOTING, None, COLUMN_COUNT, None]
    assert got[1].at == text.index('"open') and got[2].values[1] == "two\nlines"
    assert sum(p.reason is None for p in parse_records(text[:3] + "\n" + text, ",")) == 3


def test_operator(spark):
    raw = spark.createDataFrame([(1, "A", 1, GOOD), (2, "B", 1, GOOD.replace(",", ";")), (3, "A", 2, "x"), (4, "?", 1, GOOD), (5, "A", 3, None), (6, "A", 4, line(name="n" * 50_000))], "line_id long, source_list string, record_id long, raw_line string")
    lists = spark.createDataFrame([("A", ","), ("B", ";"), ("C", None)], "source_list string, delim string")
    parsed = parse_lines(with_delimiters(raw, lists))
    assert {(r.line_id, r.reason) for r in failing(parsed).collect()} == {(3, COLUMN_COUNT), (5, COLUMN_COUNT)}
    rows = {r.line_id: r for r in valid(parsed).collect()}
    assert set(rows) == {1, 2, 4, 6} and rows[2].record_id == 7 and rows[2].batch_id == 3 and len(rows[6].record_name) == 50_000
    assert parse_lines(with_delimiters(raw.limit(0), lists)).count() == 0


def test_a_batch_is_read_as_one_text():
    """Delivered starts are the anchors: a broken quote spoils its own line, and line breaks are content."""
    texts = [GOOD, line(name='"open'), line(name="a\nb"), None, GOOD.replace(",", ";"), "", line(name='"x\n""y"""'), 'z"' + GOOD]
    got = parse_batch(texts, [",", ",", ",", ",", ";", None, ",", ","])
    assert [p.reason for p in got] == [None, QUOTING, None, COLUMN_COUNT, None, COLUMN_COUNT, None, QUOTING]
    assert got[2].values[1] == "a\nb" and got[6].values[1] == 'x\n"y"' and got[1].at == 2 and got[7].at == 1
    for t, d, p in zip(texts, [",", ",", ",", ",", ";", None, ",", ","], got):
        alone = parse_record(t, d)
        assert (alone.reason, alone.field, alone.at, alone.values) == (p.reason, p.field, p.at, p.values)


def test_recovery_is_linear():
    import time

    start = time.time()
    text = "\n".join(['9,"never closed,x'] + ["no anchor " * 5] * 40_000 + [GOOD])
    assert [p.reason for p in parse_records(text, ",")][-1] is None
    assert time.time() - start < 20


def test_lists_as_texts_of_many_records(spark):
    bad = line(name='"open')
    rows = [(i, "A" if i % 3 else "B", i, bad if i in (4, 9) else GOOD if i % 3 else GOOD.replace(",", ";")) for i in range(30)] + [(99, "A", 99, None), (1, "A", 1, GOOD)]
    raw = spark.createDataFrame(rows, "line_id long, source_list string, line_no long, raw_line string")
    lists = spark.createDataFrame([("A", ","), ("B", ";")], "source_list string, delim string")
    texts = list_texts(raw, lists, lines=10)
    assert texts.count() == 6
    parsed = parse_lines(texts.selectExpr("concat(source_list, block) as place", "text", "delim"), "place", "text", "delim", single=False)
    counts = {(r.place, r.reason): r["count"] for r in parsed.groupBy("place", "reason").count().collect()}
    assert sum(n for (_, why), n in counts.items() if why is None) == 28 and counts["A0", QUOTING] == 1 and counts["B0", QUOTING] == 1
