"""Delimited records with error recovery: typed rows out, failing rows apart with reason and place.

The grammar, read by recursive descent over one text::

    record := field (DELIM field)* END
    field  := quoted | bare
    quoted := '"' ('""' | any char but '"')* '"'      (followed by DELIM or END)
    bare   := (any char but '"' and DELIM)*

A text holds many records, one after the other. END is a line break outside quotes, and after a broken quote
the parser resumes at the next *validated anchor*: a line start from which a record of the right width with a
valid first field can be read. Where each record was delivered apart (``single=True``), the delivered starts are
the anchors: the parser reads a batch as one text and resumes at the next of them, and line breaks are content.

Defined results: a null text is one failing record with reason ``column_count``; an empty text is a
single empty field and fails the same way; an unknown (null) delimiter is read as a comma.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTING, COLUMN_COUNT, VALUE = "quoting", "column_count", "value"
REASONS = (QUOTING, COLUMN_COUNT, VALUE)


# --- values -----------------------------------------------------------------------------------

_INT = re.compile(r"[0-9]+")
_DECIMAL = re.compile(r"[0-9]+(?:\.[0-9]+)?|\.[0-9]+")
_STAMP = re.compile(r"([0-9]{4})-([0-9]{2})-([0-9]{2}) ([0-9]{2}):([0-9]{2}):([0-9]{2})")
_WORDLY = regex.compile(r"[\p{L}\p{Nd}]")
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")


def bounded_int(low: int, high: int) -> Callable[[str], int]:
    def read(s: str) -> int:
        if not _INT.fullmatch(s) or len(s.lstrip("0")) > 19 or not low <= int(s) <= high:
            raise ValueError("not an integer in range")
        return int(s)

    return read


def display_text(s: str) -> str:
    """Text with a letter or digit and no control character but tab, CR and LF."""
    if not _WORDLY.search(s) or _CONTROL.search(s):
        raise ValueError("no letter or digit, or a control character")
    return s


def one_of(*values: str) -> Callable[[str], str]:
    allowed = frozenset(values)

    def read(s: str) -> str:
        if s not in allowed:
            raise ValueError("not an allowed value")
        return s

    return read


def free_text(s: str) -> str:
    return s


def unit_decimal(s: str) -> float | None:
    """Empty (null) or a plain decimal from 0 to 1."""
    if not s:
        return None
    if not _DECIMAL.fullmatch(s) or not 0 <= float(s) <= 1:
        raise ValueError("not a decimal from 0 to 1")
    return float(s)


def timestamp(s: str) -> dt.datetime:
    m = _STAMP.fullmatch(s)
    if not m:
        raise ValueError("not a time")
    return dt.datetime(*map(int, m.groups()))


@dataclass(frozen=True)
class Field:
    name: str
    read: Callable[[str], object]
    kind: T.DataType


#: The layout of lines bound for processed_records.
PROCESSED_RECORD = (
    Field("record_id", bounded_int(1, 2**31 - 1), T.LongType()),
    Field("record_name", display_text, T.StringType()),
    Field("type_hint", one_of("", "company", "trust", "government", "security"), T.StringType()),
    Field("gliner_type", free_text, T.StringType()),
    Field("gliner_confidence", unit_decimal, T.DoubleType()),
    Field("batch_id", bounded_int(1, 2**31 - 1), T.IntegerType()),
    Field("processed_at", timestamp, T.TimestampNTZType()),
)


# --- grammar ----------------------------------------------------------------------------------


class BrokenQuote(Exception):
    def __init__(self, field: int, at: int, start: int | None = None):
        self.field, self.at, self.start = field, at, at if start is None else start


@dataclass
class Parsed:
    """One record: its typed values, or why and where it failed."""

    start: int
    end: int
    values: list | None = None
    reason: str | None = None
    field: str | None = None
    at: int | None = None


def _quoted(text: str, at: int, end: int, index: int) -> tuple[str, int]:
    close = text.find('"', at + 1, end)
    while close >= 0 and text.startswith('""', close):
        close = text.find('"', close + 2, end)
    if close < 0:
        raise BrokenQuote(index, at)
    return text[at + 1 : close].replace('""', '"'), close + 1


def _bare(text: str, at: int, end: int, delim: str, line_end: bool, index: int) -> tuple[str, int]:
    if line_end:
        # Within the line first: looking for a delimiter must not run through the rest of the text.
        brk = text.find("\n", at, end)
        end = brk if brk >= 0 else end
    stop = text.find(delim, at, end)
    stop = end if stop < 0 else stop
    quote = text.find('"', at, stop)
    if quote >= 0:
        raise BrokenQuote(index, quote)
    return text[at:stop], stop


def _record(text: str, at: int, end: int, delim: str, line_end: bool) -> tuple[list[str], list[int], int]:
    """Fields, their places, and where the record ends. With ``line_end`` a bare line break ends it."""
    fields: list[str] = []
    places: list[int] = []
    while True:
        places.append(at)
        field, stop = (_quoted(text, at, end, len(fields)) if text.startswith('"', at) and at < end else _bare(text, at, end, delim, line_end, len(fields)))
        if stop < end and not text.startswith(delim, stop):
            if not (line_end and (text[stop] == "\n" or text.startswith("\r\n", stop))):
                raise BrokenQuote(len(fields), stop, places[-1])
            fields.append(field)
            return fields, places, stop
        fields.append(field)
        if stop >= end:
            return fields, places, stop
        at = stop + 1


def _typed(fields: list[str], places: list[int], start: int, end: int, layout: tuple[Field, ...]) -> Parsed:
    if len(fields) != len(layout):
        return Parsed(start, end, reason=COLUMN_COUNT, at=places[min(len(places), len(layout)) - 1])
    values = []
    for spec, raw, place in zip(layout, fields, places):
        try:
            values.append(spec.read(raw))
        except ValueError:
            return Parsed(start, end, reason=VALUE, field=spec.name, at=place)
    return Parsed(start, end, values=values)


def _check_delim(delim: str | None) -> str:
    delim = delim or ","
    if len(delim) != 1 or delim in '"\r\n':
        raise ValueError(f"a delimiter is one character, and no quote or line break: {delim!r}")
    return delim


def parse_records(text: str | None, delim: str | None, layout: tuple[Field, ...] = PROCESSED_RECORD, starts: list[int] | None = None) -> Iterator[Parsed]:
    """All records of a text of many, each with its values or its failure.

    Without ``starts`` a line break outside quotes ends a record, and after a broken quote the parser resumes at the
    next validated anchor. ``starts`` names the places where records are known to begin (the first is 0, and a line
    break stands before each other one): these are the anchors then, and line breaks between them are content.
    """
    if text is None:
        yield Parsed(0, 0, reason=COLUMN_COUNT, at=0)
        return
    if starts is None and not text:
        return
    delim = _check_delim(delim)
    end = len(text)
    last_quote = text.rfind('"')

    def record(at: int, stop: int) -> tuple[list[str], list[int], int]:
        fields, places, after = _record(text, at, stop, delim, starts is None)
        if starts is None:
            fields[-1] = fields[-1].removesuffix("\r")
        return fields, places, after

    def is_anchor(pos: int) -> bool:
        if text.startswith('"', pos) and pos >= last_quote:
            return False
        try:
            fields, _, _ = record(pos, end)
            if len(fields) != len(layout):
                return False
            layout[0].read(fields[0])
        except (BrokenQuote, ValueError):
            return False
        return True

    def anchor_after(at: int) -> int:
        """The end of what a broken quote spoilt: the line break before the next anchor, or the end."""
        stop = text.find("\n", at, end)
        while 0 <= stop < end and not is_anchor(stop + 1):
            stop = text.find("\n", stop + 1, end)
        return end if stop < 0 else stop

    known = iter(starts or ())
    at, following = (next(known), next(known, None)) if starts else (0, None)
    while True:
        bound = end if following is None else following - 1
        try:
            fields, places, stop = record(at, bound)
            yield _typed(fields, places, at, stop, layout)
        except BrokenQuote as e:
            stop = bound if starts else anchor_after(at)
            # A quote left open runs into later records; its own place is then where it opened.
            yield Parsed(at, stop, reason=QUOTING, field=layout[e.field].name if e.field < len(layout) else None, at=e.at if e.at <= stop else e.start)
        if starts:
            if following is None:
                return
            at, following = following, next(known, None)
        else:
            brk = text.find("\n", stop, end)
            at = brk + 1 if brk >= 0 else end
            if at >= end:
                return


def parse_record(text: str | None, delim: str | None, layout: tuple[Field, ...] = PROCESSED_RECORD) -> Parsed:
    """The whole text as one record."""
    return next(parse_records(text, delim, layout, [0]))


def parse_batch(texts: list[str | None], delims: list[str | None], layout: tuple[Field, ...] = PROCESSED_RECORD) -> list[Parsed]:
    """Texts of one record each, read as one text per delimiter whose anchors are the places where they begin.

    A broken quote spoils its own text alone; places count from the beginning of each text.
    """
    out: list[Parsed | None] = [None] * len(texts)
    together: dict[str, list[int]] = {}
    for k, (text, delim) in enumerate(zip(texts, delims)):
        if text is None:
            out[k] = Parsed(0, 0, reason=COLUMN_COUNT, at=0)
        else:
            together.setdefault(_check_delim(delim), []).append(k)
    for delim, places in together.items():
        starts, at = [], 0
        for k in places:
            starts.append(at)
            at += len(texts[k]) + 1
        for k, start, p in zip(places, starts, parse_records("\n".join(texts[k] for k in places), delim, layout, starts)):
            p.start, p.end, p.at = p.start - start, p.end - start, None if p.at is None else p.at - start
            out[k] = p
    return out


# --- operator ---------------------------------------------------------------------------------


def parse_lines(
    lines: DataFrame,
    id_col: str = "line_id",
    text_col: str = "raw_line",
    delim_col: str = "delim",
    layout: tuple[Field, ...] = PROCESSED_RECORD,
    single: bool = True,
) -> DataFrame:
    """One row per record found: id, place, ``reason`` (null for a valid one), its place, and the typed fields.

    One narrow pass, no shuffle; other columns of ``lines`` are left behind, so clashing names do no harm.
    An empty input gives an empty result.
    """
    source = lines.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(delim_col).alias("_delim"))
    id_type = source.schema["_id"].dataType
    schema = T.StructType(
        [T.StructField(id_col, id_type), T.StructField("start_at", T.IntegerType()), T.StructField("reason", T.StringType()), T.StructField("reason_field", T.StringType()), T.StructField("reason_at", T.IntegerType())]
        + [T.StructField(f.name if f.name != id_col else f"{f.name}_value", f.kind) for f in layout]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in schema]
            keys, texts, delims = (batch.column(k).to_pylist() for k in range(3))
            parsed = zip(keys, ([p] for p in parse_batch(texts, delims, layout))) if single else zip(keys, (parse_records(t, d, layout) for t, d in zip(texts, delims)))
            for key, found in parsed:
                for p in found:
                    row = [key, p.start, p.reason, p.field, p.at, *(p.values if p.values is not None else [None] * len(layout))]
                    for c, v in zip(cols, row):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, arrow)], schema=arrow)

    return source.mapInArrow(run, schema)


def failing(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull())


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason", "reason_field", "reason_at")


def with_delimiters(raw: DataFrame, lists: DataFrame) -> DataFrame:
    """Each raw line with the delimiter of its list (null where the list is unknown).

    The list table is one row per list; Spark broadcasts it while its measured size stays under
    ``spark.sql.autoBroadcastJoinThreshold`` and joins by shuffle, with AQE's skew split, beyond it.
    """
    delims = lists.groupBy("source_list").agg(F.min("delim").alias("delim"))
    return raw.select("line_id", "source_list", "raw_line").join(delims, "source_list", "left").select("line_id", "raw_line", "delim")


def list_texts(raw: DataFrame, lists: DataFrame, lines: int = 1000) -> DataFrame:
    """(source_list, block, text, delim): the lines of each list as texts of up to so many lines, in their order.

    A list that holds a third of all lines is many texts, so no task gathers a whole list; a text begins where a
    delivered line begins. Null lines are left out.
    """
    delims = lists.groupBy("source_list").agg(F.min("delim").alias("delim"))
    block = F.floor(F.col("line_no") / lines).cast("long")
    kept = raw.filter("raw_line is not null").select("source_list", block.alias("block"), "line_no", "line_id", "raw_line").distinct()
    texts = kept.groupBy("source_list", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line_id", "raw_line"))), lambda x: x["raw_line"]), "\n").alias("text"))
    return texts.join(delims, "source_list", "left").select("source_list", "block", "text", "delim")
