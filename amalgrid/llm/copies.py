"""Copies of one name in other case, spacing, punctuation or word order: canonical keys, counted in a ledger.

A name has up to five keys, and names that share one are one name. The ledger is stored in buckets of the keys'
128-bit hashes and grows by batches:

* ``counts``: canonical key -> how many copies it had so far, and the earliest representative,
* ``forms``: any of the five keys -> the first canonical key that had it,
* ``links``: canonical keys that a shared form makes equal (few; their components are the names),
* ``delivered``: (id, name) seen, so that a redelivered record changes nothing.

A batch is aggregated first (with partial counts before the shuffle, so a name that a third of all rows share costs
one row a task), then full-outer-joined with the ledger's matching buckets, which are read as they lie. A batch
becomes visible at once, by the version that ``CURRENT`` names; one that fails leaves the ledger as it was. What
the ledger says does not depend on how the records were split into batches.
"""

from __future__ import annotations

import string
import unicodedata
import uuid
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgrid.llm.components import connected
from amalgrid.llm.garbled import garbled_records
from amalgrid.llm.lookalikes import NativeFold, distinct_records, lookalike_table
from amalgrid.session import cut, ensure_checkpoint_dir

_APART = regex.compile(rf"[\s\p{{P}}{regex.escape(string.punctuation)}]+")
_INSIDE = regex.compile(rf"(?<=[\p{{L}}\p{{M}}\p{{N}}])[\p{{P}}{regex.escape(string.punctuation)}]+(?=[\p{{L}}\p{{M}}\p{{N}}])")


def _pieces(text: str) -> list[str]:
    """Words in order, single letters apart."""
    return [w for w in _APART.split(text) if w]


def _joined_singles(pieces: list[str]) -> list[str]:
    out: list[str] = []
    single = False
    for w in pieces:
        one = len(w) == 1 and w.isalpha() and not ord(w) > 0x2E7F
        if one and single:
            out[-1] += w
        else:
            out.append(w)
        single = one
    return out


def _words(text: str) -> list[str]:
    """Words in order; a run of single letters (``l l c``, ``p/l``) is one word."""
    return _joined_singles(_pieces(text))


def name_keys(name: str, fold: NativeFold) -> tuple[str, str, str, str, str] | None:
    """(words sorted, the same with inner punctuation dropped, both with single letters apart, all letters in order); None for a blank name.

    Names are equal if any of the five is: a dropped hyphen makes one word of two, a changed order does not,
    and single letters may move alone.
    """
    text = fold(name)
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    pieces = _pieces(text)
    if not pieces:
        return None
    key, apart = " ".join(sorted(_joined_singles(pieces))), " ".join(sorted(pieces))
    run = "".join(pieces)
    if not _INSIDE.search(text):
        return key, key, apart, apart, run
    inside = _pieces(_INSIDE.sub("", text))
    return key, " ".join(sorted(_joined_singles(inside))), apart, " ".join(sorted(inside)), run


def _keyed(table: dict[int, str]):
    """(id, name) -> (id, name, node, forms) as 128-bit hashes; the canonical key is the first form. Blank names are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, digest = NativeFold(table), xxhash.xxh3_128_digest
        for batch in batches:
            keep, nodes, forms = [], [], []
            # Copies often come together.
            known: dict[str, tuple | None] = {}
            for at, name in enumerate(batch.column(1).to_pylist()):
                if name in known:
                    made = known[name]
                else:
                    keys = name_keys(name, fold)
                    made = known[name] = keys and (node := digest("c" + keys[0]), list({node: 0} | {digest("c" + k): 0 for k in dict.fromkeys(keys[1:4]) if k != keys[0]} | {digest("r" + keys[4]): 0}))
                if made:
                    keep.append(at)
                    nodes.append(made[0])
                    forms.append(made[1])
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(nodes, pa.binary()), pa.array(forms, pa.list_(pa.binary()))], names=["id", "name", "node", "forms"])

    return run


COUNTS, FORMS, LINKS, DELIVERED = "counts", "forms", "links", "delivered"
_SCHEMAS = {
    COUNTS: "node binary, copies long, first_id long, first_name string",
    FORMS: "form binary, node binary, low binary, high binary",
    LINKS: "a binary, b binary",
    DELIVERED: "mark binary",
}
_BUCKET_BY = {COUNTS: "node", FORMS: "form", LINKS: "a", DELIVERED: "mark"}


class CopyLedger:
    """The ledger at a path all executors share; a new one is empty.

    ``path`` defaults to a fresh folder beside the checkpoints. ``buckets`` is fixed when a ledger is made. Results read
    the version they were asked of: use them before the next batch is added. ``close`` takes the names of the
    ledger's tables out of the catalog; the files stay.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        if path is None:
            ensure_checkpoint_dir(spark)
            path = f"{spark.sparkContext.getCheckpointDir()}/copies-{uuid.uuid4().hex}"
        self.path = path
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._views: list[str] = []
        now = self._at("CURRENT")
        if self._exists(now):
            version, held = spark.read.text(now).first()[0].split(" ")
            self.version, self.buckets = int(version), int(held)
        else:
            self.version, self.buckets = 0, buckets or 2 * spark.sparkContext.defaultParallelism

    def _at(self, *parts: str) -> str:
        return "/".join([self.path, *parts])

    def _files(self, path: str):
        where = self._fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        system, where = self._files(path)
        return system.exists(where)

    def _view(self, name: str) -> str:
        self._views.append(f"ledger_{name}_{uuid.uuid4().hex}")
        return self._views[-1]

    def close(self) -> None:
        while self._views:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._views.pop()}")

    def table(self, name: str) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], _SCHEMAS[name])
        view = self._view(name)
        by = _BUCKET_BY[name]
        self.spark.sql(f"CREATE TABLE {view} ({_SCHEMAS[name]}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self._at(f'v{self.version}', name)}'")
        return self.spark.table(view)

    def _store(self, df: DataFrame, name: str, version: int) -> DataFrame:
        by = _BUCKET_BY[name]
        view = self._view(name)
        df.write.format("parquet").mode("overwrite").option("path", self._at(f"v{version}", name)).bucketBy(self.buckets, by).sortBy(by).saveAsTable(view)
        return self.spark.table(view)

    def _publish(self, version: int) -> None:
        """The pointer is written beside and renamed; then the version before is no longer needed."""
        system, now = self._files(self._at("CURRENT"))
        beside = self._fs.Path(self._at(f"v{version}", "CURRENT"))
        stream = system.create(beside, True)
        stream.write(bytearray(f"{version} {self.buckets}\n".encode()))
        stream.close()
        system.delete(now, False)
        if not system.rename(beside, now):
            raise OSError(f"could not publish version {version} of the ledger at {self.path}")
        if self.version:
            system.delete(self._fs.Path(self._at(f"v{self.version}")), True)
        self.version = version

    def add(self, batch: DataFrame, id_col: str = "record_id", name_col: str = "record_name", garbled: DataFrame | None = None) -> DataFrame:
        """Take a batch in; returns (node, id) of its records that are new.

        A record (id and name) counts once, however often and in whatever batches it is delivered; an id that comes
        with two names counts with each. Null, blank and garbled names (ids in ``garbled``) have no key.
        """
        version = self.version + 1
        rows = distinct_records(batch, id_col, name_col)
        if garbled is not None:
            rows = rows.join(garbled.select(F.col(id_col).alias("id")).distinct(), "id", "left_anti")
        mark = F.unhex(F.md5(F.concat_ws("\n", F.col("id").cast("string"), "name")))
        seen = self.table(DELIVERED)
        new = rows.withColumn("mark", mark)
        if self.version:
            new = new.join(seen, "mark", "left_anti")
        kind = new.schema["id"].dataType.simpleString()
        keyed = cut(new.select("id", "name").mapInArrow(_keyed(lookalike_table(self.spark)), f"id {kind}, name string, node binary, forms array<binary>"))
        self._store(seen.unionByName(keyed.select(mark.alias("mark"))), DELIVERED, version)
        # Counts of the batch, added to those of the matching buckets.
        counts = keyed.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "name")).alias("first"))
        old, fresh = self.table(COUNTS).alias("l"), counts.alias("n")
        first = F.array_min(F.array_compact(F.array(F.when(F.col("l.node").isNotNull(), F.struct(F.col("l.first_id").alias("id"), F.col("l.first_name").alias("name"))), F.when(F.col("n.node").isNotNull(), F.struct(F.col("n.first.id").cast("long").alias("id"), F.col("n.first.name").alias("name"))))))
        merged = old.join(fresh, F.col("l.node") == F.col("n.node"), "full_outer").select(F.coalesce("l.node", "n.node").alias("node"), (F.coalesce("l.copies", F.lit(0)) + F.coalesce("n.copies", F.lit(0))).cast("long").alias("copies"), first.alias("first"))
        self._store(merged.select("node", "copies", F.col("first.id").alias("first_id"), F.col("first.name").alias("first_name")), COUNTS, version)
        # Forms: the first canonical key stays; others that share the form are linked with it.
        uses = keyed.select("node", F.explode("forms").alias("form"))
        held = uses.groupBy("form").agg(F.min("node").alias("low"), F.max("node").alias("high")).alias("n")
        both = self.table(FORMS).alias("l").join(held, F.col("l.form") == F.col("n.form"), "full_outer")
        forms = self._store(both.select(F.coalesce("l.form", "n.form").alias("form"), F.coalesce("l.node", "n.low").alias("node"), "n.low", "n.high"), FORMS, version)
        shared = forms.filter("low <> node or high <> node").select("form", F.col("node").alias("b"))
        links = uses.join(shared, "form").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
        self._store(self.table(LINKS).unionByName(links), LINKS, version)
        self._publish(version)
        return keyed.select("node", F.col("id").cast("long").alias("id"))

    def _linked(self) -> tuple[DataFrame, DataFrame]:
        """Counts of the keys that stand alone, and of the linked ones with their component's ``root``."""
        groups = connected(self.table(LINKS))
        counts = self.table(COUNTS)
        return counts.join(groups, "node", "left_anti"), cut(counts.join(groups, "node"))

    def _whole(self, linked: DataFrame) -> DataFrame:
        return linked.groupBy("root").agg(F.sum("copies").alias("copies"), F.min(F.struct("first_id", "first_name")).alias("first")).select("root", "copies", "first.first_id", "first.first_name")

    def names(self) -> DataFrame:
        """(first_id, first_name, copies): one row a name."""
        alone, linked = self._linked()
        return alone.select("first_id", "first_name", "copies").unionByName(self._whole(linked).drop("root"))

    def by_key(self) -> DataFrame:
        """(node, first_id, copies): each canonical key with the figures of its whole name."""
        alone, linked = self._linked()
        whole = linked.select("node", "root").join(self._whole(linked), "root")
        return alone.select("node", "first_id", "copies").unionByName(whole.select("node", "first_id", "copies"))

    def copies(self, members: DataFrame) -> DataFrame:
        """(first_id, copy_id) of ``members(node, id)``: each record whose name has more than one copy, with its first."""
        repeated = self.by_key().filter("copies > 1").select("node", "first_id")
        return members.join(repeated, "node").filter("id <> first_id").select("first_id", F.col("id").alias("copy_id")).distinct()


def collapse(df: DataFrame, id_col: str = "record_id", name_col: str = "record_name", garbled: DataFrame | None = None, batch_col: str | None = None, batches: int = 1) -> tuple[CopyLedger, DataFrame]:
    """(ledger, members) of a table taken in as ``batches`` batches, by the hash of ``batch_col``.

    ``garbled`` holds the ids whose names are garbled; by default problem 4 finds them in the whole table.
    """
    bad = cut((garbled if garbled is not None else garbled_records(df, id_col, name_col)).select(id_col).distinct())
    ledger = CopyLedger(df.sparkSession)
    members = None
    for k in range(batches):
        part = df if batches == 1 else df.filter(F.pmod(F.xxhash64(batch_col), F.lit(batches)) == k)
        added = ledger.add(part, id_col, name_col, bad)
        members = added if members is None else members.unionByName(added)
    return ledger, members
