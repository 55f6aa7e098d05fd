"""A resumable batch ledger of append-only Parquet: records, batch events and logs.

Nothing is updated in place. A batch's state is its latest event; a reset is an event too. Records of a
batch live in its own partition, so storing a batch again replaces it (idempotent under task retries). Batch
numbers are claimed by creating a file that must not exist yet, so two runs never share one.
``ledger_stream`` runs the same sanitiser over a stream with exactly-once batches.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amalgrid.functions.casing import config_hash
from amalgrid.functions.cleaning import sanitise
from amalgrid.operators.tables import batch_plan, dense_ids, without
from amalgrid.session import cut

S, L, D, I, TS = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.TimestampType()
RECORDS = T.StructType([T.StructField(n, k) for n, k in (("record_id", L), ("record_name", S), ("orig", S), ("norm", S), ("display_name", S), ("canonical_name", S), ("match_key_strict", S), ("match_key_aggressive", S), ("type_hint", S), ("gliner_type", S), ("gliner_confidence", D), ("processed_at", TS), ("batch_id", I))])
BATCHES = T.StructType([T.StructField(n, k) for n, k in (("batch_id", I), ("start_index", L), ("end_index", L), ("total_records", I), ("config_hash", S), ("event_at", TS), ("seq", L), ("status", S), ("error", S))])
LOGS = T.StructType([T.StructField(n, k) for n, k in (("log_id", L), ("batch_id", I), ("log_level", S), ("message", S), ("logged_at", TS))])
#: Seconds to wait for another run to finish its claim of batch numbers.
CLAIM_WAIT = 30
STARTED, COMPLETED, FAILED, RESET = "STARTED", "COMPLETED", "FAILED", "RESET"


def latest_batches(batches: DataFrame) -> DataFrame:
    """One row a batch: its latest known state. Works on the driver's table of batches as well."""
    order = [F.coalesce("completed_at", "started_at").desc_nulls_last(), F.when(F.col("status") == COMPLETED, 2).when(F.col("status") == FAILED, 1).otherwise(0).desc(), F.desc("start_index"), F.desc("end_index"), F.desc("total_records"), F.desc("config_hash")]
    return batches.withColumn("_r", F.row_number().over(Window.partitionBy("batch_id").orderBy(*order))).filter("_r = 1").drop("_r")


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        target = f"{self.path}/{name}"
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(target)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(target)

    def _append(self, name: str, rows: list[tuple], schema: T.StructType) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def events(self) -> DataFrame:
        return self._read("batches", BATCHES)

    def batches(self) -> DataFrame:
        """Each batch with its latest event; reset ones are gone."""
        w = Window.partitionBy("batch_id").orderBy(F.desc("seq"))
        return self.events().withColumn("_r", F.row_number().over(w)).filter((F.col("_r") == 1) & (F.col("status") != RESET)).drop("_r")

    def records(self) -> DataFrame:
        return self._read("records", RECORDS)

    def logs(self) -> DataFrame:
        return self._read("logs", LOGS)

    def _place(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _events(self, rows: list[tuple]) -> None:
        """Rows (batch_id, status, start, end, total, config, error), in the order in which they happened."""
        seq = self.events().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0] + 1
        now = dt.datetime.now()
        self._append("batches", [(b, start, end, total, config, now, seq + k, status, error) for k, (b, status, start, end, total, config, error) in enumerate(rows)], BATCHES)

    def _event(self, batch_id: int, status: str, error: str | None = None) -> None:
        self._events([(batch_id, status, None, None, None, None, error)])

    def _logs(self, rows: list[tuple[int | None, str, str]]) -> None:
        number = self.logs().agg(F.coalesce(F.max("log_id"), F.lit(0))).first()[0] + 1
        now = dt.datetime.now()
        self._append("logs", [(number + k, batch, level, message, now) for k, (batch, level, message) in enumerate(rows)], LOGS)

    def log(self, batch_id: int | None, level: str, message: str) -> None:
        self._logs([(batch_id, level, message)])

    def next_batch_id(self) -> int:
        """The number after all that any run has claimed or used."""
        top = self.events().agg(F.coalesce(F.max("batch_id"), F.lit(0))).first()[0]
        system, place = self._place("_claims")
        if system.exists(place):
            # One small file a run, named first_count.
            names = [f.getPath().getName() for f in system.listStatus(place)]
            top = max([top, *(int(first) + int(n) - 1 for first, n in (x.split("_") for x in names if x[:1].isdigit()))])
        return top + 1

    def claim(self, n: int) -> int:
        """The first of ``n`` batch numbers that are this run's own."""
        waited = 0
        while True:
            first = self.next_batch_id()
            system, lock = self._place("_claims", f".{first}")
            try:
                system.create(lock, False).close()
            except Exception:
                # Another run was faster; its claim is complete when the file that says how many is there.
                if not system.exists(lock) or waited >= CLAIM_WAIT:
                    raise
                time.sleep(1)
                waited += 1
                continue
            taken, place = self._place("_claims", f"{first}_{n}")
            taken.create(place, True).close()
            return first

    def start(self, start: int, end: int, total: int, config: dict | None = None) -> int:
        return self._start([(start, end, total)], config)

    def _start(self, bounds: list[tuple[int, int, int]], config: dict | None) -> int:
        """Announces batches (first id, last id, records); gives the number of the first, the others follow."""
        first = self.claim(len(bounds))
        made = config_hash(config or {})
        self._events([(first + k, STARTED, *b, made, None) for k, b in enumerate(bounds)])
        self._logs([(first + k, "INFO", f"batch {first + k} started") for k in range(len(bounds))])
        return first

    def complete(self, batch_id: int, n: int = 1) -> None:
        self._events([(b, COMPLETED, None, None, None, None, None) for b in range(batch_id, batch_id + n)])
        self._logs([(b, "INFO", f"batch {b} completed") for b in range(batch_id, batch_id + n)])

    def fail(self, batch_id: int, error: str) -> None:
        self._event(batch_id, FAILED, error=error)
        self.log(batch_id, "ERROR", error)

    def store(self, batch_id: int | Column, results: DataFrame) -> None:
        """The columns that the table has; others are left behind, missing ones are null. A column may give each row its batch."""
        batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
        made = results.withColumn("batch_id", batch).withColumn("processed_at", F.current_timestamp())
        made = made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORDS])
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.path}/records")

    def unprocessed(self, source: DataFrame, key: str = "record_id") -> DataFrame:
        return without(source, self.records(), key)

    def failed(self) -> DataFrame:
        return self.batches().filter(F.col("status") == FAILED).orderBy("batch_id")

    def reset_failed(self) -> int:
        """Marks failed batches as reset and drops their records; gives their number."""
        ids = [r[0] for r in self.failed().select("batch_id").collect()]  # a report of batches, not of records
        for b in ids:
            system, place = self._place("records", f"batch_id={b}")
            system.delete(place, True)
        if ids:
            self._events([(b, RESET, None, None, None, None, None) for b in ids])
        return len(ids)

    def reset(self, confirm: bool = False) -> None:
        if not confirm:
            raise ValueError("resetting the ledger needs confirm=True")
        system, place = self._place()
        if system.exists(place) and not system.delete(place, True):
            raise OSError(f"could not delete {self.path}")

    def stats(self) -> dict[str, DataFrame]:
        records = self.records()
        return {"total": records.agg(F.count(F.lit(1)).alias("n")), "types": type_counts(records), "batches": batch_status(self.batches())}

    def export(self, path: str, with_batch: bool = False) -> int:
        """CSV files in the order of the ids (part after part); gives the number of records."""
        out = export_columns(self.records(), with_batch)
        out.orderBy("record_id").write.mode("overwrite").option("header", True).csv(path)
        return out.count()

    def run(self, source: DataFrame, size: int = 5000, resume: bool = True, work: Callable[[DataFrame], DataFrame] = sanitise, config: dict | None = None) -> int:
        """Sanitises ``source(record_id, record_name, ...)`` in batches; a failing batch is recorded and skipped.

        All batches are written by one job that reads the source once. Only if that fails are they tried one by one,
        to find out which of them fail. ``work`` has to pass a column ``_batch`` through; if it does not, batches are
        tried one by one at once.
        """
        todo = cut(self.unprocessed(source) if resume else source)
        # One row a batch: the plan, not the records.
        plan = batch_plan(todo, "record_id", size).orderBy("batch").collect()
        if not plan:
            return 0
        first = self._start([(b.start_id, b.end_id, b.n) for b in plan], config)
        numbered = todo.join(dense_ids(todo, "record_id", "_pos"), "record_id").withColumn("_batch", (F.floor(F.col("_pos") / size) + first).cast("int")).drop("_pos")
        try:
            made = work(numbered)
            if "_batch" not in made.columns:
                raise ValueError("the batches are not told apart")
            self.store(F.col("_batch"), made)
            self.complete(first, len(plan))
            return len(plan)
        except Exception:  # some batch fails: find out which
            pass
        done = 0
        for k, b in enumerate(plan):
            try:
                self.store(first + k, work(todo.filter(F.col("record_id").between(b.start_id, b.end_id))))
                self.complete(first + k)
                done += 1
            except Exception as e:  # the next batches still run; the failure is on record
                self.fail(first + k, str(e)[:500])
        return done

    def report(self, path: str | None = None) -> str:
        """The run's figures as Markdown; written to ``path`` where one is given."""
        s = {k: v.collect() for k, v in self.stats().items()}  # aggregated: a few rows
        b = s["batches"][0]
        lines = ["# Processing report", "", f"Date: {dt.datetime.now().isoformat(timespec='seconds')}", "", f"Records: {s['total'][0].n}", f"Batches: {b.total_batches} ({b.completed} completed, {b.failed} failed, {b.open} open)"]
        lines += ["", "## Types", "", "| type | records |", "| --- | --- |", *(f"| {r.type_hint} | {r.n} |" for r in s["types"])]
        lines += ["", "## Columns", "", *(f"- {name}: {what}" for name, what in COLUMNS)]
        text = "\n".join(lines) + "\n"
        if path is not None:
            write_text(self.spark, path, text)
        return text


# What the result columns hold, for reports.
COLUMNS = (
    ("record_name", "the name as it came"),
    ("display_name", "lightly cleaned"),
    ("canonical_name", "in title case, acronyms kept"),
    ("match_key_strict", "without designators, punctuation and spacing normalised"),
    ("match_key_aggressive", "also without stop words and punctuation, & as and"),
    ("type_hint", "the kind of entity by rule"),
)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file on any file system Spark can reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def type_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("type_hint").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col("type_hint").asc_nulls_last())


def batch_status(batches: DataFrame) -> DataFrame:
    return batches.agg(F.count(F.lit(1)).alias("total_batches"), F.count_if(F.col("status") == COMPLETED).alias("completed"), F.count_if(F.col("status") == FAILED).alias("failed"), F.count_if(F.col("status") == STARTED).alias("open"))


def export_columns(records: DataFrame, with_batch: bool = False) -> DataFrame:
    names = ["record_id", "record_name", "orig", "norm", "display_name", "canonical_name", "match_key_strict", "match_key_aggressive", "type_hint", "gliner_type", "gliner_confidence"]
    names += ["batch_id", "processed_at"] if with_batch else []
    return records.select(*[n for n in names if n in records.columns])


def ledger_stream(source: DataFrame, path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] = sanitise):
    """Sanitises a stream into the ledger's records; the stream's batch id is the partition, so a replay replaces."""

    def write(batch: DataFrame, number: int) -> None:
        Ledger(batch.sparkSession, path).store(number + 1, work(batch))

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
