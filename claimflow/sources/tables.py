"""Table scans, state tables by bucket, and append-only logs.

State tables are plain partitioned parquet. The rows of a process lie in one bucket of every table it has rows in, so a
run reads the buckets its batch touches and replaces them, or puts files with its new rows beside what they hold. All tables
of a run are written to a staging folder first, as their plans read each other's old rows, and its folders and files are
then moved into place.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from claimflow.functions.clock import stamp
from claimflow.schemas import TABLES
from claimflow.session import folder_bytes, passing
from claimflow.sources.dictionaries import dictionaries

WRITERS = 6
#: Buckets of a store; a bucket of the largest table should fit a few tasks.
BUCKETS = 64
#: Rows are moved to their buckets in parts of about so many stored bytes, so that shuffle files hold one part of a table at a time.
PART_BYTES = 64 << 20
#: Tables kept by bucket of a process, with the column that names it.
KEYED = {"process": "id", "raw_latest": "id"} | dict.fromkeys(
    ("queue", "vehicle", "party", "contact", "event", "step", "document", "sla", "user_history", "summary"), "process")
#: Tables that only grow: a run's rows are partitions of their own, which a repeated run replaces.
APPENDED = {"raw_history": ("capture_date", "version")} | dict.fromkeys(("outbox", "run_log", "api_log", "notification_log"), ("version",))
#: Tables that hold raw text. Their rows take many times the room of others while they are moved.
WIDE = ("raw_latest", "raw_history", "outbox", "api_log", "notification_log")
_COMMIT = "version long, marker string, staged string, modes map<string, string>"


class CommitRefused(RuntimeError):
    """Another writer has committed this version; nothing of the run is visible."""


def load(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan a parquet table, reading only the wanted columns."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table


def empty(spark: SparkSession, name: str) -> DataFrame:
    """No rows, and the optimizer knows: joins with it are left out before anything is shuffled for them."""
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in TABLES[name]]
    return spark.range(1).select(*columns).filter(F.lit(False))


def known_ids(table: DataFrame, key: str = "id") -> DataFrame:
    """Ids already stored, for semi and anti joins. Never collected."""
    return table.select(key).distinct()


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(buckets)).cast("int")


class StateTables:
    """The state tables under one shared folder.

    A run loads the buckets it touches, computes their new rows and commits them as the next version. Runs follow one
    another: a second writer of a version is refused. The commit file is written between staging and putting in place, so
    a run that was broken off before it has changed nothing, and one after it is finished by the next
    (``version`` does so). Who reads while tables are put in place may see some of them before others.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = self._settled(buckets)

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _create(self, name: str, text: str) -> bool:
        """Write a small file that only one writer can create."""
        fs, path = self._path(name)
        try:
            out = fs.create(path, False)
        except Exception:
            if fs.exists(path):
                return False
            raise
        out.write(bytearray(text, "utf-8"))
        out.close()
        return True

    def _settled(self, buckets: int) -> int:
        """The number of buckets the folder was created with."""
        self._create("buckets.json", json.dumps({"buckets": buckets}))
        return self.spark.read.schema("buckets int").json(f"{self.root}/buckets.json").first()["buckets"]

    # --- versions

    def _versions(self) -> list[int]:
        fs, path = self._path("commits")
        return [int(file.getPath().getName().split(".")[0]) for file in fs.listStatus(path)] if fs.exists(path) else []

    def _commits(self) -> DataFrame:
        return self.spark.read.schema(_COMMIT).json(f"{self.root}/commits")

    def booked(self, marker: str) -> bool:
        """Whether a commit with this marker was made."""
        return bool(self._versions()) and not self._commits().filter(F.col("marker") == marker).isEmpty()

    def version(self) -> int:
        """Last committed version, -1 for none. What a broken-off run left to put in place is put in place."""
        last = max(self._versions(), default=-1)
        if last >= 0:
            commit = self.spark.read.schema(_COMMIT).json(f"{self.root}/commits/{last:012d}.json").first()
            fs, staged = self._path(f"staged/{commit['staged']}")
            if fs.exists(staged):
                self._put_in_place(commit["staged"], commit["modes"])
        return last

    # --- reading

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of the processes named by the only column; never more than there are buckets."""
        found = keys.select(bucket_of(F.col(keys.columns[0]), self.buckets).alias("bucket")).distinct()
        return sorted(row["bucket"] for row in found.collect())

    def load(self, *names: str, buckets: list[int] | None = None) -> dict[str, DataFrame]:
        """The tables, of those kept by process only the given buckets."""
        return {name: self._scan(name, buckets) for name in names or tuple(TABLES)}

    def _scan(self, name: str, buckets: list[int] | None) -> DataFrame:
        fs, path = self._path(name)
        if not fs.exists(path):
            return empty(self.spark, name)
        table = self.spark.read.schema(_stored(name)).parquet(f"{self.root}/{name}")
        if buckets is not None and name in KEYED:
            table = table.filter(F.col("bucket").isin(buckets) if buckets else F.lit(False))
        return table.select(*TABLES[name].fieldNames())

    def parts(self, size: int, buckets: list[int] | None = None) -> list[list[int]]:
        """The buckets (all, if none are named) in as many groups as ``size`` bytes of their rows have parts; a bucket is never split."""
        found = list(range(self.buckets)) if buckets is None else buckets
        number = max(1, min(len(found), -(-size // PART_BYTES)))
        return [found[i::number] for i in range(number)]

    def narrow_bytes(self) -> int:
        """Stored bytes of the tables kept by process, but for raw text."""
        return sum(folder_bytes(self.spark, f"{self.root}/{name}") for name in KEYED if name not in WIDE)

    # --- writing

    def commit(
        self, version: int, tables: dict[str, DataFrame], added: dict[str, DataFrame] | None = None, marker: str | None = None,
        buckets: list[int] | None = None, size: int = 0, parts: list[Callable[[], tuple[dict[str, DataFrame], dict[str, DataFrame]]]] | None = None,
    ) -> bool:
        """Publish ``tables`` and the rows ``added`` to others as a version.

        With ``buckets``, tables kept by process hold the new rows of these buckets, and other buckets are left alone;
        without, they are whole tables. Rows for another bucket are refused. A table never loses all rows of a bucket.
        ``size`` is that of the batch: a large one is staged a few buckets at a time (``parts``). Plans that would do all their work
        again for each of them come as ``parts`` instead: every call makes the tables and added rows of some buckets, which are staged before the next is made.
        False for a version that is already committed; ``CommitRefused`` if another writer takes it meanwhile.
        """
        if version <= self.version():
            return False
        name = f"{version:012d}-{uuid4().hex}"
        whole = "whole" if buckets is None else "buckets"
        *earlier, _ = self.parts(size, buckets)
        # the last part is the rest, rows of any other bucket included
        chosen = [F.col("bucket").isin(part) for part in earlier] + [~F.col("bucket").isin([bucket for part in earlier for bucket in part])]

        def stage(table: str, rows: DataFrame) -> None:
            rows = rows.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in TABLES[table]])
            parts = [rows]
            if table in KEYED:  # one file per bucket, more for a large one
                rows = rows.withColumn("bucket", bucket_of(F.col(KEYED[table]), self.buckets))
                parts = [(rows.filter(part) if earlier else rows).hint("rebalance", "bucket") for part in chosen]
            if table in APPENDED:
                parts = [rows.withColumn("version", F.lit(version).cast("long"))]
            for part in parts:
                part.write.mode("append").option("compression", "zstd").partitionBy(*_partitions(table)).parquet(f"{self.root}/staged/{name}/{table}")

        modes: dict[str, str] = {}
        for made in parts or [lambda: (tables, added or {})]:
            with passing(self.spark):
                rewritten, more = made()
                content = rewritten | {table: rows if table in KEYED or table in APPENDED else self._scan(table, None).unionByName(rows) for table, rows in more.items()}
                modes |= {table: whole if table in KEYED else "whole" for table in rewritten}
                modes |= {table: "added" if table in KEYED or table in APPENDED else "whole" for table in more}
                # the wide ones first and one at a time, so that the disk holds the shuffle files of one; the others need not wait for each other
                for table in WIDE:
                    if table in content:
                        stage(table, content[table])
                with ThreadPoolExecutor(WRITERS) as pool:
                    for job in [pool.submit(stage, table, content[table]) for table in content if table not in WIDE]:
                        job.result()
        if buckets is not None:
            self._refuse_others(name, modes, set(buckets))
        commit = {"version": version, "marker": marker, "staged": name, "modes": modes}
        if not self._create(f"commits/{version:012d}.json", json.dumps(commit) + "\n"):
            self._drop(name)
            raise CommitRefused(f"version {version} is taken")
        self._put_in_place(name, modes)
        return True

    def _refuse_others(self, staged: str, modes: dict[str, str], buckets: set[int]) -> None:
        for table in [table for table in modes if table in KEYED]:
            if others := self.written(f"staged/{staged}/{table}") - buckets:
                self._drop(staged)
                raise ValueError(f"{table} has rows of the buckets {sorted(others)}, which this run does not touch")

    def written(self, folder: str) -> set[int]:
        """The buckets that a table's folder has."""
        fs, path = self._path(folder)
        names = [file.getPath().getName() for file in fs.listStatus(path)]
        return {int(name.split("=")[1]) for name in names if name.startswith("bucket=")}

    def _put_in_place(self, staged: str, modes: dict[str, str]) -> None:
        """Put what was staged in place. Doing it again changes nothing."""

        def put(table: str) -> None:
            if modes[table] == "whole":
                self._move(f"staged/{staged}/{table}", table)
                return
            for folder in self._folders(f"staged/{staged}/{table}", len(_partitions(table))):
                own = folder.removeprefix(f"staged/{staged}/")
                if modes[table] == "added" and table in KEYED:
                    for file in self._names(folder, "part-"):
                        self._move(f"{folder}/{file}", f"{own}/{file}")
                else:
                    self._move(folder, own)

        with ThreadPoolExecutor(WRITERS) as pool:
            for job in [pool.submit(put, table) for table in modes]:
                job.result()
        self._drop(staged)

    def _names(self, folder: str, start: str = "") -> list[str]:
        fs, path = self._path(folder)
        names = [file.getPath().getName() for file in fs.listStatus(path)] if fs.exists(path) else []
        return [name for name in names if name.startswith(start)]

    def _folders(self, folder: str, depth: int) -> list[str]:
        """The partitions of a folder, so many levels below it."""
        if depth == 0:
            return [folder]
        return [leaf for name in self._names(folder) if "=" in name for leaf in self._folders(f"{folder}/{name}", depth - 1)]

    def _move(self, source: str, target: str) -> None:
        """Put a staged folder or file in the place of the target, unless it was moved before."""
        (fs, path), (_, to) = self._path(source), self._path(target)
        if not fs.exists(path):
            return
        fs.delete(to, True)
        fs.mkdirs(to.getParent())
        if not fs.rename(path, to):
            raise OSError(f"{path} cannot be moved to {to}")

    def _drop(self, staged: str) -> None:
        fs, path = self._path(f"staged/{staged}")
        fs.delete(path, True)

    def compact(self, *names: str) -> bool:
        """Write tables anew, so that what many runs appended is in few files."""
        return self.commit(self.version() + 1, self.load(*names))

    def seed(self) -> bool:
        """Version 0: the dictionaries."""
        return self.commit(0, dictionaries(self.spark))


def _partitions(name: str) -> tuple[str, ...]:
    return ("bucket",) if name in KEYED else APPENDED.get(name, ())


def _stored(name: str) -> StructType:
    """A table's schema with the columns that only name its folders."""
    kinds = {"bucket": IntegerType(), "version": LongType()}
    extra = [StructField(column, kinds[column]) for column in _partitions(name) if column in kinds]
    return StructType([*TABLES[name].fields, *extra])


def append_history(batch: DataFrame, path: str) -> None:
    """Raw history: append-only, one folder per capture date so that reads can prune."""
    dated = batch.withColumn("capture_date", F.col("captured_at").cast("date"))
    dated.write.mode("append").partitionBy("capture_date").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TABLES["raw_history"]).parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def open_run(spark: SparkSession, run_id: str, now) -> DataFrame:
    return spark.createDataFrame([(run_id, now, "RODANDO", None, None, None)], TABLES["run_log"])


def close_run(metrics: DataFrame, run_id: str, now, status: str, message: str) -> DataFrame:
    """Closing log row; ``metrics`` holds the columns read and new."""
    return metrics.select(
        F.lit(run_id).alias("run_id"), stamp(now).alias("logged_at"), F.lit(status).alias("status"),
        F.col("read").cast("long").alias("read"), F.col("new").cast("long").alias("new"),
        F.left(F.lit(message), F.lit(4000)).alias("message"),
    )


def run_summary(log: DataFrame) -> DataFrame:
    """One row per run: start, end, seconds and what the latest row says; at one time, a closing row is later."""
    last = F.max_by(F.struct("status", "read", "new", "message"), F.struct("logged_at", F.col("status") != "RODANDO"))
    return (
        log.groupBy("run_id")
        .agg(F.min("logged_at").alias("started"), F.max("logged_at").alias("latest"), last.alias("last"))
        .select(
            "run_id", "started",
            F.when(F.col("last.status") != "RODANDO", F.col("latest")).alias("ended"),
            F.when(F.col("last.status") != "RODANDO", F.timestamp_diff("SECOND", "started", "latest")).alias("seconds"),
            "last.status", "last.read", "last.new", "last.message",
        )
    )


def api_log_rows(sends: DataFrame, run_id: str, target: str, action: str, now) -> DataFrame:
    """Log rows for (process, status_code, payload, response)."""
    return sends.select(
        F.lit(run_id).alias("run_id"), "process", F.lit(target).alias("target"), F.lit(action).alias("action"),
        "status_code", F.left("payload", F.lit(4000)).alias("payload"), F.left("response", F.lit(4000)).alias("response"),
        stamp(now).alias("logged_at"),
    )


def notification_log_rows(notes: DataFrame, run_id: str, now) -> DataFrame:
    """Log rows for (process, status_code, payload, message)."""
    return notes.select(
        F.lit(run_id).alias("run_id"), "process", "status_code", "payload",
        F.left("message", F.lit(4000)).alias("message"), stamp(now).alias("logged_at"),
    )


def raw_latest_rows(records: DataFrame, now) -> DataFrame:
    return records.select(
        "id", F.left("claim", F.lit(50)).alias("claim"), F.col("raw_json").alias("json"),
        stamp(now).alias("captured_at"),
    )
