"""Bronze: JSON event files to raw events, once per file content.

Layout of the input: <root>/<adm|erp|forecast|tms>/<YYYY-MM-DD|YYYY-MM|demand_signals>/<name>.json,
each file one JSON object or an array of them.

Which files are new is told from the listing alone: path, length and time against the ledger. Contents are
read of new files, and of files whose length or time is another one; those are hashed first, since a file
that was only touched is not news. `verify` hashes everything.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import payload as p
from ..operators import changed_only, first_per_key
from . import arrays
from .store import Store

RAW, LEDGER = "raw_events", "ingested_files"
RAW_SCHEMA = (
    "file_path string, file_hash string, source_system string, raw_event_date date, reason string, pos bigint,"
    " payload string, raw_event_key string, ingest_batch bigint, status string, event_type string"
)

# Source folders, folder names, and the date in the name of a demand signal.
SOURCES = "adm|erp|forecast|tms"
FOLDERS = r"\d{4}-\d{2}(-\d{2})?|demand_signals"
SIGNAL_DATE = r"^SIG-(\d{8})-"

# Files up to this length are rows; longer ones are split at record ends while they are read.
LONGEST_ROW = 64 << 20
STATUSES = ("event", "empty", "quarantine")
# How a file is recognised in a listing.
STAMP = ["path", "modified", "length"]


def _reader(spark: SparkSession, streaming: bool):
    reader = spark.readStream if streaming else spark.read
    return reader.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")


def discover(spark: SparkSession, root: str, streaming: bool = False) -> DataFrame:
    """All event files below `root`; other folders and depths are left out."""
    reader = _reader(spark, streaming)
    if streaming:
        reader = reader.schema("path string, modificationTime timestamp, length bigint, content binary")
    base = qualified(spark, root)
    wanted = rf"^\Q{base}\E/({SOURCES})/({FOLDERS})/[^/]+\.json$"
    return reader.load(base).where(F.col("path").rlike(wanted))


def qualified(spark: SparkSession, root: str) -> str:
    """The root as Spark itself writes it in file paths: with scheme and host, without `.` or doubled slashes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        raise FileNotFoundError(f"no such folder: {root}")
    return system.resolvePath(path).toString().rstrip("/")


def listing(files: DataFrame) -> DataFrame:
    """Path, time and length of the files; contents are not read for it."""
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def _from_path(path: Column) -> dict[str, Column]:
    """What the path of a file says about its events."""
    parts = F.split(path, "/")
    folder, name = F.element_at(parts, -2), F.element_at(parts, -1)
    signals = folder == "demand_signals"
    signal_date = F.try_to_date(F.regexp_extract(name, SIGNAL_DATE, 1), "yyyyMMdd")
    folder_date = F.coalesce(F.try_to_date(folder, "yyyy-MM-dd"), F.try_to_date(folder, "yyyy-MM"))
    return {
        "source_system": F.element_at(parts, -3),
        "event_type": F.when(signals, "demand_signals").otherwise(F.regexp_replace(name, r"\.json$", "")),
        "raw_event_date": F.when(signals, signal_date).otherwise(folder_date),
    }


def _reason(broken: Column, found: Column) -> Column:
    """Why a file gives no events."""
    return (
        F.when(F.col("raw_event_date").isNull(), "no event date")
        .when(broken, "unreadable JSON")
        .when(found == 0, "empty file")
    )


def _keyed(rows: DataFrame) -> DataFrame:
    key = F.sha2(F.concat_ws("|", "file_path", "file_hash", F.col("pos").cast("string")), 256)
    status = F.when(F.col("reason").isNull(), "event").when(F.col("reason") == "empty file", "empty")
    rows = rows.withColumns({"raw_event_key": key, "status": F.coalesce(status, F.lit("quarantine"))})
    return rows.select(
        "file_path", "file_hash", "source_system", "event_type", "raw_event_date", "reason", F.col("pos").cast("bigint").alias("pos"),
        "payload", "raw_event_key", "status",
    )


def elements(body: Column) -> Column:
    """Canonical text of each record; NULL (or a NULL inside) where the file cannot be read.

    JSON readers stop at the end of the first document. The body is read as the only element of an
    array, so that anything after the document makes it unreadable instead of being lost. Records
    become variants one by one, so a file may be far longer than one variant.
    """
    head = F.substring(F.ltrim(body, F.lit(" \t\r\n")), 1, 1)
    wrapped = F.concat(F.lit("["), body, F.lit("]"))
    nested = F.from_json(wrapped, "array<array<variant>>")
    single = F.from_json(wrapped, "array<variant>")
    return F.when(
        (head == "[") & (F.size(nested) == 1), F.transform(F.get(nested, F.lit(0)), lambda v: F.to_json(v))
    ).when((head == "{") & (F.size(single) == 1), F.array(p.canonical(F.get(single, F.lit(0)))))


def parse(files: DataFrame) -> DataFrame:
    """Records of files that are rows, without exact repeats inside a file.

    A file that cannot be used gives one row with a `reason` instead. Repeats are removed as an
    array operation inside the file's own row, so nothing is shuffled for it.
    """
    read = files.select(
        F.col("path").alias("file_path"),
        F.sha2("content", 256).alias("file_hash"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("body"),
    )
    read = read.withColumns(_from_path(F.col("file_path"))).withColumn("records", elements(F.col("body"))).drop("body")
    broken = F.coalesce(F.exists("records", lambda r: r.isNull()), F.lit(True))
    read = read.withColumn("reason", _reason(broken, F.size("records")))
    records = F.when(F.col("reason").isNull(), F.array_distinct("records"))
    return _keyed(read.select("*", F.posexplode_outer(records).alias("pos", "payload")))


def parse_split(spark: SparkSession, long: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """The same rows for files of any length. Files whose (path, hash) is `known` are left out."""
    found, records = arrays.split(spark, long, elements)
    wanted = spark.createDataFrame([(path,) for path in long], "file_path string")
    files = wanted.join(found, "file_path", "left")
    if known is not None:
        files = changed_only(files, known, ["file_path", "file_hash"])
    files = files.withColumns(_from_path(F.col("file_path")))
    # A file that gave nothing at all has a part no value can hold.
    files = files.withColumn("reason", _reason(F.coalesce("broken", F.lit(True)), F.col("found")))
    head = ["file_path", "file_hash", "source_system", "event_type", "raw_event_date", "reason"]
    good = files.where("reason is null").select(*head).join(records, "file_path")
    bad = files.where("reason is not null").select(*head, F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("payload"))
    return _keyed(good.unionByName(bad))


def ledger(store: Store) -> DataFrame | None:
    """Last ingested content hash and row count per file."""
    rows = store.rows(LEDGER)
    if rows is None:
        return None
    return _newest(rows)


def _newest(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, ["file_path"], [F.col("ingest_batch").desc()])


def compact(store: Store, grace_seconds: float | None = None) -> int:
    """Fold the batches of raw events and of the ledger; with `grace_seconds` also drop what was folded before then.

    The ledger keeps one row of each file in a folder; raw events stay as they are. Returns the folders written.
    """
    written = store.fold(RAW, ["status", "event_type"], RAW_SCHEMA)
    written += store.fold(LEDGER, merge=_newest)
    if grace_seconds is not None:
        for table in (RAW, LEDGER):
            store.expire(table, grace_seconds)
    return written


def candidates(store: Store, listed: DataFrame, verify: bool = False) -> DataFrame:
    """Files of a listing that the ledger does not know as they stand there; with `verify`, all of them."""
    known = ledger(store)
    if known is None or verify or "modified" not in known.columns:
        return listed
    return changed_only(listed, known.withColumnRenamed("file_path", "path"), STAMP)


def paths(files: DataFrame) -> list[str]:
    """Paths to read. Paths only: the driver's own listing of the tree holds more of them."""
    return sorted(files.agg(F.collect_list("path")).first()[0])


def _content(spark: SparkSession, wanted: Sequence[str]) -> DataFrame:
    reader = spark.read.format("binaryFile")
    return reader.load([arrays.literally(path) for path in wanted])


def changed_files(store: Store, listed: DataFrame, verify: bool = False) -> tuple[DataFrame, DataFrame]:
    """Files to take in, and files that are only touched: both as (path, modified, length), written down.

    Of the candidates, those that the ledger has under another time or length are hashed; nothing else is read.
    """
    found = arrays.stored(candidates(store, listed, verify), "listed-files")
    known = ledger(store)
    if known is None:
        return found, found.where("false")
    short = found.where(F.col("length") <= LONGEST_ROW)
    rewritten = paths(short.join(known.select(F.col("file_path").alias("path")), "path", "left_semi"))
    if not rewritten:
        return found, found.where("false")
    prints = _content(store.spark, rewritten).select("path", F.sha2("content", 256).alias("file_hash"))
    same = prints.join(known.select(F.col("file_path").alias("path"), "file_hash"), ["path", "file_hash"], "left_semi")
    touched = arrays.stored(found.join(same.select("path"), "path", "left_semi"), "touched-files")
    return found.join(touched.select("path"), "path", "left_anti"), touched


def write_batch(
    store: Store, files: DataFrame, touched: DataFrame | None = None, note: Callable[[str, int], None] | None = None
) -> int:
    """Parse and append changed files as one batch; the ledger is written last.

    `files` is a listing; `note` is told the rows of each status. Returns the batch number. If the job fails before the ledger is complete, the next
    run takes the same number again and overwrites what this one left.
    """
    spark, batch = store.spark, store.last_batch(LEDGER) + 1
    number = F.lit(batch).cast("bigint")
    short, long = (paths(files.where(rule)) for rule in (F.col("length") <= LONGEST_ROW, F.col("length") > LONGEST_ROW))
    known = ledger(store)
    parts = [parse(_content(spark, short))] if short else []
    parts += [parse_split(spark, long, known)] if long else []
    if not parts:
        parts = [spark.createDataFrame([], RAW_SCHEMA).drop("ingest_batch")]
    rows = reduce(DataFrame.unionByName, parts).withColumn("ingest_batch", number)
    seen = Observation("bronze")
    rows = rows.observe(seen, *(F.count_if(F.col("status") == status).alias(status) for status in STATUSES))
    # Even out file sizes: many small sources per task on one side, one dominant source on the other.
    store.add_batch(RAW, rows.hint("rebalance", "status", "event_type"), batch, ["status", "event_type"])
    for status, n in seen.get.items() if note is not None else ():
        note(status, n)
    written = store.batches(RAW, after=batch - 1, upto=batch, schema=RAW_SCHEMA)
    counts = written.where("status = 'event'").groupBy("file_path", "file_hash").agg(F.count(F.lit(1)).alias("row_count"))
    stamps = files.withColumnRenamed("path", "file_path")
    counts = counts.join(stamps, "file_path")
    if known is not None:
        # Known content under a new time: noted, so that it is not read again.
        again = known.drop("modified", "length", "ingest_batch", "ingested_at")
        seen = touched if touched is not None else files.where("false")
        seen = seen.unionByName(files.where(F.col("length") > LONGEST_ROW))
        seen = seen.withColumnRenamed("path", "file_path").join(counts.select("file_path"), "file_path", "left_anti")
        broken = written.where("status <> 'event'").select("file_path")
        counts = counts.unionByName(again.join(seen.join(broken, "file_path", "left_anti"), "file_path"))
    counts = counts.withColumns({"ingest_batch": number, "ingested_at": F.current_timestamp()})
    store.add_batch(LEDGER, counts, batch)
    return batch


def ingest(store: Store, root: str, verify: bool = False, note: Callable[[str, int], None] | None = None) -> int:
    """Ingest every new or changed file below `root`; `verify` trusts no listing and hashes every file."""
    return write_batch(store, *changed_files(store, listing(discover(store.spark, root)), verify), note)


def raw_events(store: Store, after: int = 0) -> DataFrame | None:
    """Events of the batches after `after` that the ledger has confirmed."""
    rows = store.batches(RAW, after=after, upto=store.last_batch(LEDGER), schema=RAW_SCHEMA)
    return None if rows is None else rows.where("status = 'event'").drop("status", "reason")


def quarantine(store: Store) -> DataFrame | None:
    """Files that could not be used, with the reason; they are retried while they stay broken."""
    rows = store.batches(RAW, upto=store.last_batch(LEDGER), schema=RAW_SCHEMA)
    if rows is None:
        return None
    return rows.where("status = 'quarantine'").select("file_path", "file_hash", "reason", "ingest_batch")
