"""Landing trees made from the benchmark tables: JSON files for the readers, written or packed by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_dir
from ..sources import files
from .adapters import Model

PER_FILE = 2000  # records of one file, at any size of the table
CHUNK = 500  # events of one packed file


def write_arrays(rows: DataFrame, record: Column, place: Column, name: str) -> str:
    """Write rows as JSON array files of at most `PER_FILE` records below a new folder; `place` numbers the rows."""
    folder = f"{scratch_dir(rows.sparkSession, 'landing')}/{name}.json"
    shelf = F.floor(place / PER_FILE)
    rows = rows.select(shelf.alias("shelf"), place.alias("place"), record.alias("record"))
    inside = Window.partitionBy("shelf").orderBy("place")
    first = F.row_number().over(inside) == 1
    last = F.lead("place").over(inside).isNull()
    text = F.concat(F.when(first, "[").otherwise(","), "record", F.when(last, "]").otherwise(""))
    rows.select("shelf", text.alias("value")).write.partitionBy("shelf").text(folder)
    return folder


def packed_events(m: Model) -> DataFrame:
    """The events table as the files of a landing tree (path, content), bounded ones.

    Every fifth event stands twice in its file. Some files are cut off, some lie in a folder without a date, some
    hold nothing.
    """
    record = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"kind":"'), F.col("event_type"), F.lit('","user_id":'),
        F.col("user_id").cast("string"), F.lit("}"),
    )
    twice = F.when(F.col("event_id") % 5 == 0, F.concat(record, F.lit(", "), record)).otherwise(record)
    rows = m.table("events").select(F.floor(F.col("event_id") / CHUNK).alias("chunk"), "event_type", "event_id", twice.alias("record"))
    ordered = F.sort_array(F.collect_list(F.struct("event_id", "record")))
    packed = rows.groupBy("chunk", "event_type").agg(F.array_join(F.transform(ordered, lambda r: r["record"]), ",").alias("body"))
    folder = F.when(F.col("chunk") % 13 == 5, "2026-13-45").otherwise(F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("chunk") % 300).cast("int")), "yyyy-MM-dd"))
    path = F.concat(F.lit("file:/landing/"), F.col("chunk").cast("string"), F.lit("/erp/"), folder, F.lit("/"), F.col("event_type"), F.lit(".json"))
    body = F.when(F.col("chunk") % 11 == 3, "").otherwise(F.col("body"))
    end = F.when(F.col("chunk") % 7 == 2, "").otherwise("]")
    return packed.select(path.alias("path"), F.concat(F.lit("["), body, end).cast("binary").alias("content"))


# The same files in SQL.
FILES_SQL = f"""rows AS (SELECT event_id // {CHUNK} AS chunk, event_type, event_id,
 concat('{{"event_id":', event_id, ',"kind":"', event_type, '","user_id":', user_id, '}}') AS record FROM events),
packed AS (SELECT chunk, event_type, string_agg(CASE WHEN event_id % 5 = 0 THEN concat(record, ', ', record) ELSE record END, ',' ORDER BY event_id) AS body, count(*) AS n
 FROM rows GROUP BY 1, 2),
files AS (SELECT chunk, event_type, n, CASE WHEN chunk % 13 <> 5 THEN DATE '2026-01-01' + cast(chunk % 300 AS int) END AS day,
 concat('[', CASE WHEN chunk % 11 = 3 THEN '' ELSE body END, CASE WHEN chunk % 7 = 2 THEN '' ELSE ']' END) AS content FROM packed),
named AS (SELECT *, concat('file:/landing/', chunk, '/erp/', coalesce(strftime(day, '%Y-%m-%d'), '2026-13-45'), '/', event_type, '.json') AS file_path, sha256(content) AS file_hash,
 CASE WHEN day IS NULL THEN 'no event date' WHEN chunk % 7 = 2 THEN 'unreadable JSON' WHEN chunk % 11 = 3 THEN 'empty file' END AS reason FROM files)"""


def parsed_files(m: Model) -> DataFrame:
    return files.parse(packed_events(m))
