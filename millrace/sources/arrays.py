"""JSON files of any length, split at the ends of their records while they are read.

A file is read as text that ends at every `}`, so Spark cuts it into blocks like any text file and one file fills many
tasks. Whether a `}` ends a record depends on everything before it. A block is therefore summed up for both ways it can be
entered, inside a JSON string or outside of one: how it turns the quotes, and how it changes the depth of brackets. These
sums are few; put one after another they give each block the state it is really entered with, and a second reading finds the
record ends. Only records that lie across a block's edge are put together from their parts; no other text is moved for it.

What is found between record ends is then checked to be exactly the parts of one JSON array (or one object with nothing
around it), so a file with anything else in it is reported as broken, however the cuts fell.

The only limit left is that of a record: it is one value, and Spark's values end at 2 GB.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators import first_per_key
from ..session import scratch_dir

LONGEST_PART = 1 << 30  # text without any `}`; a file with more is broken
NUMBERED = 4096  # records that are numbered together
FANOUT = 1024  # digests that one digest of a file's tree covers

FILE = ["file_path"]
BLOCK = ["file_path", "block"]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: what was found is found once."""
    folder = scratch_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def literally(path: str) -> str:
    """A path as a pattern that names only itself."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def plain_path(encoded: Column) -> Column:
    """A path as file listings write it, out of the escaped form that text scans give."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^(\w+):///", "$1:/")


def _fragments(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Text up to each `}`: (file_path, block, n, value), ordered by block and n in each file."""
    reader = spark.read.option("lineSep", "}")
    reader = reader.option("mapreduce.input.linerecordreader.line.maxlength", str(LONGEST_PART))
    about = F.col("_metadata")
    return reader.text([literally(p) for p in paths]).select(
        plain_path(about["file_path"]).alias("file_path"),
        about["file_size"].alias("length"),
        about["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("n"),
        "value",
    )


def _marks(text: Column) -> Column:
    """Number of characters of a text that was reduced to the ones to count."""
    return F.char_length(text)


def _structure(rows: DataFrame) -> DataFrame:
    """`bare`: the text without escaped characters; `odd`: whether it turns inside and outside of strings round."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    rows = rows.withColumn("bare", bare)
    return rows.withColumn("odd", _marks(F.regexp_replace("bare", '[^"]', "")) % 2)


def _delta(inside: Column) -> Column:
    """Change of depth over a fragment and the `}` behind it, if it is entered inside a string or not."""
    opened = F.concat(F.when(inside == 1, '"').otherwise(""), F.col("bare"))
    outside = F.regexp_replace(F.regexp_replace(opened, '"[^"]*"', ""), r'"[^"]*\z', "")
    up = _marks(F.regexp_replace(outside, r"[^\[{]", ""))
    down = _marks(F.regexp_replace(outside, r"[^\]]", ""))
    return up - down - (1 - (inside + F.col("odd")) % 2)


def _blocks(fragments: DataFrame) -> DataFrame:
    """Each block with the state it is entered with, and what holds for its whole file."""
    ordered = Window.partitionBy(*BLOCK).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("odd").over(ordered), F.lit(0)) % 2
    rows = _structure(fragments).withColumn("turned", turned)
    # The head is the first character that is not white space, wherever it stands in the block.
    head = F.when(F.trim(F.col("value"), F.lit(" \t\r\n")) != "", F.substring(F.ltrim(F.col("value"), F.lit(" \t\r\n")), 1, 1))
    sums = rows.groupBy(*BLOCK, "length").agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        (F.sum("odd") % 2).alias("odd"),
        F.sum(_delta(F.col("turned"))).alias("from_outside"),
        F.sum(_delta(1 - F.col("turned"))).alias("from_inside"),
        F.max("n").alias("last"),
        F.min_by(head, F.when(head.isNotNull(), F.col("n"))).alias("head"),
    )
    sums = stored(sums, "json-blocks")
    before = Window.partitionBy(*FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*FILE)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    sums = sums.withColumn("inside", inside)
    change = F.when(F.col("inside") == 1, F.col("from_inside")).otherwise(F.col("from_outside"))
    total = F.sum("bytes").over(whole)
    return sums.select(
        *BLOCK,
        "length",
        "inside",
        F.coalesce(F.sum(change).over(before), F.lit(0)).alias("depth"),
        (total - F.col("length")).alias("beyond"),  # 0: the file ends with `}`; 1: something follows the last one
        F.when(F.col("block") == F.max("block").over(whole), F.col("last")).alias("last"),
        F.min_by("head", F.when(F.col("head").isNotNull(), F.col("block"))).over(whole).alias("head"),
    )


def _pieces(fragments: DataFrame, blocks: DataFrame) -> DataFrame:
    """Text between record ends, as far as it lies in one block: (file_path, block, piece, closed, text)."""
    rows = _structure(fragments.drop("length").join(blocks, BLOCK))
    ordered = Window.partitionBy(*BLOCK).orderBy("n")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("state", (F.col("inside") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2)
    rows = rows.withColumn("after", F.col("depth") + F.sum(_delta(F.col("state"))).over(ordered))
    # Behind the very last text of a file there may be no `}`.
    braced = ~((F.col("n") == F.coalesce("last", F.lit(-1))) & (F.col("beyond") == 1))
    outside = (F.col("state") + F.col("odd")) % 2 == 0
    level = F.when(F.col("head") == "[", 1).otherwise(0)
    rows = rows.withColumn("braced", braced).withColumn("ends", F.col("braced") & outside & (F.col("after") == level))
    rows = rows.withColumn("piece", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    texts = F.sort_array(F.collect_list(F.struct("n", F.concat("value", F.when(F.col("braced"), "}").otherwise("")).alias("text"))))
    return rows.groupBy(*BLOCK, "piece").agg(
        F.max("ends").alias("closed"), F.array_join(F.transform(texts, lambda t: t["text"]), "").alias("text")
    )


def _segments(pieces: DataFrame) -> DataFrame:
    """Pieces put together over block edges and numbered through each file: (file_path, number, closed, text)."""
    before = Window.partitionBy(*FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = pieces.groupBy(*BLOCK).agg(F.sum(F.col("closed").cast("bigint")).alias("closed"))
    first = first.select(
        *BLOCK,
        F.coalesce(F.sum("closed").over(before), F.lit(0)).alias("first"),
        (F.row_number().over(Window.partitionBy(*FILE).orderBy("block")) > 1).alias("later"),
    )
    rows = pieces.join(stored(first, "json-firsts"), BLOCK).withColumn("number", F.col("first") + F.col("piece"))
    edge = ~F.col("closed") | ((F.col("piece") == 0) & F.col("later"))
    whole = rows.where(~edge).select(*FILE, "number", "closed", "text")
    parts = F.sort_array(F.collect_list(F.struct("block", "text")))
    joined = rows.where(edge).groupBy(*FILE, "number").agg(
        F.max("closed").alias("closed"), F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text")
    )
    return whole.unionByName(joined)


def _body(array: Column) -> Column:
    """What stands between the separators of a segment, as an array; NULL where separators are not as they must be."""
    text = F.trim(F.col("text"), F.lit(" \t\r\n"))
    start = F.when(F.col("number") == 0, "[").otherwise(",")
    opened = F.when(text.startswith(start), F.substr(text, F.lit(2)))
    ending = F.when(text.endswith("]"), F.substr(text, F.lit(1), F.char_length(text) - 1))
    inner = F.when(ending.startswith(start), F.substr(ending, F.lit(2)))
    body = F.when(F.col("closed"), opened).otherwise(inner)
    return F.when(array, F.concat(F.lit("["), body, F.lit("]"))).otherwise(F.when(F.col("closed"), text))


def _records(segments: DataFrame, files: DataFrame, elements: Callable[[Column], Column]) -> DataFrame:
    """Segments with their records; `broken` ones are not part of any JSON document."""
    rows = segments.join(files, FILE)
    array = F.col("head") == "["
    text = F.trim(F.col("text"), F.lit(" \t\r\n"))
    # An end without further elements: "]", or white space behind an object.
    bare_end = ~F.col("closed") & F.when(array, (text == "]") & (F.col("number") > 0)).otherwise(text == "")
    empty = ~F.col("closed") & array & (F.col("number") == 0) & text.rlike(r"^\[\s*\]$")
    rows = rows.withColumn("body", F.try_validate_utf8(_body(array))).withColumn("idle", bare_end | empty)
    found = F.when(F.col("idle"), F.array().cast("array<string>")).otherwise(elements(F.col("body")))
    rows = rows.select(*FILE, "number", "closed", "idle", F.sha2("text", 256).alias("digest"), found.alias("records"))
    fault = F.col("records").isNull() | F.exists("records", lambda r: r.isNull()) | (~F.col("idle") & (F.size("records") == 0))
    return rows.withColumn("broken", F.coalesce(fault, F.lit(True)))


def _tree_digest(segments: DataFrame) -> DataFrame:
    """One digest of each file: of the digests of its segments in order, `FANOUT` at a time."""
    rows = segments.select(*FILE, "number", "digest")
    for _ in range(4):  # FANOUT^4 segments
        parts = F.sort_array(F.collect_list(F.struct("number", "digest")))
        text = F.array_join(F.transform(parts, lambda p: p["digest"]), "")
        rows = rows.groupBy(*FILE, F.floor(F.col("number") / FANOUT).alias("number")).agg(F.sha2(text, 256).alias("digest"))
    return rows.select(*FILE, F.col("digest").alias("file_hash"))


def _numbered(rows: DataFrame) -> DataFrame:
    """`pos`: number of each record in its file, counted from 0 in the order of the file."""
    rows = rows.withColumn("shelf", F.floor(F.col("number") / NUMBERED))
    counts = rows.groupBy(*FILE, "shelf").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*FILE).orderBy("shelf").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*FILE, "shelf", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    shelf = Window.partitionBy(*FILE, "shelf").orderBy("number", "k")
    rows = rows.join(counts, [*FILE, "shelf"])
    return rows.withColumn("pos", F.col("skip") + F.row_number().over(shelf) - 1)


def split(
    spark: SparkSession, paths: Sequence[str], elements: Callable[[Column], Column]
) -> tuple[DataFrame, DataFrame]:
    """The files and their records.

    Files: (file_path, length, file_hash, broken, found), with the number of records found. Records: (file_path, pos,
    payload), without exact repeats inside a file; broken files have none. `elements` reads the text of one array or object.
    """
    fragments = _fragments(spark, paths)
    blocks = stored(_blocks(fragments), "json-entries")
    pieces = stored(_pieces(fragments, blocks), "json-pieces")
    about = blocks.groupBy(*FILE).agg(F.max("length").alias("length"), F.max("beyond").alias("beyond"), F.max("head").alias("head"))
    parsed = stored(_records(_segments(pieces), about.select(*FILE, "head"), elements), "json-records")
    ends = parsed.groupBy(*FILE).agg(
        F.max("broken").alias("fault"),
        F.sum(F.size("records")).alias("found"),
        F.count_if(~F.col("closed")).alias("open"),
        F.count_if(F.col("closed")).alias("shut"),
    )
    # An array has one end behind its last record; an object is one record.
    shape = F.when(F.col("head") == "[", F.col("open") == 1).otherwise((F.col("head") == "{") & (F.col("shut") == 1))
    sound = ~F.col("fault") & shape & F.col("beyond").isin(0, 1)
    files = about.join(ends, FILE).join(_tree_digest(parsed), FILE)
    files = files.select(
        *FILE, "length", "file_hash", (~F.coalesce(sound, F.lit(False))).alias("broken"), F.col("found").cast("bigint").alias("found")
    )
    files = stored(files, "json-files")
    good = files.where(~F.col("broken")).select(*FILE)
    rows = parsed.join(good, FILE, "left_semi").select(*FILE, "number", F.posexplode("records").alias("k", "payload"))
    rows = first_per_key(rows, [*FILE, "payload"], [F.col("number"), F.col("k")])
    return files, _numbered(rows).select(*FILE, "pos", "payload")
