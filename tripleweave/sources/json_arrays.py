"""JSON files that are one array of records, read by as many tasks as they have blocks and written one array per task.

A reader of whole files gives each file to one task. Here the text source cuts
a file at every closing brace, in blocks that tasks read apart. Whether a
brace closes a record depends on everything before it: is it inside a string,
and how many braces are open. So a first pass tells, per block, how a block
changes both, for either way it may begin; a running sum over the blocks of a
file gives each block its true beginning; and a second pass cuts the records.
Pieces of a record that lies in several blocks are put together last.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import stage

#: States of blocks are sent to every task (some 40 bytes each) up to this number of blocks; beyond it they are joined by a shuffle.
BLOCKS = 500_000
ESCAPE = re.compile(rb"\\.", re.S)
STRING = re.compile(rb'"[^"]*(?:"|\Z)')
#: A string, or the brace that begins a record.
TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*(?:"|\Z)|\{', re.S)

SUMMARY = "file long, block long, turns boolean, outside long, inside long"
FRAGMENT = "file long, block long, at long, ends boolean, text string"


def outside_strings(plain: bytes, inside: bool) -> tuple[bytes, bool]:
    """What of a piece without escapes stands outside strings, and whether its end is inside one."""
    if inside:
        plain = b'"' + plain
    return STRING.sub(b"", plain), plain.count(b'"') % 2 == 1


def first_record(piece: bytes, inside: bool) -> int:
    """Where the first record of a piece between records begins, or -1."""
    for m in TOKEN.finditer(b'"' + piece if inside else piece):
        if m[0] == b"{":
            return m.start() - inside
    return -1


def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: whether it turns the inside of strings into the outside, and the braces left open if it begins outside or inside one."""
    state: dict[tuple, list] = {}
    for batch in batches:
        pieces = batch.column("value").cast(pa.binary()).to_pylist()
        for file, block, piece in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), pieces):
            s, plain = state.setdefault((file, block), [False, 0, 0]), ESCAPE.sub(b"", piece)
            for k, begins in ((1, False), (2, True)):
                outside, ends = outside_strings(plain, s[0] != begins)
                s[k] += outside.count(b"{") - (not ends)
            s[0] ^= plain.count(b'"') % 2 == 1
    rows = [{"file": f, "block": b, "turns": t, "outside": o, "inside": i} for (f, b), (t, o, i) in state.items()]
    kinds = [("file", pa.int64()), ("block", pa.int64()), ("turns", pa.bool_()), ("outside", pa.int64()), ("inside", pa.int64())]
    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block; the first and the last piece may be part of one that reaches over its border.

    ``at`` numbers the rows of a block; ``ends`` says whether the record ends with this row.
    """
    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("at", pa.int64()), ("ends", pa.bool_()), ("text", pa.binary())])
    here, inside, depth, at, held = None, False, 0, 0, []
    out: list[dict] = []

    def row(ends: bool) -> None:
        nonlocal at, held
        out.append({"file": here[0], "block": here[1], "at": at, "ends": ends, "text": b"".join(held)})
        at, held = at + 1, []

    for batch in batches:
        pieces = batch.column("value").cast(pa.binary()).to_pylist()
        states = zip(*(batch.column(c).to_pylist() for c in ("file", "block", "in_string", "depth")))
        for (file, block, starts_inside, starts_depth), piece in zip(states, pieces):
            if (file, block) != here:
                if held:
                    row(False)
                here, inside, depth, at = (file, block), starts_inside, starts_depth, 0
            outside, ends_inside = outside_strings(ESCAPE.sub(b"", piece), inside)
            if depth == 0:  # between records: brackets, commas, white space
                begin = first_record(piece, inside)
                if begin < 0:
                    inside = ends_inside
                    continue
                piece = piece[begin:]
            held += [piece, b"}"]
            inside = ends_inside
            depth += outside.count(b"{")
            if not inside:
                depth -= 1
                if depth == 0:
                    row(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema).cast(pa.schema([*list(schema)[:4], ("text", pa.string())]))
            out = []
    if held:
        row(False)
    yield pa.RecordBatch.from_pylist(out, schema=schema).cast(pa.schema([*list(schema)[:4], ("text", pa.string())]))


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """The JSON text of each record: file (a hash of its path), block (where it begins), at, text; in file order by these three.

    Records are the outermost objects, in an array, one after the other, or alone;
    what stands between them is passed over. Files must be UTF-8 and well-formed.
    """
    pieces = spark.read.text(path, lineSep="}").select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), "value"
    )
    blocks = pieces.mapInArrow(summarise, SUMMARY)
    # a block may be dealt to a task in several parts of a batch, never to two tasks
    blocks = blocks.groupBy("file", "block").agg(*[F.first(c).alias(c) for c in ("turns", "outside", "inside")])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.withColumn("in_string", F.coalesce(F.sum(F.col("turns").cast("int")).over(before) % 2 == 1, F.lit(False)))
    begun = begun.withColumn("_open", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside")))
    begun = begun.withColumn("depth", F.coalesce(F.sum("_open").over(before), F.lit(0).cast("long")))
    begun = stage(begun.select("file", "block", "in_string", "depth"), "json_blocks")
    if begun.count() <= BLOCKS:  # the pieces stay as they are read
        placed = pieces.join(F.broadcast(begun), ["file", "block"])
    else:
        placed = pieces.join(begun, ["file", "block"]).sortWithinPartitions("file", "block", "seq")
    fragments = placed.select("file", "block", "in_string", "depth", "value").mapInArrow(cut, FRAGMENT)
    whole = fragments.where(F.col("ends") & (F.col("at") > 0)).select("file", "block", "at", "text")
    # the rest are at most two rows of a block; a record goes on until a row that ends one
    rest = fragments.where(~F.col("ends") | (F.col("at") == 0))
    order = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, -1)
    numbered = rest.withColumn("record", F.coalesce(F.sum(F.col("ends").cast("int")).over(order), F.lit(0)))
    parts = numbered.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "at", "text"))).alias("parts"), F.max("ends").alias("done"))
    joined = parts.where("done").select(
        "file", F.get("parts", F.lit(0))["block"].alias("block"), F.get("parts", F.lit(0))["at"].alias("at"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
    )
    return whole.unionByName(joined)


def read_json_array(spark: SparkSession, path: str, schema: str, keep_place: bool = False) -> DataFrame:
    """Records of JSON array files, each file read by as many tasks as it has blocks of spark.sql.files.maxPartitionBytes.

    The same rows as a reader with ``multiLine`` gives for well-formed files
    of objects, in no order; ``keep_place`` adds ``file``, ``block`` and
    ``at``, which sort the records of a file as they stand. A field that does not
    fit its type is null.
    """
    texts = record_texts(spark, path)
    place = ["file", "block", "at"] if keep_place else []
    return texts.select(*place, F.from_json("text", schema).alias("_record")).select(*place, "_record.*")


def write_json_texts(texts: DataFrame, path: str) -> None:
    """Overwrite ``path`` with one file per task, each an indented array of the JSON texts in the only column of its rows."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        held = None  # a record waits for the next one, to know whether a comma follows
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                if held is not None:
                    out.append(held + ",")
                held = "  " + json.dumps(json.loads(text), ensure_ascii=False, indent=2).replace("\n", "\n  ")
            if out:
                yield pa.RecordBatch.from_pydict({"value": out})
        yield pa.RecordBatch.from_pydict({"value": [held, "]"] if held is not None else ["]"]})

    texts.mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with one file per task, each an indented array of its rows; NULL fields are kept."""
    write_json_texts(df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")), path)
