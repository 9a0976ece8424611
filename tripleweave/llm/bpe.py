"""Byte-level BPE of whole texts; long texts are encoded in pieces and put together exactly."""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import once_per_worker, partitions_of

RESULT = "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"
PIECE = "row long, doc_id long, piece long, glued boolean, text string"
#: Tokens at either end of a window that must come out unchanged.
AGREE = 4


def vocabulary(json_path: str, ranks_path: str):
    """Encoder of a vocabulary given as ranks, with the special tokens of its tokenizer file."""

    def make():
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(json_path, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        # fixed value: the published pattern of this family of vocabularies
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    return once_per_worker(f"bpe {ranks_path}", make)


def encode(encoder, text: str) -> list[int]:
    return encoder.encode(text, allowed_special="all", disallowed_special=())


def pieces(text: str, size: int) -> Iterator[tuple[bool, str]]:
    """Consecutive pieces of about ``size`` characters, and whether a piece must be glued to the one before.

    A blank, tab or line end behind anything else than white space always
    begins a new pre-token and stands in no special token, so a cut there
    needs no glue. Where a stretch of
    ``size`` characters has no such place, it is cut anyway.
    """
    start, glued = 0, False
    while start < len(text):
        stop = min(len(text), start + size)
        clean = stop == len(text)
        if not clean:
            at = stop
            while at > start + 1 and not (text[at] in " \t\r\n" and not text[at - 1].isspace()):
                at -= 1
            clean = at > start + 1
            stop = at if clean else stop
        yield glued, text[start:stop]
        start, glued = stop, not clean


def joined(encoder, left: list[int], right: list[int]) -> list[int]:
    """Tokens of two neighbouring texts together, from the tokens of each.

    A window around the join is encoded again and doubled until its first and
    last tokens come out as they were; beyond them nothing can change. If the
    window reaches both ends, all has been encoded again.
    """
    k = 4 * AGREE
    while True:
        a, b = left[-k:], right[:k]
        whole_left, whole_right = k >= len(left), k >= len(right)
        head, tail = encoder.decode_bytes(a), encoder.decode_bytes(b)
        rest = encoder.decode_single_token_bytes(right[k]) if not whole_right else b""
        cut = (head[0] & 0xC0) == 0x80 or bool(rest) and (rest[0] & 0xC0) == 0x80  # inside a character
        if not cut or whole_left and whole_right:
            w = encode(encoder, (head + tail).decode("utf-8", "replace"))
            same_left = whole_left or w[:AGREE] == a[:AGREE]
            same_right = whole_right or w[-AGREE:] == b[-AGREE:]
            if same_left and same_right:
                return left[: len(left) - len(a)] + w + right[len(b) :]
        k *= 2


def in_halves(encoder, parts: list[list[int]], glued: list[bool]) -> list[int]:
    """Join the pieces as a balanced tree; ``glued[i]`` tells whether piece i goes on where piece i-1 stopped."""
    while len(parts) > 1:
        some, marks = [], []
        for i in range(0, len(parts), 2):
            pair = parts[i : i + 2]
            if len(pair) == 2 and glued[i + 1] and pair[0] and pair[1]:
                some.append(joined(encoder, *pair))
            else:
                some.append([x for p in pair for x in p])
            marks.append(glued[i])
        parts, glued = some, marks
    return parts[0] if parts else []


def row_of(encoder, doc_id, ids: list[int]):
    raw = np.asarray(ids, "<u4").tobytes()
    decoded = encoder.decode(ids)
    return doc_id, len(ids), raw, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string()]
    names = ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def encode_rows(json_path: str, ranks_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(json_path, ranks_path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                yield batch_of([row_of(encoder, d, encode(encoder, t)) for d, t in zip(part[0].to_pylist(), part[1].to_pylist())])

    return run


def cut_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(batch[i].to_pylist() for i in range(3))):
                for n, (glued, piece) in enumerate(pieces(text, size)):
                    yield pa.RecordBatch.from_pylist(
                        [{"row": row, "doc_id": doc_id, "piece": n, "glued": glued, "text": piece}],
                        schema=pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("glued", pa.bool_()), ("text", pa.string())]),
                    )

    return run


def encode_pieces(json_path: str, ranks_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(json_path, ranks_path)
        for batch in batches:
            ids = [np.asarray(encode(encoder, t), "<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield batch.drop_columns(["text"]).append_column("ids", pa.array(ids, pa.binary()))

    return run


def join_pieces(json_path: str, ranks_path: str):
    """Rows come sorted by row and piece; one text is held at a time, which its result row needs anyway."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(json_path, ranks_path)
        row, doc_id, parts, glued = None, None, [], []
        for batch in batches:
            for r, d, g, ids in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "glued", "ids"))):
                if r != row and row is not None:
                    yield batch_of([row_of(encoder, doc_id, in_halves(encoder, parts, glued))])
                    parts, glued = [], []
                row, doc_id = r, d
                parts.append(np.frombuffer(ids, "<u4").tolist())
                glued.append(g)
        if row is not None:
            yield batch_of([row_of(encoder, doc_id, in_halves(encoder, parts, glued))])

    return run


def bpe(docs: DataFrame, json_path: str, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", piece: int = 32_768) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (unsigned 32-bit, little-endian), ids_sha256, decoded_sha256.

    Ids are those of the whole text with the file's special tokens recognised
    and none added; null counts as empty (no tokens). Repeated rows each get a
    row, an empty table none, further columns are not read. The files must
    stand at the same place on all executors.

    Texts of up to ``piece`` characters are encoded where they are read. Longer
    ones are cut, their pieces encoded in parallel by other tasks, and the
    token lists joined as a tree: windows around each join are encoded again
    and grow until both sides agree. Only pieces and ids of long texts are shuffled.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    long = F.length("text") > piece
    short = rows.where(~long).mapInArrow(encode_rows(json_path, ranks_path), RESULT)
    n = partitions_of(docs.sparkSession)
    parts = rows.where(long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(cut_rows(piece), PIECE)
    encoded = parts.repartition(n, "row", "piece").mapInArrow(
        encode_pieces(json_path, ranks_path), "row long, doc_id long, piece long, glued boolean, ids binary"
    )
    whole = encoded.repartition(n, "row").sortWithinPartitions("row", "piece").mapInArrow(join_pieces(json_path, ranks_path), RESULT)
    return short.unionByName(whole)
