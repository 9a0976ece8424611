"""Token counts of whole texts; huge ones are encoded in overlapping chunks that are spliced where both sides provably agree."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import once_per_worker, partitions_of

RESULT = "doc_id long, n_bytes long, n_tokens long, n_chunks long, n_widened long"
CUT = "row long, doc_id long, n_bytes long, chunk long, base long, last boolean, text string"
#: A chunk after encoding; positions are code points of the whole text, counts are the chunk's tokens before them.
CODED = (
    "row long, doc_id long, n_bytes long, chunk long, base long, stop long, last boolean, n_tokens long, "
    "heads array<long>, head_counts array<long>, tails array<long>, tail_counts array<long>, text string"
)
#: Token counts of pieces between blanks are remembered up to this length of a piece and this number of them.
SHORT_PIECE, REMEMBERED = 40, 500_000


#: A word of letters that composition leaves as they are and lower case maps to one letter, with punctuation behind it.
WORD = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]+)([!-/:-@\[-`{-~]*)")
#: Fixed value: the pre-tokens of the word vocabulary; of such a word its letters are one, and the punctuation another.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Tokens:
    """A tokenizer file with what the splicing must know about it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: A boundary this far from a chunk's end has been passed with all it depends on in sight.
        self.margin = max([3, *map(len, special)]) + 1
        #: The first piece between blanks may be taken alone, if no special string holds a blank.
        self.by_piece = not any(" " in s or "\n" in s for s in special) and self.blank_is_lost()
        self.counts: dict[str, int] = {}
        self.parts: dict[str, int] = {}
        self.by_word = self.by_piece and self.words_are_pre_tokens()

    def words_are_pre_tokens(self) -> bool:
        """Whether the file normalises and splits just so that the letters of ``WORD``, in lower case, go to its model as they are."""
        from tokenizers import pre_tokenizers

        parts = json.loads(self.tokenizer.to_str())
        steps = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        split, *bytes_ = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)
        return (
            steps == ["NFC", "Replace", "Lowercase"] and [b["type"] for b in bytes_] == ["ByteLevel"] and not bytes_[0]["use_regex"]
            and split.get("pattern") == {"Regex": WORD_PATTERN} and split["behavior"] == "Removed" and split["invert"]
        )

    def blank_is_lost(self) -> bool:
        """Whether blanks only separate: they give no token and change none behind them."""
        one, two = (self.tokenizer.encode(s, add_special_tokens=False).ids for s in ("ab cd", " ab\n cd  "))
        return one == two

    def encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def part(self, part: str) -> int:
        """Tokens of one pre-token in lower case."""
        n = self.parts.get(part)
        if n is None:
            n = len(self.tokenizer.model.tokenize(part if part.isascii() else self.as_bytes.pre_tokenize_str(part)[0][0]))
            if len(self.parts) < REMEMBERED:
                self.parts[part] = n
        return n

    def learn(self, pieces: set[str]) -> None:
        """Put the counts of pieces without blanks into ``counts``: of words from the model, of the others from one encoding of all of them."""
        some = []
        for p in pieces:
            word = WORD.fullmatch(p) if self.by_word else None
            if word:
                self.counts[p] = self.part(word[1].lower()) + (self.part(word[2]) if word[2] else 0)
            else:
                some.append(p)
        e, n, counts = self.encode(" ".join(some)), 0, [0] * len(some)
        stops = list(accumulate(len(p) + 1 for p in some))
        for start, _ in e.offsets:
            while start >= stops[n]:
                n += 1
            counts[n] += 1
        self.counts.update(zip(some, counts))

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text; those of a piece between blanks or line ends are asked for once and remembered."""
        if not self.by_piece:
            return [len(self.encode(t)) for t in texts]
        known = self.counts
        lists = [t.replace("\n", " ").split(" ") for t in texts]
        fresh = set().union(*lists).difference(known)
        if fresh:
            self.learn(fresh)
        totals = [sum(map(known.__getitem__, pieces)) for pieces in lists]
        room = len(known) <= REMEMBERED
        for p in fresh:
            if not room or len(p) > SHORT_PIECE:
                del known[p]
        return totals

    def boundaries(self, text: str, base: int) -> tuple[int, list[tuple[int, int]]]:
        """Number of tokens, and (position, tokens before it) of the starts of pre-tokens that normalisation leaves apart."""
        e = self.encode(text)
        found, words, at, word = [], e.word_ids, 0, None
        for n, (start, stop) in enumerate(e.offsets):
            if words[n] != word:
                if start >= at and starts_afresh(text[start]):
                    found.append((base + start, n))
                word = words[n]
            at = max(at, stop)
        return len(words), found

    def zone_boundaries(self, text: str, base: int, head: int, tail: int) -> tuple[int, list[tuple[int, int]]]:
        """As ``boundaries``, for those before ``head`` and from ``tail`` on; what lies between two blanks between them is only counted."""
        first, last = text.find(" ", head), text.rfind(" ", 0, tail)
        if not self.by_piece or first < 0 or last <= first:
            return self.boundaries(text, base)
        n, found = self.boundaries(text[:first], base)
        n += self.count_all([text[first + 1 : last]])[0]
        more, rest = self.boundaries(text[last + 1 :], base + last + 1)
        return n + more, found + [(p, n + k) for p, k in rest]

    def in_sight(self, text: str) -> int:
        """Boundaries before this position depend on nothing behind the text's end."""
        at = len(text)
        while at > 0 and not starts_afresh(text[at - 1]):
            at -= 1
        return at - 1 - self.margin


def tokens_of(path: str) -> Tokens:
    return once_per_worker(f"token counts {path}", lambda: Tokens(path))


def joined_to_left() -> frozenset[str]:
    """Characters that canonical composition may join to one before them."""

    def make():
        found = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
        for c in range(0x110000):
            parts = unicodedata.decomposition(chr(c))
            if parts and parts[0] != "<" and " " in parts:
                found.add(chr(int(parts.split(" ")[1], 16)))
        return frozenset(found)

    return once_per_worker("joined to left", make)


def starts_afresh(c: str) -> bool:
    """Whether canonical composition leaves everything before ``c`` alone: what stands before it and from it on normalise apart."""
    if c < "\u0300":
        return True
    return not unicodedata.combining(c) and unicodedata.category(c) != "Cn" and c not in joined_to_left()


def sure(tokens: Tokens, zone: str) -> bool:
    """Whether both chunks that hold ``zone`` find the same boundary in it: a pre-token begins after any blank."""
    if not tokens.by_piece:
        return False
    most, at = tokens.in_sight(zone), zone.find(" ")
    while 0 <= at < most:
        c = zone[at + 1]
        if not c.isspace() and c < "\u0300":
            return True
        at = zone.find(" ", at + 1)
    return False


def count_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = pa.array([n for at in range(0, len(texts), 256) for n in tokens.count_all(texts[at : at + 256])], pa.int64())
            one, none = pa.array([1] * len(batch), pa.int64()), pa.array([0] * len(batch), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), counts, one, none], names=["doc_id", "n_bytes", "n_tokens", "n_chunks", "n_widened"])

    return run


def cut_rows(chunk: int, overlap: int):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("chunk", pa.int64()), ("base", pa.int64()), ("last", pa.bool_()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, n_bytes, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "n_bytes", "text"))):
                for n, base in enumerate(range(0, len(text), chunk)):
                    last = base + chunk + overlap >= len(text)
                    yield pa.RecordBatch.from_pylist(
                        [{"row": row, "doc_id": doc_id, "n_bytes": n_bytes, "chunk": n, "base": base, "last": last, "text": text[base : base + chunk + overlap]}], schema=schema
                    )
                    if last:
                        break

    return run


def coded(tokens: Tokens, base: int, text: str, last: bool, step: int, overlap: int) -> tuple:
    """Stop, tokens, boundaries in the head and in the tail zone, and the text where a splice is not sure to succeed."""
    n, found = tokens.zone_boundaries(text, base, overlap if base else 0, len(text) if last else step)
    heads = [x for x in found if base and x[0] < base + overlap]
    most = base + tokens.in_sight(text)
    tails = [] if last else [x for x in found if base + step <= x[0] <= most]
    keep = bool(base) and not sure(tokens, text[:overlap]) or not last and not sure(tokens, text[step:])
    return base + len(text), n, [p for p, _ in heads], [k for _, k in heads], [p for p, _ in tails], [k for _, k in tails], text if keep else None


def encode_chunks(path: str, step: int, overlap: int):
    kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 4, pa.string()]
    names = ["stop", "n_tokens", "heads", "head_counts", "tails", "tail_counts", "text"]
    order = [f.split()[0] for f in CODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in batches:
            out = [coded(tokens, b, t, last, step, overlap) for b, t, last in zip(*(batch.column(c).to_pylist() for c in ("base", "text", "last")))]
            kept = {c: batch.column(c) for c in ("row", "doc_id", "n_bytes", "chunk", "base", "last")}
            kept |= {c: pa.array(x, k) for c, x, k in zip(names, zip(*out), kinds)} if out else {c: pa.array([], k) for c, k in zip(names, kinds)}
            yield pa.RecordBatch.from_arrays([kept[c] for c in order], names=order)

    return run


class Splice:
    """Tokens of one text from its chunks in order.

    Of the chunk in hand (``stop``, its ``text`` where that may be needed, its
    boundaries in the zone it shares with the next) all tokens from ``at`` on
    are those of the whole text. A boundary in the shared zone that both
    chunks have ends the one and begins the other. If there is none, the next
    chunk is added to the one in hand and both are encoded again from ``at``;
    after a failure of that, no sooner than the text has doubled.
    """

    def __init__(self, tokens: Tokens, step: int, overlap: int):
        self.tokens, self.step, self.overlap = tokens, step, overlap
        self.total, self.widened, self.chunks = 0, 0, 0
        self.hand: dict | None = None

    def add(self, c: dict) -> None:
        self.chunks += 1
        h = self.hand
        if h is None:
            self.hand = c | {"at": c["base"], "before": 0, "done": len(c["text"] or ""), "stale": False}
            return
        if h["stale"] and (c["text"] is None or len(h["text"]) >= 2 * h["done"]):
            self.again()
        own = dict(zip(h["tails"], h["tail_counts"]))
        both = next(((p, k) for p, k in zip(c["heads"], c["head_counts"]) if p in own and p >= h["at"]), None)
        if both:
            self.total += own[both[0]] - h["before"]
            self.hand = c | {"at": both[0], "before": both[1], "done": len(c["text"] or ""), "stale": False}
        else:
            self.widened += 1
            text = h["text"][h["at"] - h["base"] :] + c["text"][h["stop"] - c["base"] :]
            self.hand = c | {"base": h["at"], "at": h["at"], "before": 0, "text": text, "done": h["done"], "stale": True, "tails": [], "tail_counts": []}

    def again(self) -> None:
        h = self.hand
        n, found = self.tokens.boundaries(h["text"], h["base"])
        most = h["base"] + self.tokens.in_sight(h["text"])
        tails = [] if h["last"] else [x for x in found if h["stop"] - self.overlap <= x[0] <= most]
        h |= {"n_tokens": n, "done": len(h["text"]), "stale": False, "tails": [p for p, _ in tails], "tail_counts": [k for _, k in tails]}

    def end(self) -> int:
        if self.hand["stale"]:
            self.again()
        return self.total + self.hand["n_tokens"] - self.hand["before"]


def splice_rows(path: str, step: int, overlap: int):
    """Chunks come sorted by row and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, row, of, s = tokens_of(path), None, (None, 0), None
        names = [f.split()[0] for f in RESULT.split(", ")]

        def result():
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*of, s.end(), s.chunks, s.widened)], names=names)

        for batch in batches:
            for c in batch.to_pylist():
                if s is None or c["row"] != row:
                    if s is not None:
                        yield result()
                    row, of, s = c["row"], (c["doc_id"], c["n_bytes"]), Splice(tokens, step, overlap)
                s.add(c)
        if s is not None:
            yield result()

    return run


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, chunk: int = 8192, overlap: int = 256, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``), n_chunks, n_widened.

    Tokens are those of the tokenizer file for the whole text, its special
    strings recognised and none added. Null counts as empty (no bytes, no
    tokens), repeated rows each get a row, an empty table none, a null id stays
    null, further columns are not read. The file must stand at the same place
    on all executors. It may be any whose pre-tokens are the matches of a
    pattern that does not look back, without a blank put in front.

    A text of more than ``chunk`` code points is cut every ``chunk`` ones into
    chunks that reach ``overlap`` further, encoded in parallel with offsets.
    Two neighbours are spliced at a place in the part they share where both
    begin a pre-token, where normalisation joins nothing, and which is far
    enough from the end of the left one that nothing unseen matters; there the
    matches of the pattern go on alike on both sides. Where there is no such
    place (a long text without a break) the overlap is widened by the next
    chunk, and doubled until there is one. Chunks whose splice is certain
    (a blank in the shared part) travel without their text.
    """
    if not 64 <= overlap <= chunk // 2:
        raise ValueError("the overlap must hold 64 code points and at most half a chunk")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    long = F.length("text") > chunk + overlap
    short = rows.where(~long).mapInArrow(count_rows(tokenizer_path), RESULT)
    n = partitions_of(docs.sparkSession)
    cut = rows.where(long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_bytes", "text").mapInArrow(cut_rows(chunk, overlap), CUT)
    chunks = cut.repartition(n, "row", "chunk").mapInArrow(encode_chunks(tokenizer_path, chunk, overlap), CODED)
    whole = chunks.repartition(n, "row").sortWithinPartitions("row", "chunk").mapInArrow(splice_rows(tokenizer_path, chunk, overlap), RESULT)
    return short.unionByName(whole).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks", "n_widened")
