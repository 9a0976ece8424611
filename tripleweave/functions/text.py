"""Text expressions: strip, line cleaning, sentence split, chunk packing.

All of them are plain Column expressions. Text is never shuffled here, each
regular expression runs once over a text or a line and is linear in its
length, and nothing is evaluated twice (``let`` binds a value once).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace as a Python string method sees it. SQL trim() alone only
# knows U+0020 and the regex class \s only ASCII.
_SPACE = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE_CHARS = "".join(map(chr, _SPACE))
SPACE_CLASS = "[" + "".join(f"\\x{{{c:x}}}" for c in _SPACE) + "]"

# --- fixed values: patterns ----------------------------------------------------
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
PAGE_NUMBER_LINE = r"^\p{Nd}{1,4}$"
PAGE_HEADER_LINE = rf"^(?i:page){SPACE_CLASS}*\p{{Nd}}"
PAGE_MARK_LINE = rf"^第{SPACE_CLASS}*\p{{Nd}}+{SPACE_CLASS}*页$"
SEPARATOR_LINE = r"^[-*_]{3,}$"
SENTENCE_BREAK = rf"(?<=[。！？!?.]){SPACE_CLASS}*"
DEFAULT_BUDGET = 512
# --- end of fixed values -------------------------------------------------------


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.transform(F.array(value), lambda v: body(v)).getItem(0)


def rows_of(items: Column) -> Column:
    """An array to explode that was computed in an earlier step.

    Exploding a bare column makes the optimizer infer a filter on its size and
    push that below the step, which would compute the array twice.
    """
    return F.slice(items, F.lit(1), F.size(items))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends; looks at the ends only."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def raw_lines(text: Column) -> Column:
    """All lines, stripped, blank ones included."""
    return F.transform(F.split(text, LINE_BREAK), strip)


def is_page_number(line: Column) -> Column:
    return line.rlike(PAGE_NUMBER_LINE)


def is_page_header(line: Column) -> Column:
    return line.rlike(PAGE_HEADER_LINE)


def is_page_mark(line: Column) -> Column:
    return line.rlike(PAGE_MARK_LINE)


def is_separator(line: Column) -> Column:
    return line.rlike(SEPARATOR_LINE)


def lines(text: Column, drop: tuple[Callable[[Column], Column], ...] = ()) -> Column:
    """Stripped, non-blank lines for which no predicate of ``drop`` holds."""

    def keep(line: Column) -> Column:
        ok = line != ""
        for noise in drop:
            ok = ok & ~noise(line)
        return ok

    return F.filter(raw_lines(text), keep)


PAGE_NOISE = (is_page_number, is_page_header)
EXTRA_NOISE = (*PAGE_NOISE, is_page_mark, is_separator)


def clean_text(text: Column, extra: bool = False) -> Column:
    """Noise lines removed, the rest joined with a newline."""
    return F.array_join(lines(text, EXTRA_NOISE if extra else PAGE_NOISE), "\n")


def sentences(text: Column) -> Column:
    """Split after sentence terminators, swallowing the whitespace behind.

    After stripping the whole text a part can neither start nor end with
    whitespace, and only the last one can be empty.
    """
    return F.array_remove(F.split(strip(text), SENTENCE_BREAK), "")


def estimate_tokens(sentence: Column) -> Column:
    """Half the number of code points, at least one."""
    return F.greatest(F.lit(1), F.shiftright(F.length(sentence), 1))


def length_sizes(parts: Column) -> Column:
    """Token estimate of every sentence in an array (default for packing)."""
    return F.transform(parts, estimate_tokens)


FOLD = 512


def chunk_starts(sizes: Column, budget: int = DEFAULT_BUDGET) -> Column:
    """1-based position of the first sentence of each chunk.

    A greedy fold: a chunk is closed when the next sentence would exceed the
    budget; a sentence above the budget stands alone. The state holds one
    number per chunk, not the text. A fold copies its state at every step, so
    sentences are folded ``FOLD`` at a time and the lists joined per block.
    """
    none = F.array().cast("array<int>")
    state = F.struct(none.alias("starts"), F.lit(0).alias("used"), F.lit(1).alias("at"))

    def step(acc: Column, size: Column) -> Column:
        opens = (acc["at"] == 1) | (acc["used"] + size > budget)
        return F.struct(
            F.when(opens, F.array_append(acc["starts"], acc["at"])).otherwise(acc["starts"]).alias("starts"),
            F.when(opens, size).otherwise(acc["used"] + size).alias("used"),
            (acc["at"] + 1).alias("at"),
        )

    def block(acc: Column, part: Column) -> Column:
        begin = F.struct(none.alias("starts"), acc["used"].alias("used"), acc["at"].alias("at"))
        return let(
            F.aggregate(part, begin, step),
            lambda r: F.struct(F.concat(acc["starts"], r["starts"]).alias("starts"), r["used"].alias("used"), r["at"].alias("at")),
        )

    def in_blocks(all_sizes: Column) -> Column:
        firsts = F.when(F.size(all_sizes) > 0, F.sequence(F.lit(1), F.size(all_sizes), F.lit(FOLD)))
        parts = F.transform(firsts, lambda i: F.slice(all_sizes, i, F.lit(FOLD)))
        return F.aggregate(F.coalesce(parts, F.array().cast("array<array<int>>")), state, block, lambda acc: acc["starts"])

    return let(sizes, in_blocks)


def cut_chunks(parts: Column, starts: Column) -> Column:
    """Join the sentences of each chunk without a separator."""

    def join_all(st: Column) -> Column:
        def join_one(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(st, k + 1), F.size(parts) + 1)
            return F.array_join(F.slice(parts, start, end - start), "")

        return F.transform(st, join_one)

    return let(starts, join_all)


def pack(parts: Column, budget: int = DEFAULT_BUDGET) -> Column:
    """Pack an array of sentences into an array of chunk texts."""
    return cut_chunks(parts, chunk_starts(length_sizes(parts), budget))
