"""Triple cleaning: ordered reasons, normal form, dedup within a record.

Two forms with equal results:

* record form - the triple list stays in its row and is cleaned by array
  expressions; no shuffle at all;
* long form - one row per triple (keys, pos, head, rel, tail). Rejected rows
  are classified in the scan; only survivors are shuffled, after a map-side
  combine on the whole triple, so neither a hot record nor a triple repeated
  by a third of all rows lands in one task.

Parts that are NULL in the long form mean a malformed triple.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import lexicon as L
from ..functions.json import error_of, has_error, triple_items
from ..functions.order import major_part, order_key
from ..functions.relations import canonical_relation, has_relation_keyword, is_placeholder, stripped_entity_valid
from ..functions.text import rows_of, strip


def reason(ok: Column, head: Column, rel: Column, tail: Column) -> Column:
    """First reason to reject a stripped triple, NULL if it stays."""
    return (
        F.when(~ok, "bad_format")
        .when(is_placeholder(head) | is_placeholder(rel) | is_placeholder(tail), "placeholder")
        .when(head == tail, "head_eq_tail")
        .when(~(stripped_entity_valid(head) & stripped_entity_valid(tail)), "invalid_entity")
        .when(~has_relation_keyword(rel), "rel_no_keyword")
    )


# --- long form ---------------------------------------------------------------


def _stripped(triples: DataFrame) -> DataFrame:
    parts = {c: strip(F.col(c)) for c in ("head", "rel", "tail")}
    return triples.withColumns(parts).withColumn("rel_norm", canonical_relation(F.col("rel")))


def _reason_of_columns() -> Column:
    head, rel, tail = (F.col(c) for c in ("head", "rel", "tail"))
    return reason(head.isNotNull() & rel.isNotNull() & tail.isNotNull(), head, rel, tail)


def classify(triples: DataFrame) -> DataFrame:
    """Strip the parts and add ``reason`` (NULL for survivors) and ``rel_norm``."""
    return _stripped(triples).withColumn("reason", _reason_of_columns())


def clean_triples(triples: DataFrame, rec: str = "rec") -> DataFrame:
    """Survivors, the first of equal normalised triples per record.

    Returns rec, pos, head, rel, tail with the normalised relation.
    """
    kept = _survivors(triples, rec)
    return kept.groupBy(rec, "head", "rel", "tail").agg(F.min("pos").alias("pos")).select(rec, "pos", "head", "rel", "tail")


def _survivors(triples: DataFrame, rec: str) -> DataFrame:
    """Rows without a reason; generated, since a filter would repeat the ladder."""
    row = F.struct("head", F.col("rel_norm").alias("rel"), "tail")
    alive = F.when(_reason_of_columns().isNull(), F.array(row))
    return _stripped(triples).select(rec, "pos", F.inline(alive))


def _outcome(triples: DataFrame, rec: str) -> DataFrame:
    """One scan, one shuffle: a row per survivor group and per rejecting reason.

    The triple is NULL in the key of rejected rows, so the map-side combine
    leaves a handful of rows per task for all of them.
    """
    c = classify(triples)
    alive = F.col("reason").isNull()
    keys = [F.when(alive, F.col(k)).alias(f"_{k}") for k in (rec, "head", "rel_norm", "tail")]
    first = order_key(triples, rec, "pos").alias("first")
    return (
        c.select(*keys, "reason", rec, first)
        .groupBy("reason", *[f"_{k}" for k in (rec, "head", "rel_norm", "tail")])
        .agg(F.count("*").alias("n"), F.min("first").alias("first"))
    )


def reason_counts(triples: DataFrame, errors: DataFrame | None = None, rec: str = "rec") -> DataFrame:
    """Removed triples per reason: reason, n, rank (most frequent, then first seen).

    ``errors`` has one row (rec) per record that failed to parse.
    """
    out = _outcome(triples, rec)
    alive = F.col("reason").isNull()
    removed = out.select(
        F.coalesce("reason", F.lit("dup")).alias("reason"),
        F.when(alive, F.col("n") - 1).otherwise(F.col("n")).alias("n"),
        "first",
    )
    if errors is not None:
        start = errors.select(rec, F.lit(0).cast(triples.schema["pos"].dataType).alias("pos"))
        removed = removed.unionByName(
            start.select(F.lit("llm_parse_error").alias("reason"), F.lit(1).cast("bigint").alias("n"),
                         order_key(triples, rec, "pos").alias("first"))
        )
    totals = removed.groupBy("reason").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("n") > 0, F.col("first"))).alias("first")
    )
    # at most one row per reason reaches this window; duplicates are found
    # after, parse errors before all other checks of their record
    late = F.when(F.col("reason") == "dup", 2).when(F.col("reason") == "llm_parse_error", 0).otherwise(1)
    record = major_part(triples, F.col("first"), rec, "pos")
    order = Window.orderBy(F.desc("n"), record, late, "first")
    return totals.filter("n > 0").select("reason", "n", F.row_number().over(order).alias("rank"))


def clean_totals(triples: DataFrame, rec: str = "rec") -> DataFrame:
    """One row: triples before and after cleaning."""
    out = _outcome(triples, rec)
    return out.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before"),
        F.count_if(F.col("reason").isNull()).alias("after"),
    )


# --- record form ---------------------------------------------------------------


def explode_items(records: DataFrame, *keys: str, triplets: str = "triplets") -> DataFrame:
    """Triple items of a VARIANT column: keys, pos, head, rel, tail (NULL if malformed).

    NULL lists and error objects give no row.
    """
    items = records.select(*keys, F.inline(triple_items(F.col(triplets))))
    return items.select(*keys, "pos", "head", "rel", "tail")


def parse_errors(records: DataFrame, *keys: str, triplets: str = "triplets") -> DataFrame:
    """Records whose triples are an object with the key ``error``: keys, error (NULL for a JSON null)."""
    failed = records.select(*keys, F.when(has_error(F.col(triplets)), F.array(error_of(F.col(triplets)))).alias("_e"))
    return failed.select(*keys, F.explode(rows_of(F.col("_e"))).alias("error"))


def judge_list(items: Column) -> Column:
    """Classify a list of ``triple_items``: array<struct<reason, head, rel, tail>>."""

    def bare(t: Column) -> Column:
        return F.struct(t["ok"].alias("ok"), *[strip(t[c]).alias(c) for c in ("head", "rel", "tail")])

    def one(t: Column) -> Column:
        return F.struct(
            reason(t["ok"], t["head"], t["rel"], t["tail"]).alias("reason"),
            t["head"].alias("head"), canonical_relation(t["rel"]).alias("rel"), t["tail"].alias("tail"),
        )

    return F.transform(F.transform(items, bare), one)


def keep_list(judged: Column) -> Column:
    """Survivors of ``judge_list`` in order, first of equal triples."""
    alive = F.filter(judged, lambda t: t["reason"].isNull())
    return F.transform(F.array_distinct(F.transform(alive, _packed)), _unpacked)


def _packed(t: Column) -> Column:
    """Triple as one string, lengths first: strings are told apart by hash, structs by comparing all pairs."""
    width = lambda c: F.lpad(F.length(t[c]).cast("string"), 10, "0")
    return F.concat(width("head"), width("rel"), t["head"], t["rel"], t["tail"])


def _unpacked(key: Column) -> Column:
    size = lambda at: F.substring(key, at, 10).cast("int")
    end = F.length(key)
    return F.struct(
        F.substring(key, F.lit(21), size(1)).alias("head"),
        F.substring(key, 21 + size(1), size(11)).alias("rel"),
        F.substring(key, 21 + size(1) + size(11), end).alias("tail"),
    )


def clean_records(records: DataFrame, triplets: str = "triplets", keep: Sequence[str] | None = None) -> DataFrame:
    """Replace the VARIANT triple list of every record by its cleaned list.

    Records without a survivor stay with an empty list. ``removed`` maps each
    reason to its count in the record.
    """
    columns = [c for c in (keep or records.columns) if c != triplets]
    judged = records.select(
        *columns,
        judge_list(triple_items(F.col(triplets))).alias("_judged"),
        has_error(F.col(triplets)).alias("_failed"),
    )
    kept = judged.withColumn("triplets", keep_list(F.col("_judged")))
    rejected = F.filter(F.col("_judged"), lambda t: t["reason"].isNotNull())
    alive = F.size("_judged") - F.size(rejected)
    count = lambda r: F.size(F.filter(rejected, lambda t: t["reason"] == r))
    numbers = {r: count(r) for r in L.REASONS[:5]}
    numbers["dup"] = alive - F.size("triplets")
    numbers["llm_parse_error"] = F.col("_failed").cast("int")
    pairs = [x for r in L.REASONS for x in (F.lit(r), numbers[r])]
    removed = F.map_filter(F.create_map(*pairs), lambda k, v: v > 0)
    return kept.select(*columns, "triplets", F.size("_judged").alias("before"), removed.alias("removed"))


def clean_lists(records: DataFrame, triplets: str = "triplets") -> DataFrame:
    """Clean well-formed lists (array<struct<head, rel, tail>>) in place."""
    items = F.transform(
        triplets, lambda t: F.struct(F.lit(True).alias("ok"), *[t[c].alias(c) for c in ("head", "rel", "tail")])
    )
    return records.withColumn(triplets, keep_list(judge_list(items)))


def removed_totals(cleaned: DataFrame) -> DataFrame:
    """Sum of the ``removed`` maps of ``clean_records``: reason, n."""
    rows = cleaned.select(F.inline(rows_of(F.map_entries("removed")))).toDF("reason", "c")
    return rows.groupBy("reason").agg(F.sum("c").alias("n"))


def valid_items(triplets: Column) -> Column:
    """Well-formed triples of a VARIANT list as array<struct<head, rel, tail>>."""
    return F.transform(
        F.filter(triple_items(triplets), lambda t: t["ok"]),
        lambda t: F.struct(t["head"].alias("head"), t["rel"].alias("rel"), t["tail"].alias("tail")),
    )
