"""Chat formatting from every participant's perspective."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: markers of the rendered format
BEGIN, END = "<|im_start|>", "<|im_end|>"


def safe(text: Column) -> Column:
    """Content in which no marker can be read: a blank breaks each one."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit(BEGIN), F.lit("< |im_start|>")), F.lit(END), F.lit("< |im_end|>"))


def speaker_name(speaker: Column) -> Column:
    """Speaker as a name of one word: letters, digits, ``_``, ``.``, ``-``; none at all is ``unknown``."""
    return F.coalesce(F.nullif(F.regexp_replace(speaker, r"[^\p{L}\p{N}_.-]", "_"), F.lit("")), F.lit("unknown"))


def perspectives(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text",
    narrators: tuple[str, ...] = ("system",), part_turns: int = 1024,
) -> DataFrame:
    """One row per conversation, participant and part: the dialogue with that participant as the assistant.

    Columns: conv_id, perspective, part, text, segments (role, name, content,
    trained, start, stop; character ranges in text), n_turns, n_trained,
    trained_chars. The participant's own turns are ``assistant`` and trained
    on (content and end marker); all others are ``user`` with their name;
    narrators stay ``system``, take no perspective and are never trained on.

    Turns are in order of number, speaker, text; a null number comes first.
    Rows that repeat all of these count once. A null speaker speaks as
    ``unknown`` and has no perspective, a null text is empty, a null
    conversation is a conversation. One without participants, and an empty
    table, give no rows. Markers inside a text are broken by a blank.

    A part holds the turns of ``part_turns`` consecutive numbers, so a
    conversation with a large share of all rows is many groups, and only its
    set of speakers, gathered with map-side combining, is joined to them.
    """
    part = F.coalesce(F.floor(F.col(turn_col) / part_turns), F.lit(0)).cast("long")
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), part.alias("part"), F.col(turn_col).alias("turn"), F.col(speaker_col).alias("speaker"),
        F.coalesce(F.col(text_col), F.lit("")).alias("content"),
    )
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_set(F.struct("turn", F.coalesce("speaker", F.lit("")).alias("by"), "content"))).alias("turns"))
    people = rows.where(F.col("speaker").isNotNull() & (F.col("speaker") != "") & ~F.col("speaker").isin(*narrators)).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")
    ).distinct()
    own = parts.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))

    def segment(t: Column) -> Column:
        role = F.when(t["by"].isin(*narrators), "system").when(t["by"] == F.col("perspective"), "assistant").otherwise("user")
        name = F.when(role == "user", speaker_name(t["by"]))
        content = safe(t["content"])
        head = F.concat(F.lit(BEGIN), role, F.when(role == "user", F.concat(F.lit(" name="), name)).otherwise(""), F.lit("\n"))
        return F.struct(role.alias("role"), name.alias("name"), content.alias("content"), (role == "assistant").alias("trained"), head.alias("head"))

    def place(a: Column, s: Column) -> Column:
        start = a["at"] + F.length(s["head"])
        stop = start + F.length(s["content"]) + len(END)
        one = F.struct(s["role"].alias("role"), s["name"].alias("name"), s["content"].alias("content"), s["trained"].alias("trained"), start.alias("start"), stop.alias("stop"))
        return F.struct((stop + 1).cast("long").alias("at"), F.concat(a["done"], F.array(one)).alias("done"))

    shown = own.withColumn("cut", F.transform("turns", segment))
    text = F.array_join(F.transform("cut", lambda s: F.concat(s["head"], s["content"], F.lit(END + "\n"))), "")
    kind = "array<struct<role:string,name:string,content:string,trained:boolean,start:bigint,stop:bigint>>"
    placed = F.aggregate("cut", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("done")), place, lambda a: a["done"])
    done = shown.select("conv_id", "perspective", "part", text.alias("text"), placed.alias("segments"))
    trained = F.filter("segments", lambda s: s["trained"])
    return done.withColumns({
        "n_turns": F.size("segments").cast("long"), "n_trained": F.size(trained).cast("long"),
        "trained_chars": F.aggregate(trained, F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]),
    })


def mask_text(segments: str = "segments") -> Column:
    """Trained character ranges as text: ``start-stop`` joined by commas."""
    some = F.filter(segments, lambda s: s["trained"])
    return F.array_join(F.transform(some, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
