"""Chat formatting by perspective rotation, as native expressions.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant: the speaker's turns are the assistant's and are
trained on, the other participants' turns are those of named users, system
turns stay the system's.  A mask lists, for each turn, whether its text counts
for the loss, and spans give the trained characters of the rendering.

Dialogues come whole.  Turns are put in order across all tasks (a range sort,
with a row number as last key, so not even equal turns must meet), pieces of
``PIECE`` turns in that order are rendered on their own, and the finished pieces
of a perspective are joined: the only thing that grows with a dialogue in one
task is its own rendering.  With ``part_turns`` dialogues are split, for trainers
that want it, into parts of that many turn numbers.

Defined results: a turn with a null or empty role is the system's; null text is
rendered as empty text; turns with equal numbers are ordered by role and text;
a null turn number sorts first (with ``part_turns`` in a part of its own, -1);
rows with a null conversation id form one conversation; a conversation with
system turns only has no perspective; names are rendered with control marks,
``#`` and line ends taken out, and where this makes names of a conversation
equal, the second and later ones (by role) get ``#2``, ``#3``; texts have
their marks broken by a space, so that no text can forge a turn; repeated rows
are repeated turns; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SYSTEM = ("system",)
PIECE = 256
START, END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def perspectives(
    turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    system: tuple[str, ...] = SYSTEM, part_turns: int | None = None,
) -> DataFrame:
    """One row per conversation, participant and part (0 unless ``part_turns``
    is given): ``conv_id``, ``assistant``, ``part``, ``n_turns``, ``n_trained``,
    ``rendered``, ``mask`` (0 or 1 per turn) and ``spans`` (0-based start and
    end of the trained texts in ``rendered``)."""
    role = F.when(F.coalesce(turns[role_col], F.lit("")).isin("", *system), F.lit("system")).otherwise(turns[role_col])
    rows = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].cast("bigint").alias("turn"), role.alias("role"), turns[text_col].alias("text"))
    plain = F.regexp_replace("role", r"[\s<>|#]+", "_")
    k = F.row_number().over(Window.partitionBy("conv_id", "plain").orderBy("role"))
    speakers = rows.where("role != 'system'").groupBy("conv_id", "role").agg(F.lit(1).alias("one")).withColumn("plain", plain)
    speakers = speakers.select(F.col("conv_id").alias("of"), F.col("role").alias("assistant"), F.when(k == 1, F.col("plain")).otherwise(F.concat("plain", F.lit("#"), k.cast("string"))).alias("name"))
    speakers = written(speakers, "speakers")
    part = F.lit(0) if part_turns is None else F.coalesce(F.floor(F.col("turn") / F.lit(part_turns)), F.lit(-1))
    named = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("assistant")), "left").drop("of", "assistant")
    named = named.withColumns({"part": part.cast("bigint"), "row": F.monotonically_increasing_id()})
    keys = ["conv_id", "turn", "role", "text", "row"]
    ordered = named.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id()).drop("turn", "row")
    ordered = written(ordered, "ordered-turns")
    piece = F.floor(F.col("place") / F.lit(PIECE)).alias("piece")
    pieces = ordered.groupBy("conv_id", "part", piece).agg(F.sort_array(F.collect_list(F.struct("place", "role", "name", "text"))).alias("turns"))
    each = pieces.join(speakers.drop("name"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")

    def segment(t: Column) -> Column:
        mine = t["role"] == F.col("assistant")
        head = F.when(t["role"] == "system", F.lit(f"{START}system\n")).when(mine, F.lit(f"{START}assistant\n")).otherwise(F.concat(F.lit(f"{START}user name="), t["name"], F.lit("\n")))
        return F.struct(head.alias("head"), _plain(t["text"]).alias("body"), mine.cast("int").alias("trained"))

    tail = F.lit(f"{END}\n")
    made = each.withColumn("segments", F.transform("turns", segment))

    def span(start: Column, stop: Column) -> Column:
        return F.struct(start.cast("bigint").alias("start"), stop.cast("bigint").alias("stop"))

    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    # Characters before each turn: one pass that carries the length so far.
    def after(acc: Column, s: Column) -> Column:
        body = acc["at"] + F.length(s["head"])
        return F.struct(
            (body + F.length(s["body"]) + F.length(tail)).cast("bigint").alias("at"),
            F.when(s["trained"] == 1, F.concat(acc["spans"], F.array(span(body, body + F.length(s["body"]))))).otherwise(acc["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
    rendered = made.select(
        "conv_id", "assistant", "part", F.struct(
            "piece", F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"], tail)), "").alias("text"),
            F.array_join(F.transform("segments", lambda s: s["trained"].cast("string")), "").alias("mask"),
            F.aggregate("segments", start, after).alias("walk"),
        ).alias("piece"),
    )
    whole = rendered.groupBy("conv_id", "assistant", "part").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    spans = F.aggregate(
        "pieces", start,
        lambda acc, p: F.struct(
            (acc["at"] + p["walk"]["at"]).alias("at"),
            F.concat(acc["spans"], F.transform(p["walk"]["spans"], lambda s: span(s["start"] + acc["at"], s["stop"] + acc["at"]))).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    mask = F.array_join(F.transform("pieces", lambda p: p["mask"]), "")
    return whole.select(
        "conv_id", "assistant", "part", F.length(mask).cast("bigint").alias("n_turns"), F.length(F.replace(mask, F.lit("0"), F.lit(""))).cast("bigint").alias("n_trained"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("rendered"), mask.alias("mask"), spans.alias("spans"),
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return made.withColumn("spans", spans)
