"""Preference formatting: one prompt and two masked completions from a chosen and a rejected conversation.

The longest common prefix of turns (equal role and text, position by position) is rendered once as the
prompt; what remains of each conversation is its completion.  A completion carries the spans, in
code points from its start, that a trainer may learn from: the text and the end mark of every
assistant turn.  All else is masked.

Only Spark expressions are used.  A conversation is gathered into one array, which is as large as the
conversation.  Nothing is grouped by what conversations say, so a first turn or a whole conversation that many
rows share makes no large group.

Marks are ``<|role|>`` and ``<|end|>``.  A ``<|`` inside a role or a text is written ``< |``, so no text can end its own
turn or start another one; spans are positions in what is written.

Defined cases: a null role or text is rendered as empty and equals another null; turns are ordered by turn
number (null first), then role and text, so repeated turns stay, in a fixed order; equal
conversations give a prompt of all turns and empty completions; a pair with one side missing has an empty
prompt and an empty completion on that side; a turn without a conversation id is a conversation of its own, which no
other one follows; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.search import rank_in

MAX_RANGES = 2048
ASSISTANT, END = "assistant", "<|end|>\n"
_TURNS = "array<struct<role:string,text:string>>"


def _turn_rows(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``id t`` with nulls as empty strings and marks inside texts opened."""
    said = lambda c: F.replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit("<|"), F.lit("< |"))
    one = F.struct(F.col(f"`{turn_col}`").alias("n"), said(role_col).alias("role"), said(text_col).alias("text"))
    return turns.select(F.col(f"`{id_col}`").alias("id"), one.alias("t"))


def _in_order(ts: Column) -> Column:
    return F.transform(F.array_sort(ts), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def gather(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``id turns``: the turns of each conversation in order; a turn without an id is a conversation of its own."""
    rows = _turn_rows(turns, id_col, turn_col, role_col, text_col)
    whole = rows.where("id IS NOT NULL").groupBy("id").agg(F.collect_list("t").alias("ts"))
    return whole.unionByName(rows.where("id IS NULL").select("id", F.array("t").alias("ts"))).select("id", _in_order(F.col("ts")).alias("turns"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _text(turn: Column) -> Column:
    return F.concat(_head(turn), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _text), "")


def trained_spans(turns: Column) -> Column:
    """``[{from, to}]``: code point spans of the assistant's texts and end marks in ``render(turns)``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<from:bigint,to:bigint>>").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        first = acc["at"] + F.char_length(_head(turn))
        last = first + F.char_length(turn["text"]) + F.lit(len(END))
        span = F.struct(first.cast("long").alias("from"), last.cast("long").alias("to"))
        return F.struct(last.cast("long").alias("at"), F.when(turn["role"] == ASSISTANT, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that two arrays share."""
    differs = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differs, True)
    return F.when(at > 0, at - 1).otherwise(F.size(a).cast("long"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``id chosen rejected`` (arrays of turns) -> ``id n_prefix prompt chosen rejected chosen_spans rejected_spans``."""
    none = F.array().cast(_TURNS)
    sides = pairs.select("id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r")).withColumn("n", common_prefix(F.col("c"), F.col("r")))
    rest = lambda side: F.slice(F.col(side), F.col("n").cast("int") + 1, F.greatest(F.size(side) - F.col("n").cast("int"), F.lit(0)))
    cut = sides.select("id", "n", F.slice("c", 1, F.col("n").cast("int")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return cut.select("id", F.col("n").alias("n_prefix"), render(F.col("p")).alias("prompt"), render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"), trained_spans(F.col("c")).alias("chosen_spans"), trained_spans(F.col("r")).alias("rejected_spans"))


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: rejected is the conversation with its last assistant turn (and
    what follows it cut off on both sides) replaced by the last one of the conversation with the next id that exists.

    Without an assistant turn both sides are the whole conversation; without a next conversation, or one that has
    no assistant turn, the rejected side just ends there.

    Turns are dealt to ranges of ids (quantiles, at most ``MAX_RANGES`` numbers on the driver), and those of a range's
    first conversation to the range before as well, so one shuffle gathers conversations and puts
    each beside the next one.
    """
    rows = _turn_rows(conversations, "conv_id", "turn", "role", "text")
    known = rows.where("id IS NOT NULL")
    ranges = min(MAX_RANGES, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    marks = sorted({int(b) for b in known.approxQuantile("id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))})
    own = rank_in(F.array(*[F.lit(m).cast("long") for m in marks]).cast("array<bigint>"), F.col("id"), len(marks)) if marks else F.lit(0)
    firsts = {r.range: r.id for r in known.groupBy(own.alias("range")).agg(F.min("id").alias("id")).collect()}  # one row a range
    held = sorted(firsts)
    before = {firsts[q]: p for p, q in zip(held, held[1:], strict=False)}
    lent = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair]), F.col("id")).cast("int") if before else F.lit(None).cast("int")
    dealt = known.withColumn("own", own).select("id", "t", "own", F.explode(F.array_compact(F.array("own", lent))).alias("range"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_own = lambda t: t["role"] == ASSISTANT
    last = F.size("turns") + 1 - F.array_position(F.reverse(F.transform("turns", is_own)), True).cast("int")

    def answered(df: DataFrame) -> DataFrame:
        ordered = df.withColumn("turns", _in_order(F.col("ts"))).drop("ts")
        return ordered.withColumn("last", F.when(F.exists("turns", is_own), last).otherwise(0))

    # dealt by range once: gathering and looking at the next conversation both stay where the rows are
    c = answered(dealt.repartition(n, "range").groupBy("range", "own", "id").agg(F.collect_list("t").alias("ts")))
    answer = F.when(F.col("last") > 0, F.element_at("turns", F.col("last")))
    c = c.withColumn("answer", answer).withColumn("other", F.lead("answer").over(Window.partitionBy("range").orderBy("id"))).where("own = range").select("id", "turns", "last", "other")
    lone = answered(rows.where("id IS NULL").select("id", F.array("t").alias("ts"))).select("id", "turns", "last", F.lit(None).cast(c.schema["other"].dataType).alias("other"))
    c = c.unionByName(lone)
    up_to = F.slice("turns", 1, F.greatest(F.col("last") - 1, F.lit(0)))
    swapped = F.when(F.col("other").isNull(), up_to).otherwise(F.array_append(up_to, F.col("other")))
    chosen = F.when(F.col("last") > 0, F.slice("turns", 1, F.greatest("last", F.lit(0)))).otherwise(F.col("turns"))
    return c.select("id", chosen.alias("chosen"), F.when(F.col("last") > 0, swapped).otherwise(F.col("turns")).alias("rejected"))
