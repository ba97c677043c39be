"""Preference pairs as a prompt and two masked completions (operator 2).

The turns that the chosen and the rejected conversation of a pair share from
the start are the prompt, rendered once; what follows on either side is that
side's completion. The result has one row per rendered turn, in a part
(``prompt``, ``chosen`` or ``rejected``) and at a position, with the span of
characters to train on: the text and closing line end of an assistant's turn
in a completion; everything else is masked. ``assemble`` joins the turns of a
part to one string where one example fits into a task.

Positions come from one global order of the turns, dealt out by ranges, so a
conversation with very many turns spreads over tasks. The common prefix ends
at the smallest position where the sides differ: an aggregate of digests per
position and then per pair, which gathers no conversation.

Defined results
  null role or text          like an empty one
  null turn                  comes first; equal turn numbers are ordered by role and digest of the rendered turn
  null pair id               part ``unpaired``, nothing to train on, position null
  one side only              no prompt, all turns are that side's completion, ``paired`` is false
  equal conversations        all turns are the prompt
  repeated rows              each is a turn
  very long texts            rendered whole
  empty tables               an empty result
  extra columns              are not read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import settle
from switchboard.llm.sharding import numbered

TRAINED_ROLE = "assistant"
OPEN, CLOSE, END = "<|", "|>\n", "\n"


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per rendered turn from the columns pair_id, rejected (boolean), turn, role, text."""
    own = turns.select("pair_id", F.coalesce("rejected", F.lit(False)).cast("int").alias("side"), "turn",
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rendered = _rendered(F.col("role"), F.col("text"))
    own = own.withColumn("rendered", rendered).withColumn("digest", F.sha2(rendered, 256)).withColumn(
        "head", F.char_length("role") + len(OPEN + CLOSE))
    ordered = settle(numbered(own.drop("text").where("pair_id IS NOT NULL"), ["pair_id", "side", "turn", "role", "digest"]),
                     "preference-ordered")
    first = settle(ordered.groupBy("pair_id", "side").agg(F.min("number").alias("first")), "preference-first")
    placed = settle(ordered.join(first, ["pair_id", "side"]).withColumn("position", F.col("number") - F.col("first")),
                    "preference-placed")
    agree = (F.min("side") != F.max("side")) & (F.min("digest") == F.max("digest"))
    places = placed.groupBy("pair_id", "position").agg(agree.alias("agree"), F.min("side").alias("low"), F.max("side").alias("high"))
    prefix = settle(places.groupBy("pair_id").agg(
        F.coalesce(F.min(F.when(~F.col("agree"), F.col("position"))), F.max("position") + 1).alias("prompt_turns"),
        (F.min("low") != F.max("high")).alias("paired")), "preference-prefix")
    common = F.col("position") < F.col("prompt_turns")
    trained = ~common & (F.col("role") == TRAINED_ROLE)
    paired = placed.join(prefix, "pair_id").where(~common | (F.col("side") == 0)).select(
        "pair_id", F.when(common, "prompt").when(F.col("side") == 0, "chosen").otherwise("rejected").alias("part"),
        "position", "role", "rendered", F.when(trained, F.col("head")).otherwise(F.lit(0)).alias("train_start"),
        F.when(trained, F.char_length("rendered")).otherwise(F.lit(0)).alias("train_end"), "paired")
    lost = own.where("pair_id IS NULL").select(
        "pair_id", F.lit("unpaired").alias("part"), F.lit(None).cast("long").alias("position"), "role", "rendered",
        F.lit(0).alias("train_start"), F.lit(0).alias("train_end"), F.lit(False).alias("paired"))
    return paired.unionByName(lost)


def assemble(formatted: DataFrame) -> DataFrame:
    """pair_id, part, text, spans (start, end of what is trained): the turns of each part as one string.

    A part is one value here; use the rows of ``format_pairs`` where examples may be larger than a task's memory.
    """
    parts = formatted.where("pair_id IS NOT NULL").groupBy("pair_id", "part").agg(F.sort_array(F.collect_list(
        F.struct("position", "rendered", "train_start", "train_end"))).alias("t"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    spans = F.aggregate("t", state, lambda s, x: F.struct(
        (s["at"] + F.char_length(x["rendered"])).alias("at"),
        F.when(x["train_end"] > 0, F.concat(s["spans"], F.array(F.struct(
            (s["at"] + x["train_start"]).alias("start"), (s["at"] + x["train_end"]).alias("end"))))).otherwise(
            s["spans"]).alias("spans")))["spans"]
    return parts.select("pair_id", "part", F.array_join(F.transform("t", lambda x: x["rendered"]), "").alias("text"),
                        spans.alias("spans"))


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(CLOSE), F.coalesce(text, F.lit("")), F.lit(END))


def replaced_answers(conversations: DataFrame) -> DataFrame:
    """Pairs that share their turns up to the last answer: a conversation, chosen, and the same turns with its last
    assistant turn taken from the next conversation that has one (the last takes the first's), rejected.

    The last of several assistant turns of one number is that with the largest digest; rows equal to it are replaced
    with it. A conversation without an assistant turn has no rejected side.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    place = F.struct("turn", F.sha2(_rendered(F.col("role"), F.col("text")), 256).alias("digest"))
    answers = settle(turns.where((F.col("role") == TRAINED_ROLE) & F.col("pair_id").isNotNull()).groupBy("pair_id").agg(
        F.max(F.struct(place.alias("place"), "text")).alias("last")), "preference-answers")
    ranked = settle(numbered(answers, ["pair_id"]), "preference-ranked")
    n = F.lit(ranked.count())
    taken = settle(ranked.select("pair_id", F.col("last.place").alias("place"), F.pmod(F.col("number") + 1, n).alias("number")).join(
        ranked.select("number", F.col("last.text").alias("other")), "number").drop("number"), "preference-taken")
    last = (F.col("role") == TRAINED_ROLE) & place.eqNullSafe(F.col("place"))
    rejected = settle(turns, "preference-turns").join(taken, "pair_id").select(
        "pair_id", F.lit(True).alias("rejected"), "turn", "role", F.when(last, F.col("other")).otherwise(F.col("text")).alias("text"))
    return turns.select("pair_id", F.lit(False).alias("rejected"), "turn", "role", "text").unionByName(rejected)


def adjacent_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of conversations paired by id: 2k is the chosen one of pair k, 2k + 1 the rejected one."""
    conv = F.col("conv_id").cast("long")
    return conversations.select(F.shiftright(conv, 1).alias("pair_id"), (F.pmod(conv, F.lit(2)) == 1).alias("rejected"),
                                F.col("turn").cast("long").alias("turn"), "role", "text")
