"""Op 1: preference pairs as one prompt and two masked completions.

The prompt is the longest common prefix of turns of the chosen and the rejected conversation, rendered once.
What follows in each is its completion. Only the text and end mark of assistant turns of a completion are
trained; ``spans`` has their start (from 0) and length in code points of the completion.

Turns are put in order by turn, role and text; repeated rows are repeated turns. A null role is an empty
one, a null text is empty. Turns without a conversation id belong to none. Equal conversations give two
empty completions. A conversation is one row of the result, and so is put together by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .registry import query

START, MIDDLE, END = "<|", "|>\n", "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and ``turns``: array of (role, text) in order."""
    row = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint"), row.alias("_t"))
    ordered = F.array_sort(F.collect_list("_t"))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def prefix_turns(a: Column, b: Column) -> Column:
    """Number of turns that two conversations share from the start."""
    size = F.least(F.size(a), F.size(b))
    other = F.filter(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda k: (k <= size) & ~F.element_at(a, k).eqNullSafe(F.element_at(b, k)))
    return F.when(F.size(other) > 0, F.element_at(other, 1) - 1).otherwise(size).cast("int")


def _head(t: Column) -> Column:
    return F.concat(F.lit(START), t["role"], F.lit(MIDDLE))


def _turn(t: Column) -> Column:
    return F.concat(_head(t), t["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def trained_spans(turns: Column) -> Column:
    """Start and length of the assistant's text and end mark in the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        head, body = F.length(_head(t)), F.length(t["text"]) + F.lit(len(END))
        span = F.array(F.struct((acc["at"] + head).cast("int").alias("start"), body.cast("int").alias("length")))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((acc["at"] + head + body).cast("int").alias("at"), spans.alias("spans"))
    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Adds prefix_turns, prompt, and the completion and spans of both sides to rows with ``chosen`` and ``rejected``."""
    pairs = pairs.withColumn("prefix_turns", prefix_turns(F.col("chosen"), F.col("rejected")))
    out = pairs.withColumn("prompt", render(F.slice("chosen", F.lit(1), F.col("prefix_turns"))))
    for side in ("chosen", "rejected"):
        rest = F.slice(side, F.col("prefix_turns") + 1, F.greatest(F.size(side) - F.col("prefix_turns"), F.lit(0)))
        out = out.withColumn(f"{side}_completion", render(rest)).withColumn(f"{side}_spans", trained_spans(rest))
    return out


def pairs_of(turns: DataFrame) -> DataFrame:
    """Preference pairs from conversations without ratings: the rejected side ends with the last turn of the
    conversation of the next id (or lacks the last turn, if there is none)."""
    own = conversations(turns)
    other = own.select((F.col("conv_id") - 1).alias("conv_id"), F.element_at("turns", -1).alias("_last"))
    cut = F.slice("turns", F.lit(1), F.size("turns") - 1)
    rejected = F.when(F.col("_last").isNull(), cut).otherwise(F.concat(cut, F.array("_last")))
    return own.join(other, "conv_id", "left").select("conv_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))


SQL = """
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
p AS (SELECT a.conv_id, a.turns AS chosen,
             CASE WHEN b.conv_id IS NULL THEN a.turns[1:len(a.turns) - 1] ELSE list_concat(a.turns[1:len(a.turns) - 1], [b.turns[len(b.turns)]]) END AS rejected
      FROM t a LEFT JOIN t b ON b.conv_id = a.conv_id + 1),
q AS (SELECT *, coalesce(list_min([k FOR k IN range(1, least(len(chosen), len(rejected)) + 1) IF chosen[k] <> rejected[k]]) - 1, least(len(chosen), len(rejected))) AS n FROM p),
r AS (SELECT conv_id, n, chosen[1:n] AS head, chosen[n + 1:len(chosen)] AS c, rejected[n + 1:len(rejected)] AS r FROM q),
x AS (SELECT conv_id, n,
             coalesce(array_to_string([concat('<|', t.role, '|>', chr(10), t.text, '<|end|>', chr(10)) FOR t IN head], ''), '') AS prompt,
             coalesce(array_to_string([concat('<|', t.role, '|>', chr(10), t.text, '<|end|>', chr(10)) FOR t IN c], ''), '') AS cc,
             coalesce(array_to_string([concat('<|', t.role, '|>', chr(10), t.text, '<|end|>', chr(10)) FOR t IN r], ''), '') AS rr,
             [CASE WHEN c[k].role = 'assistant' THEN
               concat(CAST(coalesce(list_sum([length(c[j].role) + length(c[j].text) + 13 FOR j IN range(1, k)]), 0) + length(c[k].role) + 5 AS BIGINT), '+', length(c[k].text) + 8) END FOR k IN range(1, len(c) + 1)] AS cs,
             [CASE WHEN r[k].role = 'assistant' THEN
               concat(CAST(coalesce(list_sum([length(r[j].role) + length(r[j].text) + 13 FOR j IN range(1, k)]), 0) + length(r[k].role) + 5 AS BIGINT), '+', length(r[k].text) + 8) END FOR k IN range(1, len(r) + 1)] AS rs
      FROM r)
SELECT conv_id, CAST(n AS INTEGER) AS prefix_turns, prompt, CAST(length(prompt) AS INTEGER) AS prompt_length, cc AS chosen_completion, rr AS rejected_completion,
       coalesce(array_to_string([s FOR s IN cs IF s IS NOT NULL], ','), '') AS chosen_spans, coalesce(array_to_string([s FOR s IN rs IF s IS NOT NULL], ','), '') AS rejected_spans
FROM x"""


@query("op1_preference_format", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = format_pairs(pairs_of(table(spark, sf_dir, "conversations")))

    def spans(name: str) -> Column:
        return F.array_join(F.transform(name, lambda s: F.concat(s["start"].cast("string"), F.lit("+"), s["length"].cast("string"))), ",")
    return made.select("conv_id", "prefix_turns", "prompt", F.length("prompt").alias("prompt_length"), "chosen_completion", "rejected_completion",
                       spans("chosen_spans").alias("chosen_spans"), spans("rejected_spans").alias("rejected_spans"))
