"""Chat formatting of preference pairs (native: built-in functions only).

A pair is a chosen and a rejected conversation. The longest run of turns that
both begin with (same role, same text) is rendered once as the prompt; what
follows is rendered as two completions. Each completion comes with the spans of
characters that are trained on: the text and end mark of assistant turns.

One shuffle brings the turns of a pair together, however many conversations
share a first turn. A rendered conversation is one value, so the turns of one
pair are held at once; nothing larger is.

Defined cases: turns are ordered by turn (null first), role and text, so ties
and repeated rows have one order and all stay; a null role or text is empty;
marks inside a role or text are broken up, so they can't end a turn; if one
conversation begins with the whole of the other, its completion is empty; a
conversation without a partner makes a pair with an empty prompt and null for
the missing completion; a null conv_id belongs to no pair and goes; other
columns of the turns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowloom.llm.common import read

START, END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), "")


def _trained(turns: Column) -> Column:
    """(start, end) of the trained characters of rendered turns, end exclusive."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(done, t):
        begin = done["at"] + len(START) + F.char_length(t["role"]) + 1
        end = begin + F.char_length(t["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(
            t["role"] == "assistant", F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))
    return F.aggregate(turns, zero, step)["spans"]


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, pair_id, side): conversations 2k and 2k+1 are the chosen and the rejected one of pair k."""
    ids = turns.select("conv_id").where("conv_id is not null").distinct()
    return ids.select("conv_id", F.shiftright("conv_id", 1).cast("bigint").alias("pair_id"),
                      F.when(F.pmod("conv_id", F.lit(2)) == 0, "chosen").otherwise("rejected").alias("side"))


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row for each pair: pair_id, chosen_id, rejected_id, n_prompt_turns, prompt, chosen, rejected,
    chosen_mask, rejected_mask.

    ``turns`` has conv_id, turn, role, text; ``pairs`` conv_id, pair_id, side
    ('chosen' or 'rejected'), each side of a pair once.
    """
    rows = turns.select("conv_id", "turn", _plain(F.col("role")).alias("role"), _plain(F.col("text")).alias("text"))
    turn = F.struct("turn", "role", "text")
    sides = (
        rows.join(pairs.select("conv_id", "pair_id", "side"), "conv_id").groupBy("pair_id")
        .agg(*[F.array_sort(F.collect_list(F.when(F.col("side") == side, turn))).alias(side)
               for side in ("chosen", "rejected")],
             *[F.max(F.when(F.col("side") == side, F.col("conv_id"))).alias(f"{side}_id")
               for side in ("chosen", "rejected")])
    )
    short = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(F.slice("chosen", 1, short), F.slice("rejected", 1, short),
                      lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]))
    first_other = F.array_position(same, F.lit(False)).cast("int")
    shared = F.when(first_other > 0, first_other - 1).otherwise(short)
    cut = sides.withColumn("_n", shared)

    def rest(side):
        return F.slice(side, F.col("_n") + 1, F.size(side))

    def present(side, value):
        return F.when(F.col(f"{side}_id").isNotNull(), value)

    return cut.select(
        "pair_id", "chosen_id", "rejected_id", F.col("_n").cast("long").alias("n_prompt_turns"),
        _render(F.slice("chosen", 1, F.col("_n"))).alias("prompt"),
        *[present(side, _render(rest(side))).alias(side) for side in ("chosen", "rejected")],
        *[present(side, _trained(rest(side))).alias(f"{side}_mask") for side in ("chosen", "rejected")])


def _spans_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted pair of neighbouring conversations."""
    turns = read(spark, sf_dir, "conversations")
    done = format_preferences(turns, neighbour_pairs(turns))
    return done.select(
        "pair_id", "chosen_id", "rejected_id", "n_prompt_turns", F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2("chosen", 256).alias("chosen_sha256"), F.sha2("rejected", 256).alias("rejected_sha256"),
        _spans_text("chosen_mask").alias("chosen_mask"), _spans_text("rejected_mask").alias("rejected_mask"))


def _side_sql(side: str, remainder: int) -> str:
    return f"""
{side}_rows AS (
  SELECT *, s - 1 - len(role) - {len(START)} AS at FROM (
    SELECT t.pair_id, t.place, t.role, t.text, {len(START)} + len(t.role) + 1 + coalesce(sum({len(START + END) + 2}
           + len(t.role) + len(t.text)) OVER (PARTITION BY t.pair_id ORDER BY t.place
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
    FROM turns t JOIN shared p ON t.pair_id = p.pair_id WHERE t.side = {remainder} AND t.place > p.n)),
{side} AS (
  SELECT pair_id, string_agg('{START}' || role || chr(10) || text || '{END}' || chr(10), '' ORDER BY place) AS body,
         string_agg(CAST(s AS VARCHAR) || ':' || CAST(s + len(text) + {len(END)} AS VARCHAR), ',' ORDER BY place)
         FILTER (role = 'assistant') AS mask
  FROM {side}_rows GROUP BY pair_id),"""


OP10_SQL = f"""
WITH plain AS (
  SELECT conv_id, turn, replace(coalesce(role, ''), '<|', '< |') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id, conv_id % 2 AS side, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM plain),
ids AS (
  SELECT pair_id, max(conv_id) FILTER (side = 0) AS chosen_id, max(conv_id) FILTER (side = 1) AS rejected_id
  FROM turns GROUP BY pair_id),
compared AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.place, b.place) AS place,
         coalesce(a.role = b.role AND a.text = b.text, false) AS same
  FROM (SELECT * FROM turns WHERE side = 0) a
  FULL JOIN (SELECT * FROM turns WHERE side = 1) b ON a.pair_id = b.pair_id AND a.place = b.place),
shared AS (
  SELECT pair_id, coalesce(min(place) FILTER (NOT same) - 1, max(place)) AS n FROM compared GROUP BY pair_id),
prompts AS (
  SELECT t.pair_id, string_agg('{START}' || role || chr(10) || text || '{END}' || chr(10), '' ORDER BY place) AS body
  FROM turns t JOIN shared p ON t.pair_id = p.pair_id WHERE side = 0 AND place <= p.n GROUP BY t.pair_id),
{_side_sql('chosen', 0)}
{_side_sql('rejected', 1)}
joined AS (
  SELECT i.*, p.n, q.body AS prompt, c.body AS chosen, c.mask AS chosen_spans, r.body AS rejected, r.mask AS rejected_spans
  FROM ids i JOIN shared p ON i.pair_id = p.pair_id LEFT JOIN prompts q ON i.pair_id = q.pair_id
  LEFT JOIN chosen c ON i.pair_id = c.pair_id LEFT JOIN rejected r ON i.pair_id = r.pair_id)
SELECT pair_id, chosen_id, rejected_id, n AS n_prompt_turns, sha256(coalesce(prompt, '')) AS prompt_sha256,
  CASE WHEN chosen_id IS NOT NULL THEN sha256(coalesce(chosen, '')) END AS chosen_sha256,
  CASE WHEN rejected_id IS NOT NULL THEN sha256(coalesce(rejected, '')) END AS rejected_sha256,
  CASE WHEN chosen_id IS NOT NULL THEN coalesce(chosen_spans, '') END AS chosen_mask,
  CASE WHEN rejected_id IS NOT NULL THEN coalesce(rejected_spans, '') END AS rejected_mask
FROM joined
"""
