"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A turn is written as ``### role ###``, a line break, the text, ``</turn>`` and a line break.
Inside role and text a backslash stands before every backslash and ``#`` and between the
characters of ``</``, so ``###`` and ``</turn>`` occur as marks only and removing each
backslash's first character restores the text. Every assistant turn is an example of its own:
all turns before it are context, and only its text may be learned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
OPEN, OPENED, CLOSE = "### ", " ###\n", "</turn>\n"


def escaped(text: Column) -> Column:
    """text with its control strings broken up."""
    once = F.regexp_replace(text, r"([\\#])", r"\\$1")
    return F.regexp_replace(once, "</", r"<\\/")


def unescaped(text: Column) -> Column:
    """The inverse of escaped()."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_examples(turns: DataFrame) -> DataFrame:
    """Explode every assistant turn into an example.

    Input: conv_id, turn, role, text. Output: conv_id, example (from 0, in the order of turns),
    text, loss_start and loss_length in code points (the target's escaped text), trained.
    Turns after the last assistant turn, and conversations without one, make one more example
    with trained false and no loss, so every turn is in its conversation's last example. Null
    roles and texts count as empty; turns are ordered by turn (nulls first), role, text, so ties
    have one order and repeated rows are repeated turns. Rows with a null conv_id are one
    conversation. Extra columns are ignored; an empty table gives an empty result.

    A conversation's turns meet in one row, as its last example holds all of them; turns are
    collected on the map side first.
    """
    one = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(OPENED))
    cut = whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), head(t).alias("head"), escaped(t["text"]).alias("body"))).alias("cut"))
    full = cut.select("conv_id", "cut", F.transform("cut", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))).alias("full"))
    each = full.select("conv_id", "full", F.size("full").alias("n"), F.posexplode("cut").alias("at", "target"))
    trained = F.col("target.role") == ASSISTANT
    some = each.where(trained | (F.col("at") == F.col("n") - 1))
    before = F.array_join(F.slice("full", F.lit(1), F.col("at")), "")
    made = some.select("conv_id", F.col("at").alias("example_turn"), before.alias("before"), "target", trained.alias("trained"))
    return made.select(
        "conv_id",
        "example_turn",
        F.concat("before", "target.head", "target.body", F.lit(CLOSE)).alias("text"),
        (F.length("before") + F.length("target.head")).alias("loss_start"),
        F.when(F.col("trained"), F.length("target.body")).otherwise(0).alias("loss_length"),
        "trained",
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Turns and losses of each conversation, read from its formatted examples.

    Output: conv_id, n_turns, turns_sha256 (of role, line break, text, line break per turn),
    loss_chars, loss_sha256 (of the unescaped texts under the loss mask, side by side),
    formatted_chars (of all examples).
    """
    learned = unescaped(F.expr("substring(text, loss_start + 1, loss_length)"))
    by = examples.groupBy("conv_id").agg(
        F.max_by("text", "example_turn").alias("last"),
        F.array_sort(F.collect_list(F.when(F.col("trained"), F.struct("example_turn", learned.alias("learned"))))).alias("losses"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
    )
    parts = F.split(F.expr(f"substring(last, 1, length(last) - {len(CLOSE)})"), CLOSE)
    marks = F.transform(parts, lambda p: F.split(F.substr(p, F.lit(len(OPEN) + 1)), OPENED))
    said = F.array_join(F.transform(marks, lambda m: F.concat(unescaped(m[0]), F.lit("\n"), unescaped(m[1]), F.lit("\n"))), "")
    loss = F.array_join(F.transform("losses", lambda x: x["learned"]), "")
    return by.select("conv_id", F.size(parts).cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


#: The same digests in DuckDB; {turns} is a relation with conv_id, turn, role, text.
ORACLE = """
WITH plain AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {turns}
), sized AS (
  SELECT *, 17 + length(role) + length(text)
    + length(role || text) - length(replace(role || text, chr(92), ''))
    + length(role || text) - length(replace(role || text, '#', ''))
    + (length(role) - length(replace(role, '</', '')) + length(text) - length(replace(text, '</', ''))) // 2 AS chars,
    row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n
  FROM plain WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), run AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
FROM run GROUP BY conv_id
"""
