"""Chat formatting: cumulative-snapshot collapse, then rendering. Built-in functions only.

A chat log often holds a conversation again each time it grew. Every turn gets two 64-bit hashes of its place, role and
text digest; their running exclusive-or over a conversation is the rolling hash of each turn prefix. Conversations with
the same full hash are one (the smallest id stays), and an anti-join against the hashes of proper prefixes leaves the
maximal conversations, which are rendered turn by turn.

Cases: rows without a conversation id take no part; a null role is ``unknown``, a null text empty; turns are ordered by
turn (null first), role, and the text's MD5; equal rows of one conversation count once; a conversation that is a prefix of
another, or equal to one with a smaller id, is left out; an empty table gives no rows. Extra columns are ignored. Only ids,
roles and digests go through the windows; a text is moved once, for the conversations that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def turns_of(log: DataFrame) -> DataFrame:
    return log.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("digest", F.md5(F.col("text").cast("binary")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, n, h1, h2): the rolling hashes of every turn prefix; n is the conversation's length."""
    own = turns.select("conv_id", "turn", "role", "digest").distinct()  # repeats go before anything moves by conversation
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "digest")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = own.withColumn("place", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(whole))
    for name, salt in (("h1", 1), ("h2", 2)):
        placed = placed.withColumn(name, F.bit_xor(F.xxhash64(F.lit(salt), "place", "role", "digest")).over(running))
    return placed.select("conv_id", "place", "n", "h1", "h2")


def maximal(log: DataFrame) -> DataFrame:
    """(conv_id, n_copies) of the conversations that stay. Copies are pre-aggregated before the anti-join, so a
    conversation or first turn logged very often is one key."""
    hashes = prefix_hashes(turns_of(log))
    full = hashes.where(F.col("place") == F.col("n")).groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    proper = hashes.where(F.col("place") < F.col("n")).select(F.col("place").alias("n"), "h1", "h2").distinct()
    return full.join(proper, ["n", "h1", "h2"], "left_anti").select("conv_id", "n_copies")


def render(log: DataFrame, *, start: str = "<|{}|>\n", end: str = "<|end|>\n") -> DataFrame:
    """conv_id, n_turns, n_assistant, n_copies, text: the maximal conversations, each turn as start(role) + text + end."""
    before, after = start.split("{}")
    kept = maximal(log)
    turns = turns_of(log).join(kept, "conv_id")
    return turns.groupBy("conv_id").agg(
        F.min("n_copies").alias("n_copies"), F.sort_array(F.collect_set(F.struct("turn", "role", "digest", "text"))).alias("turns")
    ).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.size(F.filter("turns", lambda t: t["role"] == "assistant")).cast("long").alias("n_assistant"), "n_copies",
        F.array_join(F.transform("turns", lambda t: F.concat(F.lit(before), t["role"], F.lit(after), t["text"], F.lit(end))), "").alias("text"),
    )


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, md5(text)) AS l,
        string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text)) AS text,
        count(*) AS n, count(*) FILTER (role = 'assistant') AS a FROM t GROUP BY conv_id),
g AS (SELECT l, min(conv_id) AS conv_id, min(text) AS text, min(n) AS n, min(a) AS a, count(*) AS copies FROM o GROUP BY l),
p AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, n)) AS k FROM g))
SELECT conv_id, n AS n_turns, a AS n_assistant, copies AS n_copies, text FROM g WHERE l NOT IN (SELECT l FROM p)
"""
