"""Prefix-target expansion of conversations, with DataFrame functions only.

A turn is ``<s>[role]text</s>``. Inside roles and texts the characters of the marks are escaped, so no control string
can come from a text and the format is reversible: backslash to ``\\s``, ``<`` to ``\\l``, ``[`` to ``\\b``, ``]`` to ``\\r``.
Every assistant turn gives one example: all turns before it as context, and its reply as the only trainable part
(``loss_start``, ``loss_end``: code points of the escaped reply, its end mark excluded). If a conversation does not end
with an assistant turn, a last example holds the whole conversation and no loss, so no turn is lost.

Defined results: a null text or role is empty; turns are ordered by turn (null first), then role and text, so equal
rows are turns of their own; a null conv_id is a conversation; an empty table has no example. By its nature the
output of one conversation grows with the square of its turns; its turns, not its examples, are gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwright.llm._shared import documents

ESCAPES = [("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("]", "\\r")]
PROBE = "</s>[INST] ok [/INST]"

ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(9 + length(role) + length(text)
      + length(regexp_replace(role, '[^\\<\[\]]', '', 'g')) + length(regexp_replace(text, '[^\\<\[\]]', '', 'g'))) OVER w AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, CAST(max(n) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""


def escaped(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescaped(c: Column) -> Column:
    for plain, code in ESCAPES[::-1]:
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def examples(conversations: DataFrame, target: str = "assistant") -> DataFrame:
    """conv_id, example (number in its conversation, from 0), formatted, loss_start, loss_end, whole (the last example)."""
    empty = F.lit("")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    marked = rows.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(F.lit("<s>["), escaped(t["role"]), F.lit("]"), escaped(t["text"]), F.lit("</s>"))).alias("parts"),
        F.transform("turns", lambda t: t["role"] == target).alias("trains"),
        F.transform("turns", lambda t: F.length(escaped(t["text"]))).alias("sizes"),
    )
    last = F.size("parts") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda k: F.get("trains", k) | (k == last))
    each = marked.select("conv_id", "parts", "trains", "sizes", F.posexplode(ends).alias("example", "k"))
    return (
        each.withColumn("formatted", F.array_join(F.slice("parts", F.lit(1), F.col("k") + 1), ""))
        .withColumn("loss_end", F.when(F.get("trains", F.col("k")), F.length("formatted") - 4))
        .select("conv_id", "example", "formatted", (F.col("loss_end") - F.get("sizes", F.col("k"))).alias("loss_start"), "loss_end", (F.col("k") == F.size("parts") - 1).alias("whole"))
    )


def parsed(formatted: Column) -> Column:
    """Array of (role, text) read back from formatted text."""
    parts = F.split(formatted, "</s>")
    body = lambda p: F.substr(p, F.lit(5))  # noqa: E731  after <s>[
    turn = lambda p: F.struct(unescaped(F.substring_index(body(p), "]", 1)).alias("role"), unescaped(F.substr(body(p), F.instr(body(p), "]") + 1)).alias("text"))
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def digests(conversations: DataFrame) -> DataFrame:
    """Per conversation the digest of what its examples hold, read from their text and loss mask alone."""
    out = examples(conversations)
    loss = unescaped(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = out.select("conv_id", "example", "whole", F.when(F.col("loss_end").isNotNull(), loss).alias("loss"), F.when(F.col("whole"), parsed(F.col("formatted"))).alias("turns"), F.length("formatted").alias("chars"))
    held = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))), lambda x: x["loss"]), "")
    done = read.groupBy("conv_id").agg(F.max("turns").alias("turns"), held.alias("held"), F.sum("chars").alias("formatted_chars"))
    line = F.lit("\n")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(said, "utf-8"), 256).alias("turns_sha256"), F.length("held").cast("long").alias("loss_chars"), F.sha2(F.encode("held", "utf-8"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digests(table.unionByName(probe))
