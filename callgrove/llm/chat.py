"""Chat formatting with Spark expressions only.

A conversation becomes one text of blocks. Adjacent turns of one role share a block:

    <turn>role<text>first text<more>next text</turn>

Inside roles and texts ``\\`` is written ``\\\\`` and ``<`` is written ``\\l``, so every
``<`` of the output belongs to a mark, and reading back is exact for any text.

Nulls: a null text or role counts as empty; rows without ``conv_id`` form one
conversation. Turns are ordered by ``turn`` (nulls first), then by role and text, so
repeated rows stay and ties have one order. An empty table gives no rows. Columns other
than the four are ignored. A conversation is one value, so it has to fit a Spark string
(2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import table

TURN, TEXT, MORE, END = "<turn>", "<text>", "<more>", "</turn>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    """Inverse of :func:`escaped`: between doubled backslashes only ``\\l`` is left."""
    between = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(between, lambda part: F.replace(part, F.lit("\\l"), F.lit("<"))), "\\")


def _split(text: Column, mark: str) -> Column:
    return F.split(text, mark, -1)


def merged(turns: Column) -> Column:
    """Sorted turn structs to blocks (role, texts), one for each run of equal roles."""
    indexes = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(
        indexes, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])
    )

    def block(start: Column, j: Column, bounds: Column) -> Column:
        stop = F.coalesce(F.get(bounds, j + 1), F.size(turns))
        return F.struct(
            F.get(turns, start)["role"].alias("role"),
            F.transform(F.slice(turns, start + 1, stop - start), lambda t: t["text"]).alias("texts"),
        )

    # The one-element array binds the run starts to a variable, computed once.
    return F.flatten(
        F.transform(F.array(starts), lambda s: F.transform(s, lambda x, j: block(x, j, s)))
    )


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted): one text for each conversation."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    blocks = F.transform(
        merged(F.col("_turns")),
        lambda b: F.concat(
            F.lit(TURN),
            escaped(b["role"]),
            F.lit(TEXT),
            F.array_join(F.transform(b["texts"], escaped), MORE),
            F.lit(END),
        ),
    )
    return grouped.select("conv_id", F.array_join(blocks, "").alias("formatted"))


def read_back(formatted_text: Column) -> Column:
    """Turns (role, text) of a formatted conversation, merged blocks taken apart again."""
    blocks = F.filter(_split(formatted_text, END), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = unescaped(F.substring_index(F.substr(block, F.lit(len(TURN) + 1)), TEXT, 1))
        texts = _split(F.substring_index(block, TEXT, -1), MORE)
        return F.transform(
            texts, lambda text: F.struct(role.alias("role"), unescaped(text).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def loss_texts(turns: Column, role: str = "assistant") -> Column:
    """Texts under the loss mask: those of ``role``, in order."""
    return F.transform(F.filter(turns, lambda t: t["role"] == role), lambda t: t["text"])


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted texts."""
    awkward = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", awkward), (-7, 1, "assistant", awkward)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    texts = formatted(rows.unionByName(added))
    read = texts.select("conv_id", "formatted", read_back(F.col("formatted")).alias("_turns"))
    in_lines = F.transform(
        "_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = F.array_join(loss_texts(F.col("_turns")), "")
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(in_lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, row_number() OVER w AS rn,
    CASE WHEN lag(role) OVER w = role THEN 0 ELSE 1 END AS opens
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(replace(text, '\', ''), '<', '')) AS text_size,
    length(role) + length(role) - length(replace(replace(role, '\', ''), '<', '')) AS role_size
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(text_size + CASE WHEN opens = 1 THEN role_size + 19 ELSE 6 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
