"""Chat formatting by prefix-target expansion, in DataFrame functions alone.

Every assistant turn of a conversation becomes an example of its own: all turns before it are its
context and only that reply is trainable. A turn is written as ``<s>[role]`` newline, its text,
``</s>`` and a newline. Strings with a meaning to the template (and to common chat tokenizers) are
escaped inside texts, so a text can't open or close a turn, and can be had back unchanged.

If turns follow the last reply (or there is no reply), one more example holds the whole conversation
with nothing trainable, so that the output has every turn.

An example holds its context, so a conversation's turns meet in one row: that is the size of the
output's own rows, whatever is done before. Examples are exploded by number first and built one at a
time from the turns, so a conversation never holds all its examples at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import scratch_path

TRAINED_ROLE = "assistant"
#: What is escaped in texts, in the order of escaping; undone in reverse order.
ESCAPES = (("&", "&amp;"), ("<s>", "&lt;s>"), ("</s>", "&lt;/s>"), ("[INST]", "&#91;INST]"), ("[/INST]", "&#91;/INST]"))
ROLE_ESCAPES = (("&", "&amp;"), ("]", "&#93;"), ("<", "&lt;"))
END = "</s>\n"


def escape(col: Column, table=ESCAPES) -> Column:
    for plain, coded in table:
        col = F.replace(col, F.lit(plain), F.lit(coded))
    return col


def unescape(col: Column, table=ESCAPES) -> Column:
    for plain, coded in reversed(table):
        col = F.replace(col, F.lit(coded), F.lit(plain))
    return col


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def expand(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, formatted, loss_start, loss_chars, whole``: the trainable span in code points
    of ``formatted``; ``whole`` marks the example that holds every turn.

    Turns are ordered by turn (null first; ties by role, then text). Null role or text is empty. Rows
    with a null conv_id are one conversation. Repeated rows are repeated turns. Other columns are not
    read. No rows: no examples.
    """
    # strings are escaped before the turns meet, each row once
    rows = conversations.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), _text("role").alias("role"), _text("text").alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    head = lambda x: F.concat(F.lit("<s>["), escape(x["role"], ROLE_ESCAPES), F.lit("]\n"))
    convs = convs.select("conv_id", F.transform("t", lambda x: F.struct(
        head(x).alias("head"), escape(x["text"]).alias("body"), (x["role"] == TRAINED_ROLE).alias("trained"))).alias("t"))
    last = F.size("t")
    # numbers of the turns to end an example with; negative: nothing trainable
    ends = F.filter(F.transform("t", lambda x, i: F.when(x["trained"], i + 1).when(i + 1 == last, -last)), lambda k: k.isNotNull())
    each = convs.select("conv_id", "t", F.posexplode(ends).alias("example", "k"))
    upto = F.slice("t", F.lit(1), F.abs("k") - 1)
    own = F.element_at("t", F.abs(F.col("k")))
    before = F.concat(F.array_join(F.transform(upto, lambda x: F.concat(x["head"], x["body"], F.lit(END))), ""), own["head"])
    each = each.select("conv_id", F.col("example").cast("long").alias("example"), before.alias("before"), own["body"].alias("body"),
                       (F.col("k") > 0).alias("trained"), (F.abs("k") == last).alias("whole"))
    return each.select("conv_id", "example", F.concat("before", "body", F.lit(END)).alias("formatted"),
                       F.char_length("before").cast("long").alias("loss_start"),
                       F.when(F.col("trained"), F.char_length("body")).otherwise(0).cast("long").alias("loss_chars"), "whole")


def loss_text(examples: DataFrame) -> Column:
    return unescape(F.substring(F.col("formatted"), F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))


def turns_of(formatted: Column) -> Column:
    """Turns read back from an example: an array of (role, text)."""
    parts = F.split(formatted, END)
    cut = lambda x: F.instr(x, "]\n")
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda x: F.struct(
        unescape(F.substring(x, F.lit(5), cut(x) - 5), ROLE_ESCAPES).alias("role"),
        unescape(F.substring(x, cut(x) + 2, F.char_length(x))).alias("text")))


def op10_chat(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*own.columns).unionByName(own)
    path = scratch_path(spark, "chat")
    expand(talks).write.option("compression", "zstd").parquet(path)
    made = spark.read.parquet(path)
    per = made.select("conv_id", "example", loss_text(made).alias("loss"), F.char_length("formatted").cast("long").alias("n"),
                      F.when(F.col("whole"), turns_of(F.col("formatted"))).alias("turns"))
    per = per.select("conv_id", "example", "loss", "n", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform(
        "turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"))
    out = per.groupBy("conv_id").agg(
        F.max(F.when(F.col("turns_sha256").isNotNull(), F.col("n_turns"))).alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("l"), F.sum("n").alias("formatted_chars"))
    loss = F.array_join(F.transform("l", lambda x: x["loss"]), "")
    return out.select("conv_id", "n_turns", "turns_sha256", F.char_length(loss).cast("long").alias("loss_chars"),
                      F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


OP10_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
f AS (SELECT *, length(replace(replace(replace(role, '&', '&amp;'), ']', '&#93;'), '<', '&lt;')) + 6
              + length(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<s>', '&lt;s>'), '</s>', '&lt;/s>'),
                       '[INST]', '&#91;INST]'), '[/INST]', '&#91;/INST]')) + 5 AS size FROM c),
r AS (SELECT *, sum(size) OVER w AS upto, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS is_last
      FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""
