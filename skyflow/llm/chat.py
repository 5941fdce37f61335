"""Conversations as one training text each, with Spark expressions only.

A block is ``<turn ROLE>TEXT</turn>`` and a line feed. Adjacent turns of one role share a block,
``<next>`` stands between their texts. In roles and texts, backslash, less-than and greater-than are
written as ``\\b``, ``\\l`` and ``\\g``, so the marks of the template are never part of them and the
turns can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn numbers whose rows are sorted together before a conversation is put together.
CHUNK_TURNS = 1_024
#: Blocks, texts of a block and spans whose places are summed together, or cut from one stretch of text.
CHUNK_BLOCKS = 512
CHUNK_TEXTS = 256
LEARNED_ROLE = "assistant"

# Marks of the template and how characters are written inside of it.
OPEN, CLOSE_ROLE, NEXT, CLOSE = "<turn ", ">", "<next>", "</turn>\n"
ESCAPES = [("\\", "\\b"), ("<", "\\l"), (">", "\\g")]


def escaped(text: Column) -> Column:
    """``text`` without characters that the template's marks are made of."""
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given."""
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the escaped turns of each conversation in order.

    Rows are sorted by turn, then role and text; null turns come first. Stretches of turn numbers
    are collected apart, so a long conversation is sorted in parts.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("plain"),
    )
    parts = rows.groupBy("conv_id", F.floor(F.col("turn") / CHUNK_TURNS).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "plain"))).alias("turns")
    )
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "turns"))).alias("parts"))
    flat = whole.select("conv_id", F.flatten("parts.turns").alias("turns"))
    return flat.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(escaped(t["role"]).alias("role"), escaped(t["plain"]).alias("text"))).alias("turns"),
    )


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, blocks): adjacent turns of one role merged, each with its texts."""
    changes = turns.select(
        "conv_id",
        "turns",
        F.expr("filter(sequence(0, size(turns) - 1), i -> i = 0 OR get(turns, i).role <> get(turns, i - 1).role)").alias("starts"),
    )
    return changes.select(
        "conv_id",
        F.expr(
            """transform(starts, (s, k) -> named_struct(
                 'role', get(turns, s).role,
                 'texts', transform(slice(turns, s + 1, coalesce(get(starts, k + 1), size(turns)) - s), t -> t.text)))"""
        ).alias("blocks"),
    )


def _loss_spans() -> Column:
    """Start and end, in characters from 0, of the texts of the learned role in the formatted text."""
    inner = f"""
      transform(sequence(0, cast(floor((size(blocks) - 1) / {CHUNK_BLOCKS}) as int)), c ->
        aggregate(slice(blocks, c * {CHUNK_BLOCKS} + 1, {CHUNK_BLOCKS}),
          named_struct('at', 0L, 'spans', cast(array() as array<struct<start:bigint,end:bigint>>)),
          (acc, b) -> named_struct(
            'at', acc.at + {len(OPEN) + len(CLOSE_ROLE) + len(CLOSE)} + length(b.role)
                  + length(array_join(b.texts, '{NEXT}')),
            'spans', if(b.role <> '{LEARNED_ROLE}', acc.spans, concat(acc.spans,
              flatten(aggregate(
                transform(sequence(0, cast(floor((size(b.texts) - 1) / {CHUNK_TEXTS}) as int)), k ->
                  aggregate(slice(b.texts, k * {CHUNK_TEXTS} + 1, {CHUNK_TEXTS}),
                    named_struct('at', 0L, 'spans', cast(array() as array<struct<start:bigint,end:bigint>>)),
                    (a, t) -> named_struct(
                      'at', a.at + length(t) + {len(NEXT)},
                      'spans', concat(a.spans, array(named_struct('start', a.at, 'end', a.at + length(t))))))),
                named_struct('at', acc.at + {len(OPEN) + len(CLOSE_ROLE)} + length(b.role),
                             'found', cast(array() as array<array<struct<start:bigint,end:bigint>>>)),
                (a, k) -> named_struct(
                  'at', a.at + k.at,
                  'found', concat(a.found, array(transform(k.spans,
                    s -> named_struct('start', a.at + s.start, 'end', a.at + s.end))))),
                a -> a.found)))))))"""
    return F.expr(
        f"""flatten(aggregate({inner},
          named_struct('at', 0L, 'found', cast(array() as array<array<struct<start:bigint,end:bigint>>>)),
          (acc, c) -> named_struct(
            'at', acc.at + c.at,
            'found', concat(acc.found, array(transform(c.spans,
              s -> named_struct('start', acc.at + s.start, 'end', acc.at + s.end))))),
          acc -> acc.found))"""
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, formatted, loss_spans), one per conversation of ``conversations`` (conv_id, turn, role, text).

    ``loss_spans`` are the texts to learn from, those of the role ``assistant``. Null texts and roles
    are empty, rows without conv_id are one conversation, rows with one turn number are in order of
    role and text, repeated rows are turns of their own, other columns are not read.
    """
    blocks = _blocks(_turns(conversations))
    written = F.transform(
        "blocks",
        lambda b: F.concat(F.lit(OPEN), b["role"], F.lit(CLOSE_ROLE), F.array_join(b["texts"], NEXT), F.lit(CLOSE)),
    )
    return blocks.select("conv_id", F.array_join(written, "").alias("formatted"), _loss_spans().alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted text, in order."""
    parts = F.split(formatted, CLOSE)
    ends = F.size(parts) - 1
    return F.flatten(
        F.transform(
            F.slice(parts, 1, ends),
            lambda part: F.transform(
                F.split(F.substr(part, F.instr(part, F.lit(CLOSE_ROLE)) + 1), NEXT),
                lambda text: F.struct(
                    unescaped(
                        F.substr(part, F.lit(len(OPEN) + 1), F.instr(part, F.lit(CLOSE_ROLE)) - len(OPEN) - 1)
                    ).alias("role"),
                    unescaped(text).alias("text"),
                ),
            ),
        )
    )


def report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: digests of the turns and of the learned text, read back from the format."""
    found = format_conversations(conversations)
    read = found.select("conv_id", "formatted", "loss_spans", read_turns(F.col("formatted")).alias("turns"))
    # Spans are cut from stretches of the text, as finding a place in a text means walking to it.
    stretches = F.expr(
        f"""if(size(loss_spans) = 0, cast(array() as array<struct<base:bigint,spans:array<struct<start:bigint,end:bigint>>,text:string>>),
          transform(
            transform(sequence(0, cast(floor((size(loss_spans) - 1) / {CHUNK_TEXTS}) as int)),
              k -> slice(loss_spans, k * {CHUNK_TEXTS} + 1, {CHUNK_TEXTS})),
            spans -> named_struct('base', spans[0].start, 'spans', spans,
              'text', substr(formatted, cast(spans[0].start + 1 as int), cast(element_at(spans, -1).end - spans[0].start as int)))))"""
    )

    def learned_of(stretch: Column) -> Column:
        cut = lambda s: F.substr(stretch["text"], (s["start"] - stretch["base"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        return F.array_join(F.transform(stretch["spans"], lambda s: unescaped(cut(s))), "")

    learned = F.transform(stretches, learned_of)
    digest = read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.array_join(learned, "").alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return digest.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
