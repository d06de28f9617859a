"""Chat formatting with collapse of cumulative snapshots.

Loggers often write a conversation again after each turn. Every conversation gets a rolling hash of
each prefix of its turns; one whose whole hash is a proper prefix of another is a snapshot and goes
by an anti-join, of equal conversations one stays, and what is left is rendered. DataFrame
functions only.

A prefix hash is the running xor of two 64-bit hashes of (place, role, text), so it needs no array
of the turns. The texts take part in one exchange by conversation; the prefix joins move hashes.
Prefixes are reduced to distinct ones on the map side, so a first turn that a third of all
conversations share is a few rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

START, END = "<|im_start|>", "<|im_end|>"


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, role, text, pos (from 1, by turn, then role and text), n (turns of the conversation),
    h1, h2 (hash of turns 1 to pos)."""
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy("turn", "role", "text")
    said = [F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    placed = (turns.filter("conv_id is not null").select("conv_id", "turn", "role", "text")
              .withColumn("pos", F.row_number().over(order)))
    hashed = (placed.withColumn("_1", F.xxhash64("pos", *said)).withColumn("_2", F.xxhash64(F.lit("second"), "pos", *said)))
    rolling = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hashed.select("conv_id", "role", "text", "pos", F.count(F.lit(1)).over(whole).alias("n"),
                         F.bit_xor("_1").over(rolling).alias("h1"), F.bit_xor("_2").over(rolling).alias("h2"))


def maximal_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hashed turns, kept): kept has conv_id, n_copies (equal conversations, itself included) and
    n_snapshots (logged conversations, copies counted, that are proper prefixes of it)."""
    hashed = stored(prefix_hashes(turns), "turns")
    key = ["n", "h1", "h2"]
    whole = (hashed.filter("pos = n").groupBy(*key)
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")))
    prefixes = hashed.filter("pos < n").select(F.col("pos").cast("long").alias("n"), "h1", "h2").distinct()
    kept = whole.join(prefixes, key, "left_anti")
    inner = (hashed.filter("pos < n").join(kept.select("conv_id"), "conv_id", "left_semi")
             .select("conv_id", F.col("pos").cast("long").alias("n"), "h1", "h2"))
    snapshots = (inner.join(whole.select(*key, "n_copies"), key).groupBy("conv_id")
                 .agg(F.sum("n_copies").alias("n_snapshots")))
    kept = (kept.select("conv_id", F.col("n").alias("n_turns"), "n_copies").join(snapshots, "conv_id", "left")
            .withColumn("n_snapshots", F.coalesce("n_snapshots", F.lit(0)).cast("long")))
    return hashed, kept


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per maximal conversation of ``turns`` (conv_id, turn, role, text): conv_id (the
    smallest of equal ones), n_turns, n_copies, n_snapshots, chat (the rendered turns in order).

    Turns are ordered by turn, ties by role and text, nulls first; repeated rows are turns of their
    own. A null role renders as ``unknown``, a null text as an empty one, but both differ from those
    strings when conversations are compared. Rows without conv_id belong to no conversation and are
    left out. An empty table gives an empty result; other columns are ignored. A rendered
    conversation is one string, so it has to fit a row.
    """
    hashed, kept = maximal_conversations(turns)
    line = F.concat(F.lit(START), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(END + "\n"))
    chats = (hashed.join(kept.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines")))
    return (chats.select("conv_id", F.array_join(F.col("lines.line"), "").alias("chat"))
            .join(kept, "conv_id").select("conv_id", "n_turns", "n_copies", "n_snapshots", "chat"))


ORACLE = rf"""
with t as (
  select conv_id, role, text,
         row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as pos
  from conversations where conv_id is not null),
c as (
  select conv_id, count(*) as n, list(struct_pack(r := role, x := text) order by pos) as said,
         string_agg('{START}' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '{END}' || chr(10), '' order by pos) as chat
  from t group by conv_id),
u as (select said, min(conv_id) as conv_id, max(n) as n, count(*) as n_copies from c group by said),
p as (select conv_id, list_slice(said, 1, k) as said from (select conv_id, said, unnest(range(1, n)) as k from u)),
kept as (select * from u where not exists (select 1 from p where p.said = u.said)),
s as (select p.conv_id, sum(u.n_copies) as n_snapshots from p join u on u.said = p.said group by p.conv_id)
select kept.conv_id, kept.n as n_turns, kept.n_copies, cast(coalesce(s.n_snapshots, 0) as bigint) as n_snapshots, c.chat
from kept join c on c.conv_id = kept.conv_id left join s on s.conv_id = kept.conv_id
"""
