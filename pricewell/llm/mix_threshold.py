"""Mixing sources to target weights by hash-threshold histograms.

A source's target is met by taking all of its documents a whole number of times and, for the rest,
those whose hash lies below a threshold. The threshold is found without sorting: the words of each
source are summed by the first 12 bits of the hash, the bucket in which the sum crosses the target
is refined by the next 12 bits, and so on to the last of 60; only rows of that bucket are read
again. The documents taken are then a filter on the hash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, numbered, row_number_of, stored

WEIGHTS, EPOCHS = (5.0, 2.0, 1.0), 3
HASH_BITS, STEP = 60, 12


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def row_hash() -> Column:
    """60 bits: 28 of the MD5 of doc_id as text (nothing where there is none), and 32 of the MD5 of
    the text's digest and the number among equal rows, which part the rows of one doc_id."""
    own = F.md5(F.concat_ws(":", "digest", F.col("nth").cast("string")))
    hexed = F.concat(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 7), F.substring(own, 1, 8))
    return F.conv(hexed, 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size) with target, one row per source.

    Weights go round the sources by code point, null last. The total is shared by weight; a source
    takes at most ``epochs`` times its size and what it can't take is shared again by weight, which
    is a common level: target = least(epochs * size, level * weight). Sources are capped in the
    order of epochs * size / weight. The windows run over one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cap = F.col("source_size") * F.lit(float(epochs))
    ranked = (sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
              .withColumn("cap", cap).withColumn("fill", F.col("cap") / F.col("weight")))
    order = Window.orderBy("fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    levels = ranked.withColumn("level", level)
    # the first source that is not filled by its level sets the level for all that follow
    water = F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", "level"))).over(everything)["level"]
    return (levels.withColumn("water", water)
            .select("source", "source_size",
                    F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight"))).alias("target")))


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` (source, source_size, target) with ``whole`` (times all documents are taken) and
    ``below``: documents of ``rows`` (source, size, u) with u < below are taken once more.

    The words below the threshold are within half of one document of what is left of the target.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = goals.withColumn("whole", whole).select(
        F.col("source").alias("s"), (F.col("target") - F.col("whole") * F.col("source_size")).alias("left_"),
        "whole", F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("prefix"))
    state = stored(state, "state")
    for done in range(STEP, HASH_BITS + 1, STEP):
        shift, before = HASH_BITS - done, HASH_BITS - done + STEP
        inside = rows.filter("size > 0").join(state, rows.source.eqNullSafe(state.s) & (F.shiftright("u", before) == F.col("prefix")))
        hist = (inside.groupBy("s", "left_", "whole", "base", F.shiftright("u", shift).alias("bucket"))
                .agg(F.sum("size").alias("words")))
        run = Window.partitionBy("s").orderBy("bucket")
        cross = (hist.withColumn("to", F.col("base") + F.sum("words").over(run))
                 .filter(F.col("to") > F.col("left_"))
                 .groupBy(F.col("s").alias("t")).agg(F.min(F.struct("bucket", "words", "to")).alias("b")))
        step = state.join(cross, F.col("s").eqNullSafe(F.col("t")), "left")
        # a source whose sum never crosses takes all rows: its prefix lies beyond all hashes
        state = stored(step.select(
            "s", "left_", "whole", F.when(F.col("b").isNull(), F.col("base")).otherwise(F.col("b.to") - F.col("b.words")).alias("base"),
            F.when(F.col("b").isNull(), F.lit(1).cast("long") * 2 ** done).otherwise(F.col("b.bucket")).alias("prefix"),
            F.coalesce("b.words", F.lit(0)).alias("words")), "state")
    below = F.when(F.col("base") + F.col("words") - F.col("left_") < F.col("left_") - F.col("base"), F.col("prefix") + 1).otherwise(F.col("prefix"))
    return goals.join(state.select("s", "whole", below.alias("below")), goals.source.eqNullSafe(F.col("s"))).drop("s")


def hashed_rows(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, source, size, u and ``carried`` of each row of ``docs``, from a copy of the rows, since
    their numbers have to stay."""
    copy = stored(docs.select(*carried, "doc_id", "source", word_count().alias("size"),
                              F.md5(F.coalesce("text", F.lit(""))).alias("digest"), row_number_of()), "rows")
    return numbered(copy, ["doc_id", "digest"]).withColumn("u", row_hash()).drop("digest", "rid", "nth")


def plan_mix(rows: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source of ``rows`` (a stored table with source, size, u): its size, target, and
    what is taken of it."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sizes, weights, epochs), "targets")
    return stored(thresholds(rows, goals), "plan")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size (words), source_size, target
    (both of its source), taken (words the mix takes of it, repeats counted).

    Null texts have no words and count as empty ones. Rows that repeat a doc_id are told apart by
    text and by a number among equal ones, so each is taken or left for itself and targets are met
    by single rows. Reruns agree, since only hashes decide; which of equal rows is taken is open. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = stored(hashed_rows(docs), "sizes")
    plan = plan_mix(rows, weights, epochs).withColumnRenamed("source", "_s")
    return (rows.join(plan, rows.source.eqNullSafe(plan._s))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * copies()).alias("taken")))


def copies() -> Column:
    return F.col("whole") + F.when(F.col("u") < F.col("below"), 1).otherwise(0)


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, with its columns."""
    rows = hashed_rows(docs, F.struct(*docs.columns).alias("row"))
    plan = plan_mix(stored(rows.select("source", "size", "u"), "sizes"), weights, epochs).withColumnRenamed("source", "_s")
    joined = rows.join(plan, rows.source.eqNullSafe(plan._s))
    return (joined.withColumn("_n", F.explode(F.array_repeat(F.lit(1), copies().cast("int"))))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


_WEIGHT = "case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end"
ORACLE = rf"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 7) || substr(md5(concat(md5(coalesce(text, '')), ':',
              row_number() over (partition by doc_id, coalesce(text, '')) - 1)), 1, 8) as bigint) as u
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, {_WEIGHT} as weight, source_size * 3.0::double as cap from s),
f as (select *, cap / weight as fill from w),
l as (select *, ((sum(source_size) over ())::double - coalesce(sum(cap) over (order by fill, source nulls last rows between unbounded preceding and 1 preceding), 0.0))
             / sum(weight) over (order by fill, source nulls last rows between current row and unbounded following) as level from f),
g as (select *, (select arg_min(level, fill) from l where fill > level) as water from l),
t as (select source, source_size, case when water is null then cap else least(cap, water * weight) end as target from g),
e as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from t),
h as (select d.source, u, sum(size) as words from d where size > 0 group by d.source, u),
c as (select h.*, sum(words) over (partition by source order by u) as upto from h),
x as (select e.source, arg_min(struct_pack(u := c.u, words := c.words, upto := c.upto), c.u) as b
      from e join c on c.source is not distinct from e.source
      where c.upto > e.target - e.whole * e.source_size group by e.source),
p as (select e.*, case when x.b is null then 1152921504606846976
                  when x.b.upto - (target - whole * source_size) < (target - whole * source_size) - (x.b.upto - x.b.words) then x.b.u + 1
                  else x.b.u end as below
      from e left join x on x.source is not distinct from e.source)
select d.doc_id, d.size, p.source_size, p.target, cast(d.size * (p.whole + case when d.u < p.below then 1 else 0 end) as bigint) as taken
from d join p on p.source is not distinct from d.source
"""
