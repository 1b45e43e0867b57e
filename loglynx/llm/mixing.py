"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words; a document's expected copies are
``target / size`` of its source.  Within a source the expected copies are summed
in a fixed order (largest documents first), one random offset in [0, 1) is added,
and a document is emitted once for every integer the running sum crosses.

With documents in order of size the words taken of a source differ from its
target by less than its largest document: the running sum and the count differ by
less than one everywhere, and summation by parts bounds the rest.

Sums are exact integers (expected copies in units of 2**-44), so the result does
not depend on partitioning or reruns.  The prefix sums are taken on three levels
(sizes of a source, hash buckets of a size, rows of a bucket): no task orders a
whole source.

Defined cases: null text has size 0; a null source is a source of its own (ordered
last); sources without words have target 0 and nothing is taken; repeated rows are
documents of their own; null or repeated doc_ids are ordered by their text's hash; an
empty table gives an empty result; other columns pass through unless they bear the
name of a result column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglynx.llm.common import ASCII_WORD, cut

UNIT_BITS = 44
BUCKET_DIGITS = 2  # hex digits of the key hash: 256 buckets of each (source, size)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(ASCII_WORD)), F.lit(0)).cast("long")


def cycling_weights(position: Column, weights: tuple[int, ...]) -> Column:
    """The weight of the source at a 0-based position: ``weights``, repeating."""
    return F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (position % len(weights) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """``sizes`` (source, source_size: one row per source) -> + weight, target.

    Targets share the sum of all sizes by weight; a source stops at ``max_repeat``
    times its size and the excess goes to the others by weight, until none is above.
    That is water-filling: with sources by ``max_repeat * size / weight``, the capped
    ones are a prefix.  The window over all sources holds one row per source.
    """
    pos = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    t = sizes.withColumn("weight", cycling_weights(F.row_number().over(pos) - 1, weights).cast("long"))
    t = t.withColumn("cap", F.col("source_size") * max_repeat)
    # by cap / weight, exactly: caps scaled by a common multiple of the weights
    common = 1
    for w in weights:
        common *= int(w)
    t = t.withColumn("level", F.expr(f"(cap * {common}L) div weight"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("level", F.col("source").isNull(), F.encode("source", "utf-8")).rowsBetween(
        Window.unboundedPreceding, -1)
    t = (t.withColumn("all_words", F.sum("source_size").over(every))
          .withColumn("all_weight", F.sum("weight").over(every))
          .withColumn("cap_before", F.coalesce(F.sum("cap").over(upto), F.lit(0)))
          .withColumn("weight_before", F.coalesce(F.sum("weight").over(upto), F.lit(0))))
    # capped: the level that the words left would reach is not below the cap
    t = t.withColumn("capped", (F.col("all_words") - F.col("cap_before")) * F.col("weight")
                     >= F.col("cap") * (F.col("all_weight") - F.col("weight_before")))
    t = (t.withColumn("cap_sum", F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0)))
          .withColumn("free_weight", F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every), F.lit(0))))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        ((F.col("all_words") - F.col("cap_sum")) * F.col("weight")).cast("double") / F.col("free_weight"))
    return t.select("source", "source_size", "weight", target.alias("target"))


def key_hash(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def offset_units(source: Column, seed: int) -> Column:
    """The source's random offset, in units: the first 44 bits of a hash."""
    digits = F.md5(F.concat(F.coalesce(source, F.lit("")), F.when(source.isNull(), "|null").otherwise("|"), F.lit(str(seed))))
    return F.conv(F.substring(digits, 1, UNIT_BITS // 4), 16, 10).cast("long")


def systematic_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (source, size, key, tie, rate_units, offset_units, ...) -> + copies.

    ``rate_units``: the row's expected copies in units (equal within a source and
    size).  Order within a source: size descending, key, tie.  The row's running sum
    is that of larger sizes, plus that of the size's lower buckets, plus that within
    its bucket; the first two levels are sums per (source, size) and per (source,
    size, bucket) and are joined back.
    """
    dec = "decimal(38,0)"
    keyed = rows.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    per_bucket = keyed.groupBy("source", "size", "bucket").agg(
        F.sum(F.col("rate_units").cast("decimal(20,0)")).cast(dec).alias("units"))
    per_size = per_bucket.groupBy("source", "size").agg(F.sum("units").cast(dec).alias("size_units"))
    above = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    per_size = per_size.select("source", "size", F.coalesce(F.sum("size_units").over(above), F.lit(0)).cast(dec).alias("larger"))
    lower = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.withColumn("lower", F.coalesce(F.sum("units").over(lower), F.lit(0)).cast(dec))
    starts = starts.alias("s").join(per_size.alias("p"), (F.col("s.size") == F.col("p.size")) & F.col("s.source").eqNullSafe(F.col("p.source"))).select(
        F.col("s.source").alias("b_source"), F.col("s.size").alias("b_size"), F.col("s.bucket").alias("b_bucket"),
        (F.col("lower") + F.col("larger")).cast(dec).alias("bucket_start"))
    inside = Window.partitionBy("source", "size", "bucket").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0)
    run = keyed.withColumn("upto", F.sum(F.col("rate_units").cast("decimal(20,0)")).over(inside).cast(dec))
    run = run.join(starts, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size")) & (F.col("bucket") == F.col("b_bucket")))
    one = f"{1 << UNIT_BITS}BD"
    copies = F.expr(f"((bucket_start + upto + offset_units) div {one})"
                    f" - ((bucket_start + upto - rate_units + offset_units) div {one})").cast("long")
    return run.withColumn("copies", copies).drop("b_source", "b_size", "b_bucket", "bucket", "bucket_start", "upto")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 42) -> DataFrame:
    """One narrow row per document: doc_id, source, tie, size, source_size, target, copies, taken."""
    tie = F.xxhash64("text") if "text" in docs.columns else F.lit(0).cast("long")
    narrow = cut(docs.select("doc_id", "source", tie.alias("tie"), word_count(F.col("text")).alias("size")))
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * F.lit(float(1 << UNIT_BITS)))).otherwise(0)
    targets = targets.select(F.col("source").alias("t_source"), "source_size", "target", rate.cast("long").alias("rate_units"),
                             offset_units(F.col("source"), seed).alias("offset_units"))
    rows = narrow.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    out = systematic_copies(rows.withColumn("key", key_hash(F.col("doc_id"))))
    return out.select("doc_id", "source", "tie", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 42) -> DataFrame:
    """The mixed corpus: the columns of ``docs`` plus ``copy`` (0-based; it replaces a column of that name), one row
    for each copy taken.  The plan is narrow; each text that is taken is shuffled once, to meet its number of copies.
    Rows alike in id, source and text take their numbers in the order of a hash of their other columns."""
    plan = plan_mix(docs, weights, max_repeat, seed)
    plan = plan.groupBy("doc_id", "source", "tie").agg(F.sort_array(F.collect_list(F.col("copies").cast("int")), asc=False).alias("m_copies"))
    plan = cut(plan.where("m_copies[0] > 0").select(
        F.col("doc_id").alias("m_doc"), F.col("source").alias("m_source"), F.col("tie").alias("m_tie"), "m_copies"))
    tie = F.xxhash64("text") if "text" in docs.columns else F.lit(0).cast("long")
    same = F.col("d_doc").eqNullSafe(F.col("m_doc")) & F.col("d_source").eqNullSafe(F.col("m_source")) & (F.col("d_tie") == F.col("m_tie"))
    hashed = [F.col("d_row")[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
    # the row as one value: no name of its columns meets a name of the plan
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d_row"), F.col("doc_id").alias("d_doc"),
                       F.col("source").alias("d_source"), tie.alias("d_tie"))
    single = rows.join(plan.where("size(m_copies) = 1"), same).withColumn("n_copies", F.col("m_copies")[0])
    # rows alike: each takes one entry of their group's list
    nth = Window.partitionBy("m_doc", "m_source", "m_tie").orderBy(F.xxhash64(*hashed))  # made behind the join: both joins share one exchange of the texts
    alike = rows.join(plan.where("size(m_copies) > 1"), same).withColumn("n_copies", F.col("m_copies")[F.row_number().over(nth) - 1])
    out = single.unionByName(alike).where("n_copies > 0")
    return out.select(*[F.col("d_row")[c].alias(c) for c in docs.columns if c.lower() != "copy"],
                      F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"))
