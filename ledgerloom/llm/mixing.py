"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue.  Its documents are shuffled once per pass; a document's virtual finish
time is the number of tokens its source has sent by then, divided by the source's target.  The
mix is the order of finish times, cut where the token budget is reached, so at every moment all
sources have sent the same share of their targets.

Shuffle and order are by md5 keys, so reruns agree.  Running totals go over two levels, inside
(source, slice of the shuffle) and over slice totals, then inside slices of virtual time and
over their totals: no source, however large, lands in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import fresh_id, numbered, scratch, written

#: Weights dealt to the sources in code point order.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
ROWS_A_PART = 4096


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, passes: int) -> DataFrame:
    """One row a source: (source, source_size, n_docs, budget, target).

    ``share`` of all tokens is dealt by weight, no target above ``passes`` times its source; what
    a full source can't take is dealt to the rest by weight.  In order of cap / weight, sources
    are full up to the first whose cap isn't below the level (budget - full caps) / open weights.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    per = per.select("*", weight.alias("w"), (F.col("source_size") * passes).alias("cap"))
    per = per.withColumn("full_at", F.col("cap") / F.col("w"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("cap").over(upto), F.lit(0))
    still_open = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(upto), F.lit(0))
    budget = F.sum("source_size").over(everything) * F.lit(float(min(share, passes)))
    per = per.select("*", budget.alias("budget"), ((budget - full) / still_open).alias("level"))
    level = F.first(F.when(F.col("level") <= F.col("full_at"), F.col("level")), ignorenulls=True).over(everything)
    cap = F.col("cap").cast("double")
    target = F.coalesce(F.least(cap, level * F.col("w")), cap)
    return per.select("source", "source_size", "n_docs", "budget", target.alias("target"))


def _running(df: DataFrame, keys: list[str], part: str, order: list[str], out: str) -> DataFrame:
    """``out``: tokens of all rows up to and with this one; totals of parts first, then inside a part."""
    totals = df.groupBy(*keys, part).agg(F.sum("size").alias("part_sum"))
    over = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*keys, part, F.coalesce(F.sum("part_sum").over(over), F.lit(0)).alias("part_before"))
    same = F.col(f"l.{part}") == F.col(f"r.{part}")
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    inside = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = df.alias("l").join(before.alias("r"), same).select("l.*", "part_before")
    return joined.withColumn(out, F.col("part_before") + F.sum("size").over(inside)).drop("part_before", part)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, row: Column | None = None) -> DataFrame:
    """The mix over ``docs`` (doc_id, source, text; more columns don't matter); ``row``: an id of each row, else made here.

    One row for each document and pass, with the document's size, its source's size and target,
    ``finish`` (virtual time), ``mixed`` (tokens of the mix up to its end) and ``taken`` (is this
    copy in the mix).  The taken rows in order of (finish, key) are the mix.

    Null source is a source of its own, the last; null and blank texts have no words, one row and
    are never taken; repeated rows are documents of their own; ties go by key; an empty table
    gives no rows.
    """
    body = F.md5(F.coalesce(F.col("text"), F.lit("")))
    row = fresh_id() if row is None else row
    sized, _ = written(docs.select(row.alias("row"), "doc_id", "source", token_count(F.col("text")).alias("size"), body.alias("body")), "mix-sizes")
    targets, _ = written(source_targets(sized, weights, share, passes), "mix-targets")
    parts = max(1, (targets.agg(F.sum("n_docs")).first()[0] or 0) * passes // ROWS_A_PART)
    digits = max(1, math.ceil(math.log(parts, 16)))

    copies = sized.withColumn("pass", F.explode(F.when(F.col("size") > 0, F.sequence(F.lit(1), F.lit(passes))).otherwise(F.array(F.lit(1)))))
    key = F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("pass").cast("string"), F.col("body")))
    copies = copies.select("row", "doc_id", "source", "size", "pass", key.alias("key"))
    sent = _running(copies.withColumn("part", F.concat(F.col("pass").cast("string"), F.substring("key", 1, digits))), ["source"], "part", ["pass", "key", "row"], "sent")

    t = targets.drop("n_docs").withColumnRenamed("source", "of_source")
    queued = sent.join(t, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    queued = queued.withColumn("finish", F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("sent") / F.col("target")))
    # slices of virtual time: even up to 4, then ever wider ones, so a source of small weight makes few
    late = F.lit(4) + F.log2(F.col("finish") / 4)
    slot = F.floor(F.when(F.col("finish") < 4, F.col("finish")).otherwise(late) * parts)
    slot = F.coalesce(slot, -1 - F.pmod(F.crc32("key"), F.lit(parts)))
    mixed = _running(queued.withColumn("slot", slot), [], "slot", ["finish", "key", "row"], "mixed")
    return mixed.withColumn("taken", F.col("finish").isNotNull() & (F.col("mixed") <= F.col("budget"))).drop("budget", "sent")


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """One row a document: its size, its source's size and target, and ``taken``, the words the mix
    takes of it, repeats counted."""
    taken = F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0)).alias("taken")
    return mix(docs, **how).groupBy("row", "doc_id", "source", "size", "source_size", "target").agg(taken).drop("row")


def take_mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with size, source_size, target and taken, which replace columns of these names."""
    rows, row = numbered(docs, "mix-rows")
    taken = F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0)).alias("taken")
    new = ["size", "source_size", "target", "taken"]
    with scratch(docs.sparkSession) as keep:
        per = mix(rows, row=F.col(row), **how).groupBy("row", "size", "source_size", "target").agg(taken).where("taken > 0")
        per, path = written(per.withColumnRenamed("row", row), "mix-taken")
        keep(path)
    kept = [c for c in docs.columns if c not in new]
    return rows.select(row, *kept).join(per, row).select(*kept, *new)
