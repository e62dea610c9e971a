"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every source is a queue whose documents stand in shuffled order (by md5 of seed, id and text, so reruns agree). A document's
virtual finish time is the source's tokens up to and with it, divided by the source's target; a second copy finishes one full
pass of the source later. The mix is range-sorted by finish time and truncated at the total budget. The targets add up to the budget and every queue is
served in proportion to its target, so the budget is used up at virtual time 1, for all sources at once; a copy in service then
stays if at least half of it is before. So each source gets its target to within half of one document, and no source pays for
another's long document.

Targets: the ``weights`` repeat over the sources in order of code point, null last; ``share`` of all tokens is divided by weight, but no source gets
more than ``repeats`` times its tokens, and what is cut there is divided among the others until none is above.

Layout: cumulative sums never put a source, or the whole mix, into one task. Positions come from token sums per (source, first
three hex digits of the order key) and a running sum over those at most 4096 rows a source, then a running
sum within each (source, digits). What is collected into one task is one row per source (the mix's configuration).

Defined cases: a null or empty text has size 0 and takes nothing; a null source is a source; a null id orders as an empty one; repeated
rows stand in the queue one by one (their order among each other does not matter, as they are equal). An empty table gives
an empty result. A source without tokens has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, *, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """``totals`` (src, source_size) with the double ``target``.

    The final level x, with target = min(repeats * size, x * weight), is found without iteration: with sources by
    cap / weight, those before the first that stays under its cap are capped."""
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), ((F.row_number().over(Window.orderBy("src")) - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy(F.lit(1))
    ranked = totals.withColumn("w", w).withColumn("cap", F.col("source_size") * repeats)
    order = Window.orderBy(F.col("cap") / F.col("w"), "src")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest)
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("x", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "src", "level"))).over(every)["level"])
    part = F.col("x") * F.col("w")
    return ranked.select("src", "source_size", F.when(F.col("x").isNull() | (part >= F.col("cap")), F.col("cap").cast("double")).otherwise(part).alias("target"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, size, source_size, target, taken (its size times the copies in the mix), finish (virtual
    finish time of its first copy) and source; columns of ``keep`` come along in a
    struct ``row``. The order of the mix is that of
    ``finish``, for copy k of ``finish + (k - 1) * source_size / target``."""
    src = F.coalesce(F.concat(F.lit("0"), F.col(source_col)), F.lit("1"))  # in the sources' order, null last
    rows = docs.select(
        F.col(id_col).alias("id"), src.alias("src"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))).alias("key"),
        *([F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")] if keep else []),
    ).withColumn("slot", F.substring("key", 1, 3))
    sums = rows.groupBy("src", "slot").agg(F.sum("size").alias("n"))
    to = targets(sums.groupBy("src").agg(F.sum("n").alias("source_size")), weights=weights, share=share, repeats=repeats)
    before = sums.withColumn("before", F.sum("n").over(Window.partitionBy("src").orderBy("slot")) - F.col("n")).drop("n")
    within = Window.partitionBy("src", "slot").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    queue = rows.withColumn("upto", F.sum("size").over(within)).join(before.join(to, "src"), ["src", "slot"])
    queue = queue.withColumn("finish", F.when(F.col("target") > 0, (F.col("before") + F.col("upto")) / F.col("target")))
    # targets add up to the budget, so it is used up at time 1; the copy in service then stays if half of it is before
    middle = F.col("finish") - F.col("size") / (F.col("target") * 2)
    kept = [F.coalesce((middle + (F.col("source_size") * k) / F.col("target") <= 1).cast("long"), F.lit(0)) for k in range(repeats)]
    return queue.withColumn("taken", F.col("size") * sum(kept, F.lit(0).cast("long"))).orderBy("finish", "key", "id").select(
        F.col("id").alias(id_col), "size", "source_size", "target", "taken", "finish",
        F.when(F.col("src") != "1", F.expr("substring(src, 2)")).alias(source_col), *(["row"] if keep else []),
    )
