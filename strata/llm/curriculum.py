"""Mixing sources to target weights with a time-varying curriculum.

Every source has a weight schedule over training time ``t`` in [0, 1] (piecewise linear). The
integral of a schedule is the source's weight; weights share the whole token budget, a source
that would be repeated more than ``max_epochs`` times stops there and the excess is shared again
by weight. A source's documents are laid end to end in a fixed pseudo-random order, again and
again until its target is reached; its cumulative demand ``D(t) = target * integral(0..t)`` is
inverted to give each of them the training position at which its tokens are due, and
range-sorting by position gives the mix.

Everything is DataFrame code. Running totals inside a source are two-level: the order key is an
MD5 whose first three hex digits name one of 4096 blocks, so a source with a third of all rows is
added up in 4096 groups, and the second level sees at most 4096 rows per source.

Defined cases: a null text has size 0; documents of size 0 are never taken; a null source is a
source of its own, last in code-point order; an empty table gives an empty mix; repeated rows
are separate documents (equal order keys mean equal id and text, so their order is immaterial
and reruns agree); further columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stage, text_or_empty, word_count

# Weight by source class (sources take the classes in turn) and the relative weight of the class
# at t = 0, 0.5 and 1. Each schedule integrates to 1, so it moves a source's tokens in time
# without changing its share.
CLASSES = ((5, (1.5, 1.0, 0.5)), (2, (0.75, 1.25, 0.75)), (1, (0.5, 1.0, 1.5)))
MAX_EPOCHS = 3


def source_targets(sizes: DataFrame, classes=CLASSES, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(source, size)`` → one row per source: ``source, source_size, class, target``.

    Repeated re-sharing ends where sources below some level of size / weight stop at
    ``max_epochs`` times their size and the others share the rest by weight; with the sources in
    that order the level is found in one pass over the (one row per source) table."""
    per = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w).cast("long") for w, _ in classes])
    table = per.withColumn("class", (F.row_number().over(by_name) - 1) % len(classes))
    table = table.withColumn("weight", F.get(weights, F.col("class")))
    table = table.withColumns({"cap": F.col("source_size") * max_epochs,
                               "fill": F.col("source_size") / F.col("weight")})
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    not_fuller = Window.orderBy("fill").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    table = table.withColumns({
        "left": F.sum("source_size").over(everything) - F.sum("cap").over(everything)
        + F.sum("cap").over(not_fuller),
        "left_weight": F.sum("weight").over(not_fuller)})
    big = "decimal(38,0)"
    free = F.col("cap").cast(big) * F.col("left_weight").cast("decimal(9,0)") >= \
        F.col("left").cast(big) * F.col("weight").cast("decimal(9,0)")
    level = F.min(F.when(free, F.struct("fill", "left", "left_weight"))).over(everything)
    share = (F.col("level.left") * F.col("weight")).cast("double") / F.col("level.left_weight")
    return (table.withColumns({"free": free, "level": level})
            .select("source", "source_size", "class",
                    F.when(F.col("free"), share).otherwise(F.col("cap").cast("double")).alias("target")))


def _position(share: Column, cls: Column, classes) -> Column:
    """Training time at which ``share`` of a source's demand is reached: the inverse of the
    integral of a piecewise linear schedule with knots 0, 0.5 and 1."""
    def segment(y, u, v):  # u x + (v - u) x^2 = y
        return 2 * y / (u + F.sqrt(F.greatest(u * u + 4 * (v - u) * y, F.lit(0.0))))

    t = F.lit(None).cast("double")
    for k, (_, (a, b, c)) in enumerate(classes):
        half = (a + b) / 4
        t = F.when(cls == k, F.when(share <= half, segment(share, a, b))
                   .otherwise(0.5 + segment(share - half, b, c))).otherwise(t)
    return F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))


def assign(docs: DataFrame, classes=CLASSES, max_epochs: int = MAX_EPOCHS,
           whole_documents: bool = False, carry_text: bool = True) -> DataFrame:
    """``docs`` (without its text if that need not be carried) with a struct column ``_mix``: ``size, source_size, target, taken, positions``
    (training positions of the passes in which the document is taken, ascending).

    One document per source at most is cut, where the last pass reaches the target; with
    ``whole_documents`` it is taken whole if at least half of it is due, else left out."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                         text_or_empty()).cast("binary"))
    keyed = docs.withColumns({"_mix_size": word_count(), "_mix_key": key})
    keyed = stage(keyed if carry_text else keyed.drop("text"), "mix-sizes")
    sizes = (keyed.select(F.col("source").alias("source"), F.col("_mix_size").alias("size"),
                          F.substring("_mix_key", 1, 3).alias("block"))
             .groupBy("source", "block").agg(F.sum("size").alias("size")))
    targets = source_targets(sizes, classes, max_epochs)
    up_to = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("start", F.coalesce(F.sum("size").over(up_to), F.lit(0)).cast("long"))
    plan = starts.join(targets.withColumnRenamed("source", "t_source"),
                       F.col("source").eqNullSafe(F.col("t_source"))).select(
        F.struct("source", "block", "start", "source_size", "target", "class").alias("_mix_plan"))

    before = Window.partitionBy("source", F.substring("_mix_key", 1, 3)).orderBy("_mix_key").rowsBetween(
        Window.unboundedPreceding, -1)
    runs = keyed.withColumn("_mix_before", F.coalesce(F.sum("_mix_size").over(before), F.lit(0)).cast("long"))
    rows = runs.join(plan, runs["source"].eqNullSafe(F.col("_mix_plan.source"))
                     & (F.substring("_mix_key", 1, 3) == F.col("_mix_plan.block")))

    size, p = F.col("_mix_size"), (lambda c: F.col(f"_mix_plan.{c}"))
    budget = F.round(p("target")).cast("long")
    due, when = [], []
    for epoch in range(max_epochs):
        start = p("source_size") * epoch + p("start") + F.col("_mix_before")
        words = F.greatest(F.least(budget - start, size), F.lit(0).cast("long"))
        if whole_documents:
            words = F.when(words * 2 >= size, size).otherwise(F.lit(0).cast("long"))
        due.append(words)
        share = F.try_divide(start.cast("double"), p("target"))
        when.append(F.when(words > 0, _position(share, p("class"), classes)))
    taken = due[0]
    for words in due[1:]:
        taken = taken + words
    carried = [c for c in docs.columns if carry_text or c != "text"]
    return rows.select(*[F.col(f"`{c}`") for c in carried], F.struct(
        size.alias("size"), p("source_size").alias("source_size"), p("target").alias("target"),
        taken.alias("taken"), F.array_compact(F.array(*when)).alias("positions"),
        F.col("_mix_key").alias("key")).alias("_mix"))


def assignments(docs: DataFrame, classes=CLASSES, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document in order of its first training position, documents that the mix does
    not take last: ``doc_id, size, source_size, target, taken``."""
    rows = assign(docs.select("doc_id", "source", "text"), classes, max_epochs, carry_text=False)
    return (rows.orderBy(F.get("_mix.positions", F.lit(0)).asc_nulls_last(), "_mix.key")
            .select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken"))


def mixed(docs: DataFrame, classes=CLASSES, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: the rows of ``docs``, once for each pass that takes them, whole, in order
    of training position. Positions are found on row numbers, keys and sizes alone; the rows
    join them once and are sorted once."""
    held = stage(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-rows")
    rows = assign(held.select("_mix_row", "doc_id", "source", "text"), classes, max_epochs, whole_documents=True,
                  carry_text=False)
    picks = rows.select(F.col("_mix_row").alias("_mix_pick"), F.col("_mix.key").alias("_mix_key"),
                        F.explode("_mix.positions").alias("_mix_position"))
    return (held.join(picks, F.col("_mix_row") == F.col("_mix_pick")).orderBy("_mix_position", "_mix_key")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
