"""Mixing sources to target word counts by entropy balancing.

Targets
    Sources in code point order (NULL last) weigh ``weights`` in turn and share
    all words; a target stops at ``cap`` times its source's size and the excess
    is reshared by weight until none is above.
Rates
    Among all document rates between 0 and ``cap`` that meet a source's target,
    the ones closest to 1 in relative entropy are ``min(cap, exp(lambda * z))``
    with ``z`` the document's size over the source's mean.  The dual's
    multiplier of every source comes from distributed Newton steps on the log
    of the taken words, bracketed, over the (source, size) histogram.
Copies
    A (source, size) cell's rates become a whole number of copies by cumulative
    rounding in order of size; what a source's words then miss of the target is
    made up with the largest documents that fit, until less than a document is
    left.  A cell deals its copies evenly, the rest to its first documents;
    their ranks are counted in chunks of a bounded share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.llm.common import parallelism, row_numbers, step, word_count

WEIGHTS = (1, 2, 3)
CAP = 3
TOLERANCE = 1e-9
MAX_STEPS = 60
#: Rates are rounded to millionths, so cumulative sums are exact integers.
UNIT = 1_000_000
_RESULT = ("size", "source_size", "target", "rate", "copies", "taken")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (source, source_size) plus ``target``; the water level rises
    until no source is above its cap."""
    ordered = row_numbers(sources.withColumn("__null", F.col("source").isNull()), ["__null", "source"], "__rank", "sources").drop("__null")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("__rank") % len(weights) + 1).cast("int"))
    ordered = step(ordered.withColumn("weight", weight))
    total, weights_sum = ordered.agg(F.sum("source_size"), F.sum("weight")).first()
    level = total / weights_sum if weights_sum else 0.0
    most = cap * F.col("source_size")
    while True:
        full = F.lit(level) * F.col("weight") > most
        taken, rest = ordered.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        higher = (total - (taken or 0)) / rest if rest else level
        if higher <= level:
            break
        level = higher
    return ordered.withColumn("target", F.least(F.lit(level) * F.col("weight"), most.cast("double"))).drop("__rank")


def _rate(lam: Column, z: Column, cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.exp(lam * z))


def multipliers(cells: DataFrame, goal: DataFrame, cap: int = CAP) -> DataFrame:
    """``goal`` (source, source_size, target) plus ``lam`` and ``scale``, from
    ``cells`` (source, size, rows).  lam is NULL where every rate is the cap."""
    scale = cells.groupBy("source").agg((F.sum(F.col("rows") * F.col("size") * F.col("size")) / F.sum(F.col("rows") * F.col("size"))).alias("scale"))
    state = goal.alias("g").join(scale.alias("s"), F.expr("g.source <=> s.source")).select("g.*", "scale")
    state = state.withColumns({"lam": F.when(F.col("target") < cap * F.col("source_size"), F.lit(0.0)),
                               "lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double"), "miss": F.lit(None).cast("double")})
    state = step(state)
    for _ in range(MAX_STEPS):
        z = F.col("size") / F.col("scale")
        tilt = F.exp(F.col("lam") * z)
        words = F.col("rows") * F.col("size")
        sums = (cells.alias("c").join(state.where("lam is not null").alias("s"), F.expr("c.source <=> s.source"))
                .groupBy(F.col("s.source").alias("source"))
                .agg(F.sum(words * F.least(F.lit(float(cap)), tilt)).alias("taken"), F.sum(F.when(tilt < cap, words * z * tilt)).alias("slope")))
        moved = state.alias("s").join(sums.alias("n"), F.expr("s.source <=> n.source"), "left").select("s.*", "taken", "slope")
        miss = F.ln(F.col("taken") / F.col("target"))
        moved = moved.withColumns({"lo": F.when(miss < 0, F.col("lam")).otherwise(F.col("lo")), "hi": F.when(miss > 0, F.col("lam")).otherwise(F.col("hi")),
                                 "miss": F.abs(miss), "__newton": F.col("lam") - miss * F.col("taken") / F.col("slope")})
        inside = F.col("slope").isNotNull() & (F.col("slope") > 0) & (F.col("lo").isNull() | (F.col("__newton") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("__newton") < F.col("hi")))
        outside = F.when(F.col("lo").isNull(), F.col("hi") * 2 - 1).when(F.col("hi").isNull(), F.col("lo") * 2 + 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        moved = moved.withColumn("lam", F.when(F.col("lam").isNull() | (F.col("miss") < TOLERANCE), F.col("lam")).when(inside, F.col("__newton")).otherwise(outside))
        state = step(moved.drop("taken", "slope", "__newton"))
        if (state.agg(F.max("miss")).first()[0] or 0.0) < TOLERANCE:
            break
    return state.drop("lo", "hi", "miss")


def settle(cells: DataFrame, cap: int = CAP) -> DataFrame:
    """``cells`` (source, size, rows, target, __copies) with the copies moved to
    the target: each round, per source, as many copies of the largest size that
    fits the gap as there are."""
    for _ in range(MAX_STEPS):
        gap = cells.groupBy("source").agg((F.round(F.first("target")).cast("long") - F.sum(F.col("__copies") * F.col("size"))).alias("__gap"))
        room = F.when(F.col("__gap") > 0, cap * F.col("rows") - F.col("__copies")).otherwise(F.col("__copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("__gap")) & (room > 0)
        picks = (cells.alias("c").join(gap.alias("g"), F.expr("c.source <=> g.source")).select("c.*", "__gap").where(fits)
                 .groupBy("source").agg(F.max("size").alias("size"), F.first("__gap").alias("__gap")))
        picks = step(picks)
        if picks.isEmpty():
            break
        joined = cells.alias("c").join(picks.alias("p"), F.expr("c.source <=> p.source and c.size = p.size"), "left").select("c.*", "__gap")
        moved = F.signum("__gap") * F.least(F.expr("abs(__gap) div size"), room)
        cells = step(joined.withColumn("__copies", F.when(F.col("__gap").isNotNull(), F.col("__copies") + moved.cast("long")).otherwise(F.col("__copies"))).drop("__gap"))
    return cells


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """All columns of ``docs`` plus ``size`` (words), ``source_size``,
    ``target``, ``rate``, ``copies`` (0 to ``cap``) and ``taken`` (copies * size).

    * A NULL text has size 0; documents of size 0 keep one copy and take nothing.
    * NULL is a source of its own, the last one; a source without words has target 0.
    * Repeated rows are separate documents; NULL ids are spread by their text.
    * Input columns named like an added one are replaced by it.
    * An empty table gives an empty result.
    """
    given = [c for c in docs.columns if c not in _RESULT]
    inner = {c: f"__c{k}" for k, c in enumerate(given)}
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in inner.items()))
    rows = rows.withColumns({"source": F.col(inner[source_col]), "size": word_count(F.col(inner[text_col])),
                             "__key": F.xxhash64(inner[id_col], inner[text_col])})
    cells = step(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("rows")))
    goal = targets(cells.groupBy("source").agg(F.sum(F.col("rows") * F.col("size")).alias("source_size")), weights, cap)
    solved = multipliers(cells.where("size > 0"), goal.where("source_size > 0"), cap)
    known = goal.alias("g").join(solved.alias("s"), F.expr("g.source <=> s.source"), "left").select("g.source", "g.source_size", "g.target", "s.lam", "s.scale")
    total = cells.agg(F.sum("rows")).first()[0] or 0
    chunk_rows = max(1, total // (4 * parallelism(docs.sparkSession)))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("lam").isNull(), float(cap)).otherwise(_rate(F.col("lam"), F.col("size") / F.col("scale"), cap))
    cells = (cells.alias("c").join(known.alias("k"), F.expr("c.source <=> k.source")).select("c.*", "source_size", "target", "lam", "scale")
             .withColumn("__units", F.round(rate * UNIT).cast("long")).drop("lam", "scale"))
    by_size = W.partitionBy("source").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("__before", F.coalesce(F.sum(F.col("rows") * (F.col("__units") % UNIT)).over(by_size), F.lit(0)))
    whole = f"rows * (__units div {UNIT}) + (__before + rows * (__units % {UNIT}) + {UNIT // 2}) div {UNIT} - (__before + {UNIT // 2}) div {UNIT}"
    cells = settle(step(cells.withColumn("__copies", F.expr(whole)).drop("__before")), cap)
    cells = step(cells.withColumns({"__base": F.expr("__copies div rows"), "__extra": F.expr("__copies % rows"),
                                            "__chunks": F.ceil(F.col("rows") / chunk_rows).cast("int")}).drop("rows", "__copies"))
    placed = (rows.alias("d").join(cells.alias("c"), F.expr("d.source <=> c.source and d.size = c.size"))
              .select("d.*", "source_size", "target", "__units", "__base", "__extra", "__chunks")
              .withColumn("__chunk", F.pmod(F.col("__key"), F.col("__chunks").cast("long")).cast("int")))
    counts = placed.where("__chunks > 1").groupBy("source", "size", "__chunk").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = W.partitionBy("source", "size").orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("__first", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    placed = (placed.alias("p").join(counts.alias("n"), F.expr("p.source <=> n.source and p.size = n.size and p.__chunk = n.__chunk"), "left")
              .select("p.*", F.coalesce("__first", F.lit(0)).alias("__first")))
    within = W.partitionBy("source", "size", "__chunk").orderBy("__key", inner[id_col])
    rank = F.col("__first") + F.row_number().over(within) - 1
    copies = F.col("__base") + (rank < F.col("__extra")).cast("long")
    placed = placed.withColumn("copies", copies.cast("int"))
    return placed.select(*(F.col(n).alias(c) for c, n in inner.items()), "size", "source_size", "target",
                         (F.col("__units") / UNIT).alias("rate"), "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of each row, once per copy."""
    return (mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*(F.col(f"`{c}`") for c in columns)))
