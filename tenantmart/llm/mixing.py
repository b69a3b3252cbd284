"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

* *Targets*: each source's weight gives its share of the mix; a target never
  exceeds ``MOST`` times the source's words, and what is cut off there is shared
  again by weight until no target is above.
* *Blocks*: a source's documents stand in a seeded random order and are cut into
  blocks of ``BLOCK`` words.  A target takes whole passes over the source, then
  documents of the next pass in order, up to the first that does not fit.  From
  there on it goes in rounds: documents of at most half the gap, in order, up to
  the first that does not fit, so that each round more than halves the gap and
  there are as many rounds as a size has bits at most.  When all small ones are in, the first
  document that still fits comes in; none fits after it.  The document nearest to the last gap
  comes in if it brings the sum closer.  That fixes the source's block quota.
* *Tree*: the vector of quotas is split in two again and again.  Each split
  draws, without replacement, how many blocks of each source go left
  (multivariate hypergeometric), so the leaves, one for each output shard, hold
  exact quotas that sum to the sources' quotas.  Only the quotas (sources times
  shards, both bounded) are on the driver.
* *Draw*: a shard takes the next run of each source's permuted blocks, as many
  as its quota, so shards are disjoint; its rows are ordered by a seeded hash.

Sources are ordered by code point, null last (null is a source).  Null texts
have no words.  Ties in the order follow doc_id, so reruns agree; identical
rows are interchangeable.  Sources without words, and empty tables, have
target 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bounded, materialise, position, positional
from .ordering import places

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL = 1.5
MOST = 2.0
BLOCK = 50_000
SHARDS = 64
#: Words that one task of a shard's writers gets.
PART = 2_000_000
SEED = 10
MAX_SOURCES = 100_000


def n_words(text: Column) -> Column:
    """Runs without white space: one more than the runs of space between them."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE}|{SPACE}$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def targets(sizes: dict, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> dict:
    """Target words of each source, given its words."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict = {}
    free, left = [s for s in names if sizes[s]], total * sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > most * sizes[s]]
        if not full:
            out |= {s: unit * weight[s] for s in free}
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        free = [s for s in free if s not in out]
    return {s: float(out.get(s, 0.0)) for s in names}


def split_quotas(quotas, shards: int, seed: int = SEED) -> np.ndarray:
    """(shards, sources) block counts whose columns sum to ``quotas``, rows even to one block."""
    quotas = np.asarray(quotas, dtype=np.int64)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    todo = [(quotas, 0, shards)]
    while todo:
        own, first, n = todo.pop()
        if n == 1:
            out[first] = own
            continue
        half = n // 2
        draws = int(own.sum()) * half // n
        rng = np.random.default_rng([seed, first, n])
        left = rng.multivariate_hypergeometric(own, draws, method="marginals") if len(own) else own
        todo += [(left, first, half), (own - left, first + half, n - half)]
    return out


def _spans(placed: DataFrame, fits: Column, sources: int) -> dict:
    """Per source with documents that don't fit: the runs (first place, end, largest size) that are taken
    besides, and the gap after them.

    Each round reads the candidates that the one before has left: those behind its last place that are
    not above the gap.
    """
    spark = placed.sparkSession
    begun = bounded(placed.where(~fits).groupBy("source").agg(
        F.min("place").alias("end"), F.min_by(F.col("rest") - F.col("start"), "place").alias("gap")), sources, "sources")
    spans: dict = {r["source"]: ([], r["gap"]) for r in begun}
    now = {r["source"]: (r["end"] + 1, r["gap"]) for r in begun}
    left = placed.where(~fits).select("source", F.col("place").alias("at"), "turn", "size")
    while now:
        state = F.broadcast(spark.createDataFrame([(s, *x) for s, x in now.items()], "gap_of string, first long, gap double"))
        left = materialise(left.join(state, left["source"].eqNullSafe(state["gap_of"])).where(
            (F.col("at") >= F.col("first")) & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))).drop("gap_of", "first"), "mix-left")
        run = places(left.where(2 * F.col("size") <= F.col("gap")), "turn", "source", "size", ("at",))
        taken = F.col("start") + F.col("size") <= F.col("gap")
        ends = {r["source"]: r for r in bounded(run.groupBy("source").agg(
            F.min(F.when(~taken, F.col("at"))).alias("end"), F.max("at").alias("top"),
            F.sum(F.when(taken, F.col("size"))).alias("words")), sources, "sources")}
        before, now, through = now, {}, {}
        for s, (first, gap) in before.items():
            r = ends.get(s)
            after = gap - (r["words"] if r else 0)
            if r:
                spans[s] = ([*spans[s][0], (first, r["top"] + 1 if r["end"] is None else r["end"], gap / 2)], after)
            if r and r["end"] is not None:
                now[s] = (r["end"] + 1, after)
            else:
                through[s] = after
        if through:
            rest = F.broadcast(spark.createDataFrame([*through.items()], "rest_of string, after double"))
            fit = left.join(rest, left["source"].eqNullSafe(rest["rest_of"])).where((2 * F.col("size") > F.col("gap")) & (F.col("size") <= F.col("after")))
            for r in bounded(fit.groupBy("source").agg(F.min(F.struct("at", "size")).alias("one")), sources, "sources"):
                s, (at, size) = r["source"], r["one"]
                spans[s] = ([*spans[s][0], (at, at + 1, float(size))], through[s] - size)
        left = left.drop("gap")
    return spans


def mixed(rows: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST,
          block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Each row of ``rows`` (written; doc_id, source, size, mark) with source_size, target and ``drawn``.

    ``drawn`` lists the shard of every copy that the mix takes of the row.
    """
    spark = rows.sparkSession
    found = bounded(rows.groupBy("source").agg(F.sum("size").alias("size")), MAX_SOURCES, "sources")
    sizes = {r["source"]: int(r["size"]) for r in found}
    target = targets(sizes, weights, total, most)
    names = list(target)
    # Whole passes, and the words of the last, partial one; a cap that is met exactly is whole passes.
    passes = {s: int(target[s] / sizes[s] + 1e-9) if sizes[s] else 0 for s in names}
    # Block quotas: the blocks of the whole passes and those of the partial one.
    per_pass = {s: (sizes[s] - 1) // block + 1 if sizes[s] else 1 for s in names}
    partial = {s: min(int((target[s] - passes[s] * sizes[s]) // block) + 1, per_pass[s]) for s in names}
    quotas = [per_pass[s] * passes[s] + partial[s] for s in names]
    ends = np.cumsum(split_quotas(quotas, shards, seed), axis=0).T if names else np.zeros((0, shards))
    # One row for each source with a number for each shard: MAX_SOURCES * SHARDS longs at most.
    goal = F.broadcast(spark.createDataFrame(
        [(s, sizes[s], target[s], passes[s], max(0.0, target[s] - passes[s] * sizes[s]), per_pass[s], partial[s]) for s in names],
        "name string, source_size long, target double, passes int, rest double, per_pass long, partial long"))
    shares = F.broadcast(spark.createDataFrame([(s, [int(x) for x in e]) for s, e in zip(names, ends)], "share_of string, ends array<long>"))
    ordered = rows.withColumn("turn", F.xxhash64(F.lit(seed), "source", "doc_id", "mark"))
    placed = places(ordered, "turn", "source", "size", ("doc_id", "mark"))
    placed = materialise(placed.join(goal, placed["source"].eqNullSafe(goal["name"])).drop("name"), "mix-order")
    fits = F.col("start") + F.col("size") <= F.col("rest")
    # The documents that fit stand before those that don't.  The rest of the order is gone on with, a run at a time.
    spans = _spans(placed, fits, max(len(names), 1))
    state = F.broadcast(spark.createDataFrame(
        [(s, runs, gap) for s, (runs, gap) in spans.items()],
        "span_of string, spans array<struct<first:long,end:long,most:double>>, gap double"))
    placed = placed.join(state, placed["source"].eqNullSafe(state["span_of"]), "left").drop("span_of")
    fills = (F.col("size") > 0) & F.exists("spans", lambda x: (F.col("place") >= x["first"]) & (F.col("place") < x["end"]) & (F.col("size") <= x["most"]))
    placed = placed.withColumn("takes", fits | F.coalesce(fills, F.lit(False)))
    # Last, the document whose size is nearest to the gap, if the target comes nearer by it.
    off = F.abs(F.col("size") - F.col("gap"))
    nearest = bounded(placed.where(~F.col("takes") & (F.col("size") > 0) & (off < F.col("gap"))).groupBy("source").agg(
        F.min(F.struct(off.alias("off"), "place")).alias("best")), MAX_SOURCES, "sources")
    last = F.broadcast(spark.createDataFrame([(r["source"], r["best"]["place"]) for r in nearest], "last_of string, last long"))
    placed = placed.join(last, placed["source"].eqNullSafe(last["last_of"]), "left").drop("last_of")
    placed = placed.withColumn("takes", F.col("takes") | F.coalesce(F.col("place") == F.col("last"), F.lit(False)))
    # A document of the partial pass stands in the block of the words that this pass takes before it.
    placed = placed.withColumn("number", F.least(F.floor(F.col("start") / block), F.col("per_pass") - 1)).withColumn(
        "words", F.when(F.col("takes"), F.col("size")).otherwise(0).cast("long")).withColumnRenamed("place", "at").drop("start", "spans", "gap", "last")
    # read twice by the next step
    placed = materialise(placed, "mix-takes")
    placed = places(placed, "turn", "source", "words", ("at",))
    placed = placed.join(shares, placed["source"].eqNullSafe(shares["share_of"])).drop("share_of")
    number = F.col("number")
    copies = F.col("passes") + F.when(F.col("takes"), 1).otherwise(0)

    def shard_of(copy: Column) -> Column:
        own = F.when(copy < F.col("passes"), number).otherwise(F.least(F.floor(F.col("start") / block), F.col("partial") - 1))
        at = copy * F.col("per_pass") + own
        return F.size(F.filter("ends", lambda end: end <= at)).cast("int")

    drawn = F.when(copies > 0, F.transform(F.sequence(F.lit(0), copies - 1), shard_of)).otherwise(F.array().cast("array<int>"))
    return placed.withColumn("drawn", drawn).select(*rows.columns, "turn", "source_size", "target", "drawn")


def _light(docs: DataFrame) -> DataFrame:
    """What the plan needs of each row; ``mark`` stands for the whole row."""
    own, text, source = (position(docs, c) for c in ("doc_id", "text", "source"))
    rows = positional(docs)
    return materialise(rows.select(
        F.col(own).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), F.xxhash64(*rows.columns).alias("mark")), "mix-rows")


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, drawn."""
    out = mixed(_light(docs), **options)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("drawn")).alias("taken"), "drawn")


def mix(docs: DataFrame, shard_column: str | None = None, shards: int = SHARDS, total: float = TOTAL, **options) -> DataFrame:
    """The mix itself: ``docs``' columns, a row for each copy, shards together and each in random order."""
    own = position(docs, "doc_id")
    rows = positional(docs).withColumn("mark", F.xxhash64(*positional(docs).columns))
    light = _light(docs)
    plan = mixed(light, shards=shards, total=total, **options)
    # Identical rows share a mark: their copies are added up and their text is taken once.
    plan = materialise(plan.groupBy("mark", F.col("doc_id").alias("i")).agg(
        F.flatten(F.collect_list("drawn")).alias("drawn"), F.count(F.lit(1)).alias("same"), F.min("turn").alias("turn")).where(F.size("drawn") > 0), "mix-plan")
    both = rows.withColumnRenamed("mark", "m").join(plan, (F.col("m") == F.col("mark")) & F.col(own).eqNullSafe(F.col("i")))
    both = both.where("same = 1").unionByName(both.where("same > 1").dropDuplicates(["mark", "i"]))
    copies = both.select("*", F.posexplode("drawn").alias("copy", "shard"))
    copies = copies.withColumn("order", F.xxhash64("turn", "copy", "mark"))
    # A shard is dealt to as many tasks as hold PART words each, then every task orders its own.
    words = int(light.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * total)
    parts = words // (shards * PART) + 1
    copies = copies.repartition(shards * parts, "shard", F.pmod("order", F.lit(parts))).sortWithinPartitions("shard", "order")
    names = [*docs.columns]
    picked = [*[f"_c{i}" for i in range(len(names))]]
    if shard_column:
        names.append(shard_column)
        picked.append("shard")
    return copies.select(*picked).toDF(*names)
