"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are fitted: one of target text (the
documents labelled good) and one of the raw corpus (every document).  A
document's importance weight is the ratio of its likelihoods under the two,
kept as a logarithm.  Adding Gumbel noise to the log weights and taking the
``k`` largest draws ``k`` documents without replacement with probabilities in
proportion to the weights.

* At most ``LABELS`` labelled documents are used; ``FITTED`` of them fit the
  target model.  The raw model counts every document.
* n-grams: tokens (runs of word characters, runs of other marks) and pairs of
  neighbouring tokens; a token that repeats the one before it counts as a
  repeat mark.  Hashed with CRC-32 into ``BUCKETS`` counters.
* Counts: every partition sums its own counters, then one row for each
  (model, bucket) is left; at most ``2 * BUCKETS`` numbers reach the driver.
* ``k``: given, as a share of the rows, or (the default) calibrated: the
  number of rows at or above the threshold at which, over those labelled
  documents that the model was not fitted on, lost good
  documents (each counted ``LOSS`` times) and kept bad ones cost least.
* The noise depends on seed, doc_id and text alone, so reruns agree.

Null or empty texts have log weight 0.  Rows with equal keys at the threshold
all stay (repeated rows share a fate).  Without usable labels of both kinds
there is no target and every row stays; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, map_arrow, materialise, position, positional, take, unit_interval

BUCKETS = 1 << 16
#: Bound of the labelled documents that are used (chosen by hash of the id).
LABELS = 50_000
#: Cost of losing a good document, in kept bad ones.
LOSS = 20.0
#: Pseudo-count of every bucket.
SMOOTHING = 2.0
#: Share of the labelled documents that the target model is fitted on; the others set the threshold.
FITTED = 0.7
SEED = 20
TOKEN = re.compile(r"\w+|[^\w\s]+")
WORDS_KEPT = 200_000
REPEAT = zlib.crc32(b"<repeat>")


class Features:
    """Bucket numbers of a text's n-grams; remembers hashes of a bounded number of tokens."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = TOKEN.findall(text) if text else []
        if not tokens:
            return np.empty(0, dtype=np.int64)
        known = self.known
        new = set(tokens).difference(known)
        if new:
            if len(known) + len(new) > WORDS_KEPT:
                known.clear()
                new = set(tokens)
            for t in new:
                known[t] = zlib.crc32(t.encode())
        h = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
        again = np.concatenate(([False], h[1:] == h[:-1]))
        h = np.where(again, np.uint64(REPEAT), h)
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)
        return np.concatenate((h, pairs)).astype(np.int64) & (BUCKETS - 1)


def ngram_counts(docs: DataFrame, text: str, target: str) -> DataFrame:
    """(bucket, raw, target): n-gram counts of all rows, and of those whose ``target`` column is true."""

    def run(batches):
        import pyarrow as pa

        features, counts = Features(), np.zeros((2, BUCKETS), dtype=np.int64)
        waiting: tuple[list, list] = ([], [])

        def add():
            for c, w in zip(counts, waiting):
                if w:
                    c += np.bincount(np.concatenate(w), minlength=BUCKETS)
                    w.clear()

        n = 0
        for batch in batches:
            for t, good in zip(batch.column(0), batch.column(1)):
                own = features(t.as_py())
                waiting[0].append(own)
                if good.as_py():
                    waiting[1].append(own)
                n += len(own)
                if n > BUCKETS * 4:
                    add()
                    n = 0
        add()
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])], names=["bucket", "raw", "target"])

    part = map_arrow(docs.select(text, target), run, "bucket long, raw long, target long")
    return part.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray | None:
    """Log of target over raw probability by bucket; None without target text."""
    rows = bounded(counts, BUCKETS, "n-gram buckets")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return None
    # Both models get the same pseudo-counts, on the target sample's scale: an n-gram that
    # is too rare for the sample to hold is no evidence either way.
    expected = raw * (target.sum() / raw.sum())
    return np.log(target + SMOOTHING) - np.log(expected + SMOOTHING)


def with_log_weight(docs: DataFrame, ratios: np.ndarray, text: str, out: str) -> DataFrame:
    """``docs`` with each text's log importance weight."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(ratios)    # BUCKETS doubles

    def run(batches):
        import pyarrow as pa

        features, own = Features(), shared.value
        for batch in batches:
            weights = [float(own[features(t.as_py())].sum()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights, pa.float64())], names=schema.names)

    return map_arrow(docs, run, schema)


def gumbel(*cols: Column) -> Column:
    return -F.log(-F.log(unit_interval(F.lit(SEED), *cols)))


def calibrated_threshold(keys: list[tuple[float, bool]], loss: float = LOSS) -> float:
    """The key at which lost good rows (times ``loss``) plus kept bad rows are fewest."""
    if not keys:
        return -math.inf
    keys = sorted(keys)
    cost = best = float(sum(not good for _, good in keys))    # all stay
    at = -math.inf
    for i, (key, good) in enumerate(keys):
        cost += loss if good else -1.0                        # the row at i goes too
        nxt = keys[i + 1][0] if i + 1 < len(keys) else math.inf
        if cost < best and nxt > key:
            best, at = cost, (key + nxt) / 2 if nxt < math.inf else nxt
    return at


def top_k_threshold(scored: DataFrame, key: str, k: int, bins: int = 4096) -> float:
    """The ``k``-th largest value of a column, by counting in ever narrower bins.

    Each pass counts all rows in ``bins`` ranges; only the counts reach the driver.
    """
    low, high, n = scored.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if k >= n:
        return -math.inf
    if k <= 0:
        return math.inf
    wanted = k
    while True:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            return low
        part = scored.where(F.col(key).between(low, high))
        bin_of = F.least(F.floor((F.col(key) - low) / width), F.lit(bins - 1))
        rows = sorted(bounded(part.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")), bins, "bins"), reverse=True)
        for r in rows:
            if r["n"] >= wanted:
                low, high = r["low"], r["high"]
                break
            wanted -= r["n"]
        if low == high:
            return low


def scored(docs: DataFrame, labels: DataFrame, share: float | None = None) -> tuple[DataFrame, float]:
    """``docs`` under positional names with ``log_weight`` and ``key``, and the key from which rows stay."""
    own, text = position(docs, "doc_id"), position(docs, "text")
    rows = positional(docs)
    marks = take(labels, "doc_id", "quality").where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = marks.where("quality is not null").withColumn("fitted", unit_interval(F.lit(SEED + 1), F.col("doc_id")) < FITTED)
    n = known.count()
    sample = known.where(unit_interval(F.lit(SEED), F.col("doc_id")) < min(1.0, 0.9 * LABELS / max(n, 1)))
    # At most LABELS ids: small enough to broadcast, so no text is shuffled.
    if sample.count() > LABELS:
        raise ValueError(f"more than {LABELS} labels drawn")
    sample = F.broadcast(sample.select(F.col("doc_id").alias("labelled"), "quality", "fitted"))
    good = F.coalesce((F.col("quality") == 1) & F.col("fitted"), F.lit(False))
    marked = rows.join(sample, rows[own] == F.col("labelled"), "left").withColumn("good", good)
    ratios = log_ratios(ngram_counts(marked, text, "good"))
    noise = gumbel(F.col(own), F.col(text))
    if ratios is None:
        return rows.withColumn("log_weight", F.lit(0.0)).withColumn("key", noise), -math.inf
    out = with_log_weight(rows, ratios, text, "log_weight").withColumn("key", F.col("log_weight") + noise)
    if share is not None:
        keys = materialise(out.select("key"), "quality-keys")
        return out, top_k_threshold(keys, "key", round(share * keys.count()))
    # Only the sample's texts are scored for the threshold; the join runs before Python.
    few = rows.join(sample, rows[own] == F.col("labelled")).where(~F.col("fitted")).select(rows[own].alias("own"), rows[text].alias("text"), "quality")
    few = with_log_weight(few, ratios, "text", "log_weight")
    keys = few.groupBy("own").agg(F.min(F.col("log_weight") + gumbel(F.col("own"), F.col("text"))).alias("key"), (F.max("quality") == 1).alias("good"))
    found = [(r["key"], r["good"]) for r in bounded(keys, LABELS, "labelled documents")]
    return out, calibrated_threshold(found)


def quality(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """Per row: doc_id, log_weight, key, kept."""
    out, threshold = scored(docs, labels, share)
    return out.select(F.col(position(docs, "doc_id")).alias("doc_id"), "log_weight", "key", (F.col("key") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    out, threshold = scored(docs, labels, share)
    return out.where(F.col("key") >= threshold).drop("log_weight", "key").toDF(*docs.columns)
