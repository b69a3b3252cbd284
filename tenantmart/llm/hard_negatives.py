"""Hard negatives by segment summaries.

An anchor's positives are its nearest rows of the same label; the negatives of a
positive are the nearest rows of other labels whose score lies in a band below the
positive's.  Scores are inner products of integer vectors.

* *Summaries*: each vector is cut into 1, 4, 16, ... segments, each level within the
  segments of the one before.  Of each segment are stored the mean ``m`` and the
  deviation ``d`` (length of what is left without the mean).  By Cauchy and Schwarz
  a score lies between the sums of ``len m m' - d d'`` and ``len m m' + d d'``.
* *Blocks*: rows are packed into blocks of about ``ROWS`` vectors with their
  summaries, anchors into blocks of about ``ANCHORS``.  Row blocks are dealt to groups,
  every anchor block goes to each group, and a sort-merge join on the group pairs the
  blocks: neither side is held by the driver or whole by a task.
* *Filter*: within a pair of blocks, the bounds of one level after the other decide
  which rows can still be among an anchor's best: those whose upper bound reaches the
  worst lower bound that is known to be enough (of the pairs before, too) and whose band
  can hold the score.  Only what is left after the finest level is scored exactly.
* A task keeps the best of one anchor block at a time; a window over what all tasks
  found takes the first ones overall.

Bounds are widened by more than their rounding error, so that results are exact.

Rows without id, label or vector, or with a null or non-finite component, take no
part.  Ties follow the id; equal rows are different rows, and a repeated
anchor gives its results again.  A shorter vector counts as padded with zeros.
Vectors whose scores could pass 2 ** 58 are an error.  Empty tables, anchors without
positives and positives without negatives give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_arrow, materialise, take

SCALE = 256
ROWS = 4096
ANCHORS = 1024
#: Row blocks that one group of a large table has, and groups of a small one.
GROUP = 64
#: Anchors whose bounds against a row block are held at once.
CHUNK = 256
#: Share of pairs left from which a whole block is multiplied instead of single pairs.
DENSE = 0.1
#: Widening of the bounds as a share of the product of the vectors' lengths.
SLACK = 1e-5
#: Stands for a missing score.
NONE = np.iinfo(np.int64).min
PACKED = "block long, n int, rid binary, id binary, label binary, x binary, parts binary, bands binary"


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows that take part; components become ``floor(256 x)``."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    own = take(rows, "vec_id", "label", "embedding").where("vec_id is not null and label is not null and embedding is not null")
    return own.where(fine).select("vec_id", "label", F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE)).alias("x"))


def with_odd_labels(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Every so many ids get the next label."""
    changed = (F.col("label") + 1) % labels
    return rows.withColumn("label", F.when(F.col("vec_id") % every == 0, changed).otherwise(F.col("label")))


# -- one block -----------------------------------------------------------------------------------
def levels(dims: int) -> list[np.ndarray]:
    """Segment borders of each level: 1, 4, 16, ... segments, each level within the one before."""
    out, n = [], 1
    while n < dims or not out:
        out.append(np.arange(n + 1) * dims // n)
        n *= 4
    return out


def summaries(x: np.ndarray) -> np.ndarray:
    """Per vector and level: scaled means and deviations of its segments."""
    out, x = [], x.astype(np.float64)
    for edges in levels(x.shape[1]):
        size = np.diff(edges)
        mean = np.add.reduceat(x, edges[:-1], axis=1) / size if x.shape[1] else np.zeros((len(x), 1))
        rest = x - np.repeat(mean, size, axis=1)
        out += [mean * np.sqrt(size), np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1) if x.shape[1] else np.zeros((len(x), 1)))]
    return np.concatenate(out, axis=1).astype(np.float32)


@dataclass
class Block:
    rid: np.ndarray
    id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    parts: list          # (means, deviations) by level
    length: np.ndarray
    bands: np.ndarray    # anchors only: their positives' scores, NONE where there is none

    @classmethod
    def unpack(cls, row: dict, prefix: str, dims: int, dtype: str, exact: str) -> "Block":
        def of(name, kind, wide=None):
            flat = np.frombuffer(row[f"{prefix}{name}"], kind)
            return flat if wide is None else flat.reshape(row[f"{prefix}n"], -1) if wide < 0 else flat.reshape(row[f"{prefix}n"], wide)
        sizes = [len(e) - 1 for e in levels(dims)]
        flat, at, parts = of("parts", np.float32, 2 * sum(sizes)), 0, []
        for n in sizes:
            parts.append((flat[:, at:at + n], flat[:, at + n:at + 2 * n]))
            at += 2 * n
        length = np.sqrt(parts[0][0][:, 0].astype(np.float64) ** 2 + parts[0][1][:, 0].astype(np.float64) ** 2)
        bands = of("bands", np.int64, -1) if row.get(f"{prefix}bands") else np.empty((row[f"{prefix}n"], 0), dtype=np.int64)
        return cls(of("rid", np.int64), of("id", np.int64), of("label", np.int64), of("x", dtype, dims).astype(exact), parts, length.astype(np.float32), bands)


def products(alive: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the pairs that are alive; the other entries have no meaning."""
    if alive.mean() > DENSE:
        return a @ b.T
    out = np.zeros(alive.shape, dtype=a.dtype)
    i, j = np.nonzero(alive)
    out[i, j] = np.einsum("ij,ij->i", a[i], b[j])
    return out


def bounds(alive, a: Block, ai, b: Block, bi, level: int):
    means, spread = (products(alive, a.parts[level][k][ai], b.parts[level][k][bi]) for k in (0, 1))
    spread = spread + np.outer(a.length[ai], b.length[bi]) * np.float32(SLACK) + np.float32(1e-3)
    return means - spread, means + spread


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row."""
    return np.partition(values, -k, axis=1)[:, -k] if values.shape[1] >= k else np.full(len(values), -np.inf)


class Best:
    """The first ``k`` (score down, id up) for each of ``n`` keys so far."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, -np.inf)
        self.key, self.score, self.id, self.rid = (np.empty(0, dtype=np.int64) for _ in range(4))

    def add(self, key, score, id, rid):
        key, score, id, rid = (np.concatenate(p).astype(np.int64) for p in zip((self.key, self.score, self.id, self.rid), (key, score, id, rid)))
        order = np.lexsort((rid, id, -score, key))
        key = key[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        order, key, place = order[place < self.k], key[place < self.k], place[place < self.k]
        self.key, self.score, self.id, self.rid = key, score[order], id[order], rid[order]
        last = place == self.k - 1
        self.floor[key[last]] = self.score[last]


def add_positives(best: Best, a: Block, b: Block) -> None:
    for label in np.intersect1d(a.label, b.label):
        bi = np.flatnonzero(b.label == label)
        own = np.flatnonzero(a.label == label)
        for ai in (own[i:i + CHUNK] for i in range(0, len(own), CHUNK)):
            alive, floor = a.rid[ai][:, None] != b.rid[bi], best.floor[ai]
            for level in range(len(a.parts)):
                low, high = bounds(alive, a, ai, b, bi, level)
                floor = np.maximum(floor, kth(np.where(alive, low, -np.inf), best.k))
                alive &= high >= floor[:, None]
            if alive.any():
                exact = products(alive, a.x[ai], b.x[bi])
                floor = np.maximum(floor, kth(np.where(alive, exact, -np.inf), best.k))
                i, j = np.nonzero(alive & (exact >= floor[:, None]))
                best.add(ai[i], exact[i, j], b.id[bi[j]], b.rid[bi[j]])


def add_negatives(best: Best, a: Block, b: Block, low_share: tuple, high_share: tuple) -> None:
    """``low_share`` and ``high_share`` of a positive's score, as fractions, border its band."""
    (ln, ld), (hn, hd) = low_share, high_share
    width, bi = a.bands.shape[1], np.arange(len(b.id))
    for ai in (np.arange(i, min(i + CHUNK, len(a.id))) for i in range(0, len(a.id), CHUNK)):
        alive = a.label[ai][:, None] != b.label
        scores = a.bands[ai]
        band = np.where(scores == NONE, np.nan, scores)
        floors = best.floor.reshape(-1, width)[ai].copy()
        for level in range(len(a.parts)):
            low, high = bounds(alive, a, ai, b, bi, level)
            left = np.zeros_like(alive)
            for w in range(width):
                p = band[:, w, None]
                sure = alive & (ld * low >= ln * p) & (hd * high <= hn * p)
                floors[:, w] = np.maximum(floors[:, w], kth(np.where(sure, low, -np.inf), best.k))
                left |= (ld * high >= ln * p) & (hd * low <= hn * p) & (high >= floors[:, w, None])
            alive &= left
        if not alive.any():
            continue
        exact = products(alive, a.x[ai], b.x[bi])
        for w in range(width):
            p = np.where(scores == NONE, 0, scores)[:, w, None].astype(exact.dtype)
            inside = alive & (scores[:, w, None] != NONE) & (ld * exact >= ln * p) & (hd * exact <= hn * p)
            floor = np.maximum(floors[:, w], kth(np.where(inside, exact, -np.inf), best.k))
            i, j = np.nonzero(inside & (exact >= floor[:, None]))
            best.add(ai[i] * width + w, exact[i, j], b.id[j], b.rid[j])


# -- packing and pairing ---------------------------------------------------------------------------
def _number(dims: int, peak: int) -> tuple[str, str]:
    """Types of stored vectors and of exact scores."""
    top = dims * peak * peak
    if top >= 1 << 58:      # bands are compared by small multiples of a score
        raise ValueError("scores of these vectors, or their multiples, do not fit a long")
    stored = next(t for t, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if peak < 1 << bits)
    return stored, "float64" if top < 1 << 46 else "int64"


def packed(rows: DataFrame, size: int, dims: int, dtype: str, most: int, bands: int = 0) -> DataFrame:
    """Blocks of about ``size`` of the ``most`` rows; a row's block depends on its rid alone."""
    n = max(1, -(-most // size))

    def run(table):
        import pyarrow as pa

        x = np.zeros((table.num_rows, dims), dtype=dtype)
        lists = table.column("x").combine_chunks()
        lengths = np.asarray(lists.value_lengths())
        x[np.repeat(np.arange(len(x)), lengths), np.arange(len(lists.flatten())) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.asarray(lists.flatten())
        own = np.full((table.num_rows, bands), NONE)
        if bands:
            for i, found in enumerate(table.column("bands").to_pylist()):
                own[i, :len(found)] = found
        cell = [np.asarray(table.column(c)).astype("<i8").tobytes() for c in ("rid", "vec_id", "label")]
        values = [table.column("block")[0].as_py(), table.num_rows, *cell, x.tobytes(), summaries(x).tobytes(), own.tobytes()]
        return pa.table([pa.array([v], t) for v, t in zip(values, [pa.int64(), pa.int32()] + [pa.binary()] * 6)], names=[c.split()[0] for c in PACKED.split(", ")])

    cells = ["rid", "vec_id", "label", "x"] + (["bands"] if bands else [])
    blocks = rows.select(F.pmod(F.xxhash64("rid"), F.lit(n)).alias("block"), *cells)
    return materialise(blocks.groupBy("block").applyInArrow(run, PACKED), "negatives-blocks")


def paired(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """Every anchor block with every row block, group by group.  The anchors' file is
    small, but each group gets a copy of it: the planner, which only sees the file,
    must not broadcast the copies."""
    blocks = rows.count()
    groups = max(1, min(blocks, max(GROUP, blocks // GROUP)))
    left = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns], F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("deal"))
    right = rows.select(*[F.col(c).alias(f"b_{c}") for c in rows.columns], F.pmod("block", F.lit(groups)).cast("int").alias("deal"))
    return left.join(right.hint("merge"), "deal").drop("deal", "b_bands")


def searched(pairs: DataFrame, dims: int, dtype: str, exact: str, width: int, k: int, add) -> DataFrame:
    """(rid, key, id, own, score): what ``add`` finds in each task, first ``k`` for each anchor and key."""
    def run(batches):
        import pyarrow as pa

        def found():
            at = best.key // width
            return pa.RecordBatch.from_arrays([pa.array(v) for v in (a.rid[at], (best.key % width).astype(np.int32), a.id[at], best.id, best.rid, best.score)],
                                              names=["rid", "key", "anchor_id", "id", "own", "score"])
        now = a = best = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["a_block"] != now:
                    if best is not None:
                        yield found()
                    now, a = row["a_block"], Block.unpack(row, "a_", dims, dtype, exact)
                    best = Best(len(a.id) * width, k)
                add(best, a, Block.unpack(row, "b_", dims, dtype, exact))
        if best is not None:
            yield found()

    return map_arrow(pairs, run, "rid long, key int, anchor_id long, id long, own long, score long")


def firsts(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("rid", "key").orderBy(F.desc("score"), "id", "own")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   low: tuple = (1, 2), high: tuple = (19, 20), block: int = ROWS, anchor_block: int = ANCHORS) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and x (integers); ``low`` and ``high`` border a positive's band as
    fractions of its score.
    """
    rows = materialise(rows.select("vec_id", F.col("label").cast("long").alias("label"), "x").withColumn("rid", F.monotonically_increasing_id()), "negatives-rows")
    anchors = rows.where(is_anchor)
    n, dims, peak = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))).first()
    dims, n_anchors = max(dims or 0, 1), anchors.count()
    stored, exact = _number(dims, peak or 0)
    blocks = packed(rows, block, dims, stored, n)
    near = searched(paired(packed(anchors, anchor_block, dims, stored, n_anchors), blocks), dims, stored, exact, 1, positives, add_positives)
    near = materialise(firsts(near, positives), "negatives-positives")
    # the k-th positive's band stands at place k - 1
    bands = near.groupBy("rid").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]).alias("bands"))
    asked = packed(anchors.join(bands, "rid"), anchor_block, dims, stored, n_anchors, positives)

    def add(best, a, b):
        add_negatives(best, a, b, low, high)

    far = firsts(searched(paired(asked, blocks), dims, stored, exact, positives, negatives, add), negatives)
    positive = near.select("rid", (F.col("rank") - 1).alias("key"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(positive, ["rid", "key"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE_SQL = f"""
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)) AS x
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v::DOUBLE))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
    SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
