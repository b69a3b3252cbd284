"""Toxicity by a factorization machine over hashed terms.

* *Terms*: lower-cased words and their beginnings of 4 to 8 letters, hashed with
  CRC-32 into ``BUCKETS`` buckets.
* *Passages*: a text is cut into passages of ``SPAN`` words, each beginning
  ``STEP`` words after the one before, so that what is read together stands together.
  A passage is the set of its terms; the text's score is that of its worst passage.
* *Machine*: a passage's log odds are ``b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``.
  The second sum learns pairs, such as an insult with the group that it is said of,
  of which each alone is harmless; additive weights can't tell these.
* *Scales*: ``x_i`` is a fixed number for each term, from how sure its share of toxic
  documents differs from the others' (in standard errors) and how often it occurs, so that
  rare chance words can't learn a training text by heart.  Terms in fewer than ``SEEN``
  training documents are left out.
* *Training*: adaptive gradient steps over the worst passage of each training document,
  chosen anew in each round; the first choice follows the terms' log odds.  It works on a
  bounded sample: at most ``TOXIC`` toxic and ``CLEAN`` other documents, chosen by hash of
  their id, of at most ``LONG`` characters each.  Spark tasks make their terms, one task trains, and the
  intercept is corrected for the shares that the sample has.  Every document is scored whole.

A document's labels are learned from only if the CRC-32 of its id is not 2 modulo 4 (the
rest is held out).  A null or empty text is one empty passage; its score is the intercept's.  Null
labels count as none, of repeated labels the larger holds.  Repeated documents are
learned from once and scored each.  Without labels of both kinds every score is the share of
toxic labels, or 0.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, map_arrow, materialise, take, unit_interval

BUCKETS = 1 << 18
FACTORS = 8
SPAN, STEP = 128, 64
BEGINNINGS = range(4, 9)
WORD = re.compile(r"\w+")
#: Bounds of the training sample.
TOXIC, CLEAN, LONG = 4_000, 6_000, 20_000
SEEN = 3
ROUNDS = 5
#: Documents of one step, and step widths of single weights and of factors.
STEP_DOCS, RATE, PAIR_RATE = 64, 0.2, 0.3
SHRINK = 1e-3
#: Standard errors from which a term has its full scale, and a frequent term's as a share of its count's root.
SURE, COMMON = 8.0, 0.1
CUT = 0.3
SEED = 13
WORDS_KEPT = 200_000
CHUNK = 400_000
#: Words that are cut into passages at once; a multiple of STEP.
PIECE = 32_000


class Terms:
    """Buckets of words' terms and of texts' passages; remembers those of a bounded number of words."""

    def __init__(self, used: np.ndarray | None = None):
        self.used, self.known = None if used is None else used.tobytes(), {}

    def of(self, word: str) -> tuple:
        ids = {zlib.crc32(word.encode()) & (BUCKETS - 1)}
        if len(word) > BEGINNINGS[0]:
            h = zlib.crc32(f"<{word[:BEGINNINGS[0]]}".encode())
            ids.add(h & (BUCKETS - 1))
            for letter in word[BEGINNINGS[0]:min(BEGINNINGS[-1], len(word) - 1)]:
                h = zlib.crc32(letter.encode(), h)
                ids.add(h & (BUCKETS - 1))
        return tuple(ids) if self.used is None else tuple(i for i in ids if self.used[i])

    def words(self, text: str | None) -> list[tuple]:
        known, found = self.known, []
        for w in WORD.findall(text.lower()) if text else ():
            ids = known.get(w)
            if ids is None:
                if len(known) >= WORDS_KEPT:
                    known.clear()
                ids = known[w] = self.of(w)
            found.append(ids)
        return found

    def passages(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms of all passages, the edges between passages, and the text of each."""
        parts, held, n, passages = [], [], 0, 0
        for i, text in enumerate(texts):
            found = self.words(text)
            for at in range(0, max(1, len(found) - STEP), PIECE):        # a piece has its own passages
                held.append((i, found[at:at + PIECE + STEP]))
                n += len(held[-1][1])
                if n >= PIECE:
                    parts.append(_passages(held))
                    held, n = [], 0
        if held:
            parts.append(_passages(held))
        if not parts:
            return np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int64)
        sizes = np.concatenate([np.diff(e) for _, e, _ in parts])
        return np.concatenate([t for t, _, _ in parts]), np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([d for _, _, d in parts])


def _different(values: np.ndarray) -> np.ndarray:
    """The different values in order, by sorting: much faster than ``np.unique`` here."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _passages(pieces: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = np.array([len(found) for _, found in pieces])
    n = np.maximum(1, -(-(words - STEP) // STEP))
    base = np.cumsum(n) - n
    sizes = np.fromiter((len(ids) for _, found in pieces for ids in found), np.int64, int(words.sum()))
    terms = np.fromiter((i for _, found in pieces for ids in found for i in ids), np.int64, int(sizes.sum()))
    piece = np.repeat(np.arange(len(pieces)), words)
    block = (np.arange(len(piece)) - np.repeat(np.cumsum(words) - words, words)) // STEP
    keys = []
    for back in range(SPAN // STEP):            # a block stands in the passage that it begins and in those before
        at = block - back
        inside = np.repeat((at >= 0) & (at < n[piece]), sizes)
        keys.append(np.repeat(base[piece] + at, sizes)[inside] * BUCKETS + terms[inside])
    keys = _different(np.concatenate(keys))
    return keys % BUCKETS, np.searchsorted(keys // BUCKETS, np.arange(int(n.sum()) + 1)), np.repeat([i for i, _ in pieces], n)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the runs between edges, empty ones too."""
    out = np.zeros((len(edges) - 1, *values.shape[1:]))
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        out[full] = np.add.reduceat(values, edges[full], axis=0)
    return out


class Machine:
    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray, scales: np.ndarray):
        self.bias, self.weights, self.factors, self.scales = bias, weights, factors, scales

    def parts(self, terms: np.ndarray, edges: np.ndarray):
        """Log odds of passages, with what the gradient needs besides."""
        x = self.scales[terms]
        v = self.factors[terms] * x[:, None]
        s = _sums(v, edges)
        pairs = 0.5 * ((s * s).sum(axis=1) - _sums((v * v).sum(axis=1), edges))
        return self.bias + _sums(self.weights[terms] * x, edges) + pairs, x, v, s

    def log_odds(self, terms: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Log odds of passages, some at a time."""
        scaled = self.factors * self.scales[:, None]
        single = self.weights * self.scales - 0.5 * (scaled * scaled).sum(axis=1)
        out, at = [], 0
        while at < len(edges) - 1:
            end = max(at + 1, int(np.searchsorted(edges, edges[at] + CHUNK, side="right")) - 1)
            t, e = terms[edges[at]:edges[end]], edges[at:end + 1] - edges[at]
            both = _sums(scaled[t], e)
            out.append(self.bias + _sums(single[t], e) + 0.5 * (both * both).sum(axis=1))
            at = end
        return np.concatenate(out) if out else np.empty(0)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(terms: np.ndarray, edges: np.ndarray, doc: np.ndarray, toxic: np.ndarray, share: float, factors: int = FACTORS, seed: int = SEED) -> Machine:
    """``terms`` between ``edges`` are a passage's, ``doc`` (ascending from 0) is its document; ``share``
    is that of toxic documents outside the sample."""
    n, n1 = len(toxic), int(toxic.sum())
    first = np.searchsorted(doc, np.arange(n + 1))
    seen = np.zeros((2, BUCKETS), dtype=np.int64)
    for d in range(n):
        seen[int(toxic[d])][_different(terms[edges[first[d]]:edges[first[d + 1]]])] += 1
    count = seen.sum(axis=0)
    used = count >= SEEN
    ones, zeros = seen[1] + 0.5 + count / n, seen[0] + 0.5 + count / n
    z = np.log(ones / np.maximum(n1 + 1.5 - ones, 0.5)) - np.log(zeros / np.maximum(n - n1 + 1.5 - zeros, 0.5))
    z = np.where(used, z / np.sqrt(1 / ones + 1 / zeros), 0.0)
    scales = np.where(used, np.clip(np.maximum(np.abs(z), COMMON * np.sqrt(count)), 1, SURE) / SURE, 0.0)
    # only the terms that are used
    keep = used[terms]
    edges = np.concatenate([[0], np.cumsum(keep)])[edges]
    terms = terms[keep]

    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.where(np.abs(z) > 2, 0.3 * z / SURE, 0.0), rng.normal(size=(BUCKETS, factors)) * 0.05 * used[:, None], scales)
    squares = [1.0, np.ones(BUCKETS), np.ones((BUCKETS, factors))]
    for turn in range(ROUNDS):
        odds = m.log_odds(terms, edges)
        worst = np.lexsort((-odds, doc))[first[:-1]]
        if turn == 0:
            m.bias = -float(np.quantile(odds[worst], 1 - n1 / n))
        order = rng.permutation(n)
        for at in range(0, n, STEP_DOCS):
            docs = order[at:at + STEP_DOCS]
            own = worst[docs]
            size = edges[own + 1] - edges[own]
            borders = np.concatenate([[0], np.cumsum(size)])
            t = terms[np.repeat(edges[own] - borders[:-1], size) + np.arange(borders[-1])]
            odds, x, v, s = m.parts(t, borders)
            wrong = sigmoid(odds) - toxic[docs]
            row = np.repeat(np.arange(len(docs)), size)
            back = wrong[row] * x
            by = np.argsort(t, kind="stable")
            if len(by):
                ids, begin = np.unique(t[by], return_index=True)
                g = np.add.reduceat(back[by], begin) + SHRINK * m.weights[ids]
                squares[1][ids] += g * g
                m.weights[ids] -= RATE * g / np.sqrt(squares[1][ids])
                g = np.add.reduceat((back[:, None] * (s[row] - v))[by], begin, axis=0) + SHRINK * m.factors[ids]
                squares[2][ids] += g * g
                m.factors[ids] -= PAIR_RATE * g / np.sqrt(squares[2][ids])
            g = float(wrong.sum())
            squares[0] += g * g
            m.bias -= RATE * g / np.sqrt(squares[0])
    # the sample may hold more toxic documents than there are elsewhere
    m.bias += np.log(share / (1 - share)) - np.log(n1 / (n - n1))
    return m


# -- Spark ---------------------------------------------------------------------------------------
def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(doc_id, text, toxic) of the sample, and the share of toxic rows among all that may be learned from."""
    marks = take(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    marks = materialise(marks.groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic")), "toxic-labels")
    n1, n = marks.agg(F.count_if("toxic"), F.count(F.lit(1))).first()
    most = {True: (TOXIC, n1), False: (CLEAN, n - n1)}
    drawn = unit_interval(F.lit(SEED), F.col("doc_id"))
    # a little below the bound, so that chance doesn't pass it
    sample = marks.where(F.when(F.col("toxic"), drawn < 0.9 * most[True][0] / max(most[True][1], 1)).otherwise(
        drawn < 0.9 * most[False][0] / max(most[False][1], 1)) | F.lit(n1 <= TOXIC) & F.col("toxic") | F.lit(n - n1 <= CLEAN) & ~F.col("toxic"))
    if sample.count() > TOXIC + CLEAN:
        raise ValueError("more labels drawn than the bounds allow")
    sample = F.broadcast(sample.withColumnRenamed("doc_id", "labelled"))       # TOXIC + CLEAN rows at most
    rows = take(docs, "doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= LONG)
    rows = rows.join(sample, F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "toxic")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")), n1 / n if n else 0.0


def with_passages(rows: DataFrame) -> DataFrame:
    """(doc_id, toxic, terms, sizes): a text's passages one after the other."""
    def run(batches):
        import pyarrow as pa

        terms = Terms()
        for batch in batches:
            found, edges, doc = terms.passages(batch.column("text").to_pylist())
            first = np.searchsorted(doc, np.arange(len(batch) + 1))
            lists = [pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(v, pa.int32())) for e, v in ((edges[first], found), (first, np.diff(edges)))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *lists], names=["doc_id", "toxic", "terms", "sizes"])

    return map_arrow(rows, run, "doc_id long, toxic boolean, terms array<int>, sizes array<int>")


def trained(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine of a bounded sample of labelled documents, as a written table: a row for each used term."""
    sample, share = training_rows(docs, labels)
    sample = materialise(with_passages(sample), "toxic-sample")
    if sample.select("toxic").distinct().count() < 2:
        flat = np.zeros(BUCKETS)
        return Machine(float(np.log(share / (1 - share))) if 0 < share < 1 else 30.0 * (2 * share - 1), flat, np.zeros((BUCKETS, 1)), flat)

    def run(batches):
        import pyarrow as pa

        rows = pa.Table.from_batches(list(batches)).sort_by("doc_id").combine_chunks()      # the bounded sample
        terms, sizes = (rows.column(c).combine_chunks() for c in ("terms", "sizes"))
        edges = np.concatenate([[0], np.cumsum(sizes.flatten().to_numpy())])
        doc = np.repeat(np.arange(len(rows)), sizes.value_lengths().to_numpy())
        m = fit(terms.flatten().to_numpy(), edges, doc, np.asarray(rows.column("toxic")).astype(float), share)
        used = np.flatnonzero(m.scales)
        values = np.column_stack([m.weights[used], m.scales[used], m.factors[used]])
        yield pa.RecordBatch.from_arrays([pa.array([-1, *used.tolist()], pa.int32()), pa.array([[m.bias], *values.tolist()], pa.list_(pa.float64()))],
                                         names=["term", "numbers"])

    # BUCKETS + 1 rows at most
    rows = bounded(materialise(map_arrow(sample.repartition(1), run, "term int, numbers array<double>"), "toxic-machine"), BUCKETS + 1, "terms")
    weights, scales, factors, bias = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS)), 0.0
    for term, numbers in rows:
        if term < 0:
            bias = numbers[0]
        else:
            weights[term], scales[term], factors[term] = numbers[0], numbers[1], numbers[2:]
    return Machine(bias, weights, factors, scales)


def with_score(rows: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(machine)      # BUCKETS * (FACTORS + 2) numbers

    def run(batches):
        import pyarrow as pa

        m = shared.value
        terms = Terms(m.scales > 0)
        for batch in batches:
            found, edges, doc = terms.passages(batch.column("text").to_pylist())
            first = np.searchsorted(doc, np.arange(len(batch)))
            worst = np.maximum.reduceat(m.log_odds(found, edges), first) if len(first) else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(worst), pa.float64())], names=["doc_id", "score"])

    return map_arrow(rows.select("doc_id", "text"), run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    rows = take(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    out = with_score(rows, trained(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))
