"""Quality rules: base rules and robust multivariate outliers, as DataFrame operations.

*Statistics* of each text: words, their characters, marks, lines that repeat
earlier ones, and words inside repeated windows of three.  All are counted in
one pass over the whole text with array functions.

*Outliers*: in each group (language and source; null is a group) the transformed
statistics get a minimum-covariance-determinant estimate: the mean and
covariance of the half that lies closest to it, (n + 5) / 2 of n points as there
are four statistics.  Documents with the same statistics are one point, so
copies of a bad text have no more weight than one of it; and points that differ
can make up close to half of a group before they bear on the estimate.  It is
found by concentration steps: start from the medians, take the closest points
by Mahalanobis distance, estimate again from them, ``STEPS`` times.  A half's
covariance is too small by a known factor for normal points, and is multiplied
by it.  A last estimate takes in all points within the cut-off of the one
found, and a document whose squared distance to that is above ``CUTOFF`` is
rejected.

Each step is one aggregation by group (sums only, partial before the shuffle)
over the light table of statistics.  The matrices are inverted as column
expressions (Cholesky), one row for each group.  A floor on the scales
(``FLOORS``) is added to the covariance: most clean documents have no marks or
repeats at all, and without it any single one would be an outlier.  The floor
also settles groups of any size, one document included, without a rule of
their own.

Null and blank texts have zero statistics and fail the base rule on length.
Ties at the subset's border are all taken in.  Repeated rows are judged each,
and are one point of the estimates.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, materialise, small_side, take

MARKS = "#*$%&|<>"
MIN_WORDS = 50
#: A window is this many words; more than this percentage of words in repeated ones fails.
WINDOW = 3
MAX_REPEAT = 50
#: Share of a group's points that the estimate rests on; small groups take (n + 5) / 2 of n.
SUBSET = 0.5
STEPS = 3
#: Scale of each transformed statistic below which differences do not matter.
FLOORS = {"word_length": 0.08, "marks": 0.04, "dup_lines": 0.05, "repeats": 0.05}
#: Squared Mahalanobis distance from which a document is an outlier.
CUTOFF = 45.0
#: Accuracy of the border of the closest share (ranks off by 1 / ACCURACY at most).
ACCURACY = 10_000


def let(value: Column, body) -> Column:
    """``body`` of ``value`` with the value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of three that occurs at least twice.

    Windows are compared by 64-bit hash; equal hashes are confirmed by their words.
    """
    def windows(w: Column) -> Column:
        # (hash, place) of each window, sorted, so that equal windows are neighbours
        return F.sort_array(F.transform(F.slice(w, 1, F.size(w) - (WINDOW - 1)), lambda x, i: F.struct(
            F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

    def same(w: Column, a: Column, b: Column) -> Column:
        hit = a["h"] == b["h"]
        for k in range(WINDOW):
            hit = hit & (F.get(w, a["i"] + k) == F.get(w, b["i"] + k))
        return F.coalesce(hit, F.lit(False))

    def places(w: Column, s: Column) -> Column:
        found = F.filter(s, lambda e, j: same(w, e, F.get(s, j + 1)) | same(w, e, F.when(j > 0, F.get(s, j - 1))))
        return F.sort_array(F.transform(found, lambda e: e["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    def count(w: Column) -> Column:
        return let(windows(w), lambda s: let(places(w, s), covered))

    return F.when(F.size(words) > WINDOW, let(words, count)).otherwise(0).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each text."""
    rows = take(docs, "doc_id", "lang", "source", "text").withColumn("text", F.coalesce("text", F.lit("")))
    text = F.col("text")

    def dup_lines(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return rows.select(
        "doc_id", "lang", "source",
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("w"), text.alias("text")).select(
        "doc_id", "lang", "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", MARKS, ""))).cast("long").alias("n_symbols"),
        let(lines, dup_lines).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"))


def transformed() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "word_length": F.log1p(F.col("word_chars") / words),
        "marks": F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "dup_lines": F.log1p(F.col("n_dup_lines") * 10 / (words + 100)),
        "repeats": F.sqrt(F.col("n_repeat_words") / (words + 100)),
    }


NAMES = tuple(FLOORS)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def consistency(share: float) -> float:
    """What the covariance of the closest ``share`` of normal points in four dimensions is too small by."""
    def inner(q: float) -> float:      # chi-square distribution, four degrees of freedom
        return 1 - math.exp(-q / 2) * (1 + q / 2)

    if share >= 1:
        return 1.0
    low, high = 0.0, 100.0
    for _ in range(100):
        q = (low + high) / 2
        low, high = (q, high) if inner(q) < share else (low, q)
    return share / (inner(q) - math.exp(-q / 2) * q * q / 8)


#: The shares that a group's subset can be, in steps of 1 %, and the factor of each.
SHARES = [round(SUBSET + i / 100, 2) for i in range(round((1 - SUBSET) * 100) + 1)]
FACTORS = [consistency(x) for x in SHARES]


def _closest(near: DataFrame) -> DataFrame:
    """Per group: the distance within which its closest half lies, and the half's factor."""
    found = near.groupBy("group").agg(F.percentile_approx("d2", SHARES, ACCURACY).alias("borders"), F.count(F.lit(1)).alias("n"))
    half = F.floor((F.col("n") + len(NAMES) + 1) / 2)
    level = F.least(F.lit(len(SHARES)), F.greatest(F.lit(1), F.ceil((half / F.col("n") - SUBSET) * 100 - 1e-9) + 1)).cast("int")
    return materialise(found.select("group", F.element_at("borders", level).alias("border"),
                                    F.element_at(F.array(*map(F.lit, FACTORS)), level).alias("factor")), "mcd-border")


def _moments(rows: DataFrame, chosen: Column, factor: Column) -> DataFrame:
    """Mean (m0, m1, ...) and Cholesky factor (l00, l10, l11, ...) of each group's chosen rows."""
    x = [F.when(chosen, F.col(n)) for n in NAMES]
    # Sums of differences from the group's medians lose no digits.
    d = [a - F.col(f"c{i}") for i, a in enumerate(x)]
    sums = rows.groupBy("group").agg(
        F.count(x[0]).alias("n"), *[F.sum(a).alias(f"s{i}") for i, a in enumerate(d)],
        *[F.sum(d[i] * d[j]).alias(f"q{i}{j}") for i, j in PAIRS], F.first(factor).alias("factor"), *[F.first(f"c{i}").alias(f"c{i}") for i in range(len(NAMES))])
    cov = {}
    for i, j in PAIRS:
        cov[i, j] = F.col(f"q{i}{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / (F.col("n") * F.col("n"))
    out = sums.select("group", *[(F.col(f"c{i}") + F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(len(NAMES))],
                      *[(v * F.col("factor") + (F.lit(FLOORS[NAMES[i]] ** 2) if i == j else 0)).alias(f"v{i}{j}") for (i, j), v in cov.items()])
    return materialise(_cholesky(out), "mcd-moments")


def _cholesky(rows: DataFrame) -> DataFrame:
    """v = l * l' element by element, each a column of its own."""
    for i, j in PAIRS:
        rest = F.col(f"v{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        rows = rows.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    return rows.select("group", *[f"m{i}" for i in range(len(NAMES))], *[f"l{i}{j}" for i, j in PAIRS])


def _distance(rows: DataFrame, moments: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2`` to their group's estimate."""
    est = small_side(moments.withColumnRenamed("group", "g"))
    out = rows.join(est, F.col("group") == F.col("g"))
    for i in range(len(NAMES)):
        rest = F.col(NAMES[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    d2 = F.col("y0") * F.col("y0")
    for i in range(1, len(NAMES)):
        d2 = d2 + F.col(f"y{i}") * F.col(f"y{i}")
    return out.select(*rows.columns, d2.alias("d2"))


def distances(rows: DataFrame) -> DataFrame:
    """``rows`` (group and the transformed statistics, written) with ``d2`` from the robust estimate."""
    points = materialise(rows.select("group", *NAMES).distinct(), "mcd-points")
    centres = materialise(points.groupBy("group").agg(
        *[F.percentile_approx(n, 0.5, ACCURACY).alias(f"c{i}") for i, n in enumerate(NAMES)]), "mcd-centres")
    centred = points.join(small_side(centres.withColumnRenamed("group", "cg")), F.col("group") == F.col("cg")).drop("cg")
    # The first distances are from the medians, in units of the floors.
    d2 = sum((((F.col(n) - F.col(f"c{i}")) / FLOORS[n]) ** 2 for i, n in enumerate(NAMES)), F.lit(0.0))
    near = centred.withColumn("d2", d2)
    for _ in range(STEPS):
        border = _closest(near)
        chosen = near.join(small_side(border.withColumnRenamed("group", "bg")), F.col("group") == F.col("bg"))
        near = _distance(centred, _moments(chosen, F.col("d2") <= F.col("border"), F.col("factor")))
    # The nearest point of a group is always within the cut-off or the group has no spread to judge by.
    last = _moments(near, F.col("d2") <= CUTOFF, F.lit(1.0))
    return _distance(rows, last)


def judged(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept and the squared distance."""
    stats = statistics(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    rows = stats.withColumns(transformed()).withColumn("base_failed", failed).withColumn(
        "group", F.to_json(F.struct(F.col("lang").alias("l"), F.col("source").alias("s"))))
    rows = materialise(rows.drop("lang", "source"), "rule-statistics")
    # Documents that fail the base rules are out already and take no part in the estimates.
    passed = distances(rows.where("not base_failed"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    good = passed.select(*names, (F.coalesce("d2", F.lit(0.0)) <= CUTOFF).alias("kept"), "d2")
    bad = rows.where("base_failed").select(*names, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("d2"))
    return good.unionByName(bad)
