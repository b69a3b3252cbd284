"""Spelling variants by permuterm rotations.

* *Words*: maximal runs of letters, A-Z lower-cased, counted over all texts;
  those with at least ``LENGTH`` code points and ``COUNT`` occurrences.  They are
  ranked by count (largest first, ties in code-point order), so that "the largest
  near word" is the one of the smallest rank.
* *Rotations*: a word ``a c b`` marked with a terminator has the rotation
  ``b $ a c``, whose last character is the one that is edited.  In the sorted
  rotations, the words that a replacement of ``c`` can give share the prefix
  ``b $ a``, and the word without ``c`` has a rotation equal to it.  So
  each word puts down its rotations whole and without their last character, and
  rows with the same prefix, sorted by rank, are one group: the prefix range with
  the edited character skipped.
* *Scan*: a group holds at most one word for each letter and one without, so it
  is as small as the alphabet.  One pass tells each row how many neighbours it has
  there and which is best: the first row, or the second for the first.  No pair
  is written.  A deletion within a run of equal letters gives the same word at
  each of them; only the first counts.
* *Roots*: forms lead to ever larger counts, so a chain has few links; pointer
  doubling follows them.

Prefixes over ``WHOLE`` code points are compared by their SHA-256.  Null and empty
texts have no words.  Repeated rows count again.  A null doc_id is never divisible,
so its words stay as they are.  Without words the result is empty.  A long text is
one array of words in one task at a time.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, take

RUN = r"[A-Za-zÀ-ÿ]+"
LENGTH = 6
COUNT = 5
#: A form occurs at least so many times as often.
RATIO = 5
#: Of all occurrences, those whose hash this divides lose a letter.
ODD = 199
#: Code points of the longest prefix that is compared as text.
WHOLE = 256
END = "$"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def occurrences(docs: DataFrame, odd: int | None = None) -> DataFrame:
    """(word): each run of letters of every text; with ``odd``, one letter is
    deleted where the CRC-32 of ``<doc_id>:<run>`` is divisible by it."""
    runs = take(docs, "doc_id", "text").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", lower_ascii(F.col("run")).alias("run"))
    if odd is None:
        return runs.select(F.col("run").alias("word"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod("h", F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.pmod("h", F.lit(odd)) == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, length: int = LENGTH, count: int = COUNT) -> DataFrame:
    """(word, n, rank), written; a smaller rank is a larger n, or the smaller word of equal n."""
    counted = words.where(F.length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)
    counted = materialise(counted, "spelling-counts")
    return materialise(counted.orderBy(F.desc("n"), "word").withColumn("rank", F.monotonically_increasing_id()), "spelling-words")


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, cut, first, rank): rotations without their last character (``cut``), and whole."""
    rows = words.select("word", "rank", F.explode(F.sequence(F.lit(0), 2 * F.length("word"))).alias("i"))
    at, cut = F.floor(F.col("i") / 2).cast("int"), F.col("i") % 2 == 1
    rest = F.substring("word", at + F.when(cut, 2).otherwise(1), F.length("word"))
    prefix = F.concat(rest, F.lit(END), F.substring("word", F.lit(1), at))
    first = (at == 0) | (F.substring("word", at, F.lit(1)) != F.substring("word", at + 1, F.lit(1)))
    rows = rows.select(prefix.alias("prefix"), cut.alias("cut"), (cut & first).alias("first"), "rank")
    return rows.withColumn("prefix", F.when(F.length("prefix") > WHOLE, F.sha2("prefix", 256)).otherwise(F.col("prefix")))


def neighbours(words: DataFrame) -> DataFrame:
    """(rank, n_near, best): for each word with a near one, how many, and the smallest rank of them."""
    ordered = W.partitionBy("prefix").orderBy("rank")
    group = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    scanned = rotations(words).select(
        "rank", "cut", "first",
        F.first("rank").over(group).alias("one"), F.nth_value("rank", 2).over(group).alias("two"),
        F.count_if("cut").over(group).alias("cuts"), F.count_if("first").over(group).alias("firsts"),
        F.count_if(~F.col("cut")).over(group).alias("whole"))
    near = F.when(F.col("cut"), F.col("cuts") - 1 + F.when(F.col("first"), F.col("whole")).otherwise(0)).otherwise(F.col("firsts"))
    best = F.when(F.col("rank") == F.col("one"), F.col("two")).otherwise(F.col("one"))
    found = scanned.where("two is not null").select("rank", near.alias("near"), best.alias("best"))
    return found.groupBy("rank").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(rank, root): where a chain of forms (rank, up) ends; each rank has one form."""
    now = materialise(forms.select("rank", F.col("up").alias("root")), "spelling-roots")
    while True:
        ups = now.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        now = materialise(now.join(ups, "root", "left").select(
            "rank", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("rank", "root")
        now = now.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word of a vocabulary: word, form, root, n, n_near, form_n."""
    near = materialise(neighbours(words), "spelling-near")
    names = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    known = words.join(near, "rank", "left").join(names, "best", "left")
    is_form = F.col("form_n") >= ratio * F.col("n")
    known = materialise(known.select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("form")).alias("form"),
        F.when(is_form, F.col("form_n")).alias("form_n"), F.when(is_form, F.col("best")).alias("up")), "spelling-forms")
    ends = roots(known.where("up is not null"))
    last = words.select(F.col("rank").alias("root"), F.col("word").alias("last"))
    out = known.join(ends.join(last, "root").drop("root"), "rank", "left")
    return out.select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


def spelling(docs: DataFrame, odd: int | None = None) -> DataFrame:
    """Words of all texts with their near words' count, form and root."""
    return variants(vocabulary(occurrences(docs, odd)))


def _crc_table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


# The letters are ASCII or Latin-1, so a code point makes one or two bytes.
ORACLE_SQL = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
    SELECT run, n, length(run) AS long, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(doc_id::VARCHAR || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
        lambda h, b: xor(h >> 8, {_crc_table()}[1 + (xor(h, b) & 255)])), 4294967295) AS h FROM runs),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % {ODD} = 0 THEN left(run, (h % long)::INT) || substr(run, (h % long)::INT + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= {LENGTH} GROUP BY word HAVING sum(n) >= {COUNT}),
cuts AS (
    SELECT word, n, place, left(word, place - 1) || substr(word, place + 1) AS rest
    FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS place FROM words)),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.place = b.place AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
    SELECT word, count(*) AS n_near, any_value(n) AS n, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (
    SELECT w.word, CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
steps AS (
    SELECT word, form AS up FROM formed WHERE form IS NOT NULL
    UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.up WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.up FROM steps s JOIN formed f ON f.word = s.up WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.up, f.word) AS root, f.n, f.n_near, f.form_n FROM formed f LEFT JOIN ends e ON e.word = f.word
"""
