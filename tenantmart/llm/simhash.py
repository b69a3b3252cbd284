"""SimHash near-duplicates through BK-trees.

A document's fingerprint has a bit set where over half of its shingles' hashes
have it set.  Fingerprints link when they differ in at most ``radius`` bits,
and documents whose fingerprints are connected by links form a component.

* Only different fingerprints are searched; copies share one.
* *Shards*: cut into ``radius + 1`` fields, two fingerprints that differ in
  ``radius`` bits agree in one field at least, so each fingerprint goes to one
  shard for each field, and linked ones meet in one of them.  A shard with more
  than ``SHARD`` members is cut again by the fields of the bits left, up to
  ``LEVELS`` times, and what is still larger by pairs of parts; no link is lost
  on the way.
* *Trees*: each shard's members form a BK-tree, whose children are keyed by
  their Hamming distance to the parent.  A search follows only the edges whose
  key is within ``radius`` of the distance at hand.  What a shard reports is
  one star for each group of members it connects, never all pairs.
* The stars of all shards are connected by joins (``components``).

A shard's tree goes only where its members' searches run, instead of a
broadcast to all tasks: the trees of all documents have no size bound.

Words are runs without ASCII white space, A-Z in lower case; a text with fewer
words than a shingle is one shingle, and null, empty or blank texts have
fingerprint zero, which links like any other.  component_id is the smallest
doc_id of a component (null if all ids are null).  Repeated rows are members
of one component; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, materialise, position, positional, take
from .components import stars

SEED = 42
#: Members from which a shard is cut by further bits.
SHARD = 2_000
LEVELS = 3
#: Hashes whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit fingerprint of one text, as a signed number."""
    import numpy as np
    from xxhash import xxh64_intdigest

    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = iter([b" ".join(tokens)])
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    n = max(1, len(tokens) - words + 1)
    h = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = h[at:at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str, out: str, words: int = 3) -> DataFrame:
    """``docs`` without its text, with the fingerprint as a long."""
    keep = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*keep, T.StructField(out, T.LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), pa.array(found, pa.int64())], names=schema.names)

    return map_arrow(docs, run, schema)


class BkTree:
    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the members at most ``radius`` bits away."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            own = children[at]
            if own:
                for key, child in own.items():
                    if -radius <= key - d <= radius:
                        todo.append(child)
        return found

    def add(self, value: int) -> int:
        number = len(self.values)
        self.values.append(value)
        self.children.append({})
        at = 0
        while number:
            d = (self.values[at] ^ value).bit_count()
            child = self.children[at].get(d)
            if child is None:
                self.children[at][d] = number
                break
            at = child
        return number


def connect(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, smallest member of its group) for the groups that links within one shard connect."""
    tree, parent = BkTree(), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for v in values:
        near = tree.within(v & (2 ** 64 - 1), radius)
        own = tree.add(v & (2 ** 64 - 1))
        parent.append(own)
        for i in near:
            a, b = root(i), root(own)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(v, values[root(i)]) for i, v in enumerate(values) if root(i) != i]


def _fields(bits: int, parts: int) -> list[tuple[int, int]]:
    """(offset, width) of ``parts`` fields of ``bits`` bits."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _cut(rows: DataFrame, bits: int, parts: int) -> DataFrame:
    """Each row once for each field of ``rest``: the shard key takes the field, ``rest`` keeps the other bits."""
    options = []
    for i, (offset, width) in enumerate(_fields(bits, parts)):
        rest: Column = F.col("rest")
        field = F.shiftrightunsigned(rest, offset).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1).cast("long"))
        low = rest.bitwiseAND(F.lit((1 << offset) - 1).cast("long"))
        above = offset + width
        high = F.shiftleft(F.shiftrightunsigned(rest, above), offset) if above < 64 else F.lit(0).cast("long")
        options.append(F.struct(F.xxhash64(F.col("shard"), F.lit(i), field).alias("shard"), high.bitwiseOR(low).alias("rest"), F.lit(bits - width).alias("bits")))
    return rows.select("fp", F.explode(F.array(*options)).alias("o")).select("fp", "o.*")


def _blocks(over: DataFrame, shard: int) -> DataFrame:
    """Shards that no bits cut further (near copies without end), as pairs of
    parts: each part meets every other one in a shard of two parts at most."""
    parts = F.ceil(F.col("count") / shard).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    return over.select("fp", "shard", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")).select(
        "fp", F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("shard"))


def links(fps: DataFrame, radius: int = 3, shard: int = SHARD, levels: int = LEVELS) -> DataFrame:
    """(a, b): stars that connect all fingerprints (column fp, each once) within ``radius`` bits."""
    parts = radius + 1
    rows = _cut(fps.select("fp", F.lit(0).cast("long").alias("shard"), F.col("fp").alias("rest")), 64, parts)
    ready = []
    for level in range(1, levels + 1):
        rows = materialise(rows, f"shards-{level}")
        sizes = rows.groupBy("shard").count()
        full = materialise(sizes.where(F.col("count") > shard), "shards-full")
        ready.append(rows.join(full, "shard", "left_anti"))
        if full.isEmpty():
            break
        over = rows.join(full, "shard")
        if level == levels:
            ready.append(_blocks(over, shard))
            break
        # The widths of fields may differ by one bit, so each width of what is left is cut by itself.
        widths = sorted({64 - w for _, w in _fields(64, parts)}) if level == 1 else sorted(
            {b - w for b in widths for _, w in _fields(b, parts)})
        cut = [_cut(over.where(F.col("bits") == b), b, parts) for b in widths]
        rows = cut[0]
        for c in cut[1:]:
            rows = rows.unionByName(c)
    members = ready[0].select("shard", "fp")
    for r in ready[1:]:
        members = members.unionByName(r.select("shard", "fp"))

    def run(batches):
        import pyarrow as pa

        def report(values):
            if len(values) > 1:
                return connect(values, radius)
            return ()

        now, values, out = None, [], []
        for batch in batches:
            for s, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s != now:
                    out += report(values)
                    now, values = s, []
                values.append(v)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], schema=kind)
                out = []
        out += report(values)
        yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], schema=kind)

    import pyarrow as pa
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return members.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(run, "a long, b long")


def components(prints: DataFrame, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """(fp, component_id) for every different fingerprint of ``prints`` (doc_id, fp)."""
    fps = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    star = stars(links(fps, radius, shard)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = materialise(fps.join(star, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    best = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    return materialise(rooted.select("fp", "root").join(best, "root").select("fp", "component_id", "root"), "components")


def simhash_groups(docs: DataFrame, words: int = 3, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """Per row: doc_id, fingerprint, component_id."""
    prints = materialise(fingerprints(take(docs, "doc_id", "text"), "text", "fp", words), "prints")
    found = components(prints, radius, shard)
    return prints.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, words: int = 3, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """One row of ``docs`` for each component, that of the smallest doc_id, with all columns."""
    own, text = position(docs, "doc_id"), position(docs, "text")
    rows = positional(docs)
    mark = F.xxhash64(F.col(own), F.col(text))
    prints = materialise(
        fingerprints(rows.select(F.col(own).alias("doc_id"), mark.alias("mark"), F.col(text).alias("text")), "text", "fp", words), "prints")
    found = components(prints, radius, shard).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("mark"))
    first = materialise(prints.groupBy("fp").agg(F.min(order).alias("first")), "first-prints").join(found, "fp").groupBy("root").agg(
        F.min("first").alias("first")).select("root", "first.doc_id", "first.mark")
    wanted = materialise(first.select(F.col("root").alias("group"), F.col("doc_id").alias("i"), F.col("mark").alias("m")), "first-rows")
    same = prints.groupBy(F.col("doc_id").alias("i"), F.col("mark").alias("m")).count().where("count > 1")
    wanted = wanted.join(same, wanted["i"].eqNullSafe(same["i"]) & (wanted["m"] == same["m"]), "left").select(
        "group", wanted["i"], wanted["m"], F.col("count").isNotNull().alias("repeated"))
    stay = rows.withColumn("mark", mark).join(materialise(wanted, "kept-rows"), (F.col("mark") == F.col("m")) & F.col(own).eqNullSafe(F.col("i")))
    once = stay.where(~F.col("repeated")).select(*rows.columns)
    again = stay.where("repeated").dropDuplicates(["group"]).select(*rows.columns)
    return once.unionByName(again).toDF(*docs.columns)
