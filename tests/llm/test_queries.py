"""The registered queries and the pipeline on the given tables, against DuckDB SQL or brute force."""
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("tokenizers")
import duckdb  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from tenantmart.llm import bpe, html_text, mixing, quality, queries, rules, token_files  # noqa: E402

from .test_rules import brute as rule_counts  # noqa: E402
from .test_simhash import brute as simhash_brute  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.WORD_BPE)


def test_all_are_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def _digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(
        library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op1(spark, docs, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op1_bpe(spark, SF).collect()}
    assert got == {i: _digest(library, t) for i, t in docs}


def test_op4(spark, docs, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op4_token_files(spark, SF).collect()}
    start = 0
    for i, t in sorted(docs):
        ids = library.encode(t or "", add_special_tokens=False).ids + [token_files.END_ID]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op5(spark, docs):
    assert sorted(map(tuple, queries.op5_simhash(spark, SF).collect()), key=str) == simhash_brute(docs)


def test_op6(spark):
    model = html_text.trained()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op6_html(spark, SF).collect():
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, html_text.main_text(pages[r.page_id].html, model), len(r.text))


def test_op8(spark, docs):
    rows = queries.op8_sharding(spark, SF).collect()
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs}
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in rows if r["shard"] == s) == list(range(n)) for s, n in sizes.items())


def test_op9(spark, docs):
    got = {r.doc_id: r for r in queries.op9_rules(spark, SF).collect()}
    for i, t in docs:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == rule_counts(t)
        assert not (r.base_failed and r.kept)
    assert len(got) == len(docs)


def test_op10(spark):
    sf = "/root/testdata/sf0.01"     # sources of some 50 documents
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(re.findall("[^ \t-\r]+", r.text or ""))
    target, taken, source = mixing.targets(sizes), Counter(), {r.doc_id: r.source for r in rows}
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for r in queries.op10_mixing(spark, sf).collect():
        s = source[r.doc_id]
        assert (r.source_size, r.target) == (sizes[s], target[s]) and r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in sizes), [(s, taken[s], target[s]) for s in sizes]


def test_op13(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op13_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = {t: [r.predicted for r in rows if r.held_out and r.toxic == t] for t in (0, 1)}
    # some of these labels are on texts without any toxic word
    assert np.mean(held[1]) >= 0.8 and np.mean(held[0]) <= 0.005, {t: np.mean(v) for t, v in held.items()}


def test_pipeline_stage_by_stage(spark, library):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good, once, near, mix, encode = [f for _, f in corpus_pipeline.STAGES]
    kept = good(spark, table, SF)
    rows = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == table.columns
    assert set(rows) == {r.doc_id for r in quality.quality(table, labels).collect() if r.kept}

    different = once(spark, kept, SF)
    first = {}
    for i, r in sorted(rows.items()):
        first.setdefault(re.sub("[ \t-\r]+", " ", r.text or ""), i)
    assert sorted(map(tuple, different.collect())) == sorted(tuple(rows[i]) for i in first.values())

    single = near(spark, different, SF)
    groups = simhash_brute([(i, rows[i].text) for i in first.values()])
    assert sorted(map(tuple, single.collect())) == sorted(tuple(rows[i]) for i in {g[2] for g in groups})

    mixed = mix(spark, single, SF)
    plan = mixing.mix_plan(single).collect()
    assert mixed.columns == table.columns
    assert Counter(map(tuple, mixed.collect())) == Counter({tuple(rows[r.doc_id]): len(r.drawn) for r in plan if r.drawn})

    out = encode(spark, mixed, SF)
    assert Counter(map(tuple, out.collect())) == Counter({(r.doc_id, *_digest(library, rows[r.doc_id].text)): len(r.drawn) for r in plan if r.drawn})
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, out.collect()))


def test_rule_verdicts_keep_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = rules.judged(spark.read.parquet(f"{sf}/documents.parquet")).where("not base_failed").join(labels, "doc_id")
    assert got.where("quality = 1 and not kept").count() == 0
    assert got.where("quality = 0 and not kept").count() >= 0.8 * got.where("quality = 0").count()


def test_encoder_is_the_method_named():
    own = bpe.codec(queries.WORD_BPE)
    assert isinstance(own.words, bpe.PrefixBpe)
