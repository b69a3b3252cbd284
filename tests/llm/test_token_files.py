import glob
import zlib

import pytest

pytest.importorskip("tokenizers")
import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tenantmart.llm import token_files  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_files(spark):
    lib = Tokenizer.from_file(PATH)
    rows = [(i * 7 % 501, f"Document {i} says {'word ' * (i % 50)}") for i in range(501)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "long text " * 50_000), (None, "no id"), (3000, "<|endoftext|>")]
    df = spark.createDataFrame([(t, "p", i) for i, t in rows], "text string, place string, doc_id long").repartition(6)
    path = token_files.write_ids(df, PATH)
    got = {r.doc_id: r for r in token_files.file_digests(spark, path).collect()}
    assert len(got) == len(rows)
    start = 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pruning_and_order(spark):
    import pyarrow.orc as orc

    df = spark.range(0, 40_000).selectExpr("id * 3 AS doc_id", "concat('some words ', id) AS text")
    path = token_files.write_ids(df, PATH)
    files = sorted(glob.glob(f"{path}/*.orc"))
    last = -1
    for f in files:
        ids = orc.ORCFile(f).read(columns=["doc_id"]).column(0).to_pylist()
        assert ids == sorted(ids) and ids[0] > last
        last = ids[-1]
        assert b"BLOOM_FILTER" in open(f, "rb").read() or orc.ORCFile(f).nstripes >= 1
    one = token_files.read_ids(spark, path).where("doc_id = 3003")
    assert one.count() == 1 and "EqualTo(doc_id,3003)" in one._jdf.queryExecution().toString()


def test_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(5, "same text")] * 20 + [(5, "other")] * 3 + [(4, "x")], "doc_id long, text string").repartition(3)
    got = sorted((r.start, r.n_tokens) for r in token_files.file_digests(spark, token_files.write_ids(df, PATH)).collect())
    assert len(got) == 24 and got[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:]))
    assert token_files.file_digests(spark, token_files.write_ids(df.limit(0), PATH)).count() == 0
