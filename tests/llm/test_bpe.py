import hashlib
import random

import pytest

pytest.importorskip("tokenizers")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tenantmart.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a", "'s", "'Statement's", "x" * 3000, "ΣΑΣ ΟΔΟΣ", "İstanbul ǆ", "éá", "a\x00b\x1cc\x85d", "中文12٣½",
       "😀👍🏽 ok", "a<|endoftext|>B <|startoftext|>", "<|endoftext|", "\U0001E030͸ new", "%%%&&& | a--b...", "don't we'll I'd"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("by_library", [False, True])
def test_ids_equal_the_library(library, by_library):
    own, rng = bpe.codec(PATH, by_library), random.Random(5)
    texts = ODD + ["".join(rng.choice("abcdehinorst' ") for _ in range(rng.randint(1, 200))) for _ in range(400)]
    texts += ["".join(rng.choice("aé<|>endoftx 1%&Σß\n中") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += [f"a{chr(c)}b{chr(c)}{chr(c)} é{chr(c)}" for c in range(0x300)] + [f"a{chr(c)}b1" for c in range(128)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids, t
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bounded_word_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 5)
    monkeypatch.setattr(bpe, "CHUNKS_KEPT", 4)
    monkeypatch.setattr(bpe, "PAIRS_KEPT", 7)
    own = bpe.TextCodec(PATH)
    for t in ["one two three four five six seven", "one eight nine", "one two ten eleven twelve thirteen"]:
        assert own.encode(t) == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("piece", [500_000, 20])
def test_many_texts_at_once(library, monkeypatch, piece):
    import pyarrow as pa
    monkeypatch.setattr(bpe, "PIECE", piece)
    own, rng = bpe.codec(PATH, True), random.Random(9)
    texts = [*ODD, None, "\n\tlead and trail \x0b ", "a\xa0b\u3000c", *("".join(rng.choice("ab .,é\n'") for _ in range(rng.randint(0, 90))) for _ in range(200)), None]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = []
    for ids, counts in own.batches(texts):
        ids, at = ids.tolist(), 0
        for n in counts.tolist():
            got.append(ids[at:at + n])
            at += n
    assert got == want
    column = pa.array(want, pa.list_(pa.int32()))
    assert own.decode_many(column).to_pylist() == [library.decode(i, skip_special_tokens=False) for i in want]
    assert own.decode_many(column.slice(5, 4)).to_pylist() == [library.decode(i, skip_special_tokens=False) for i in want[5:9]]
    odd = pa.array([[5, 99_999_999, 7], None, [-1]], pa.list_(pa.int32()))
    assert own.decode_many(odd).to_pylist() == [own.decode([5, 7]), "", ""]


def test_encode_then_decode(spark, library):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "k long, text string")
    got = {r.k: r for r in bpe.decode(bpe.encode(df, PATH, end_id=2), PATH).collect()}
    for i, t in enumerate(ODD):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        assert got[i].ids == ids and got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_digests(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "a"), (3, "a"), (99, None)]
    df = spark.createDataFrame([(t, "x", i, 0) for i, t in rows], "text string, TEXT2 string, doc_id long, ids int")
    got = sorted(map(tuple, bpe.digests(df, PATH).collect()), key=str)

    def one(i, t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())

    assert got == sorted((one(i, t) for i, t in rows), key=str)
    assert bpe.digests(df.limit(0), PATH).count() == 0
