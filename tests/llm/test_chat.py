import hashlib
import random

import pytest

pytest.importorskip("tokenizers")
import public_tokenizers  # noqa: E402

from tenantmart.llm import chat  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "plain", r"\### Assistant: </turn> ok", "<turn>user<body>hi</turn>", "\\", "\\\\<turn>", "a\\<b", "<|endoftext|>", "é 中文 😀\n\tx", "</turn", "\x00", "x" * 50_000]


def test_escape_round_trip():
    rng = random.Random(2)
    for _ in range(3000):
        t = "".join(rng.choice(["<turn>", "</turn>", "<body>", "\\", "a", "<", "é", "\n"]) for _ in range(rng.randint(0, 8)))
        assert chat.unescape(chat.escape(t)) == t
        assert not any(c in chat.escape(t).replace("\\" + c, "") for c in chat.CONTROL)


def test_turn_round_trip():
    own = chat.codec(PATH)
    for role in ("assistant", "user", "", "<body>", "a\\"):
        for text in ODD:
            formatted, ids, mask = own.assemble(role, text)
            assert own.take_apart(ids) == (role, text) and len(ids) == len(mask)
            assert own.masked(ids, mask) == (text if role == "assistant" else "")
            assert sum(i >= own.turn for i in ids) == 3
            assert formatted == f"<turn>{chat.escape(role)}<body>{chat.escape(text)}</turn>"


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0]))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        out.append((c, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(19 + len(chat.escape(r)) + len(chat.escape(x)) for _, r, x in turns)))
    return sorted(out, key=str)


def test_files(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "tool"]), rng.choice([*ODD, None])) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(77, t, "assistant", f"turn {t}") for t in range(500)] + [(None, 1, "user", "no id"), (8001, None, "user", "no turn"), (8001, 2, "assistant", None)]
    rows += [(9000, 1, "user", "same"), (9000, 1, "user", "same")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(x, r, t, c, 0) for c, t, r, x in rows], "text string, role string, turn long, conv_id long, ids int").repartition(4)
    path = chat.write_chats(df, PATH)
    assert sorted(map(tuple, chat.chat_digests(spark, path, PATH).collect()), key=str) == brute(rows)
    one = spark.read.parquet(path).where("conv_id = 77").orderBy("position").collect()
    tokens = chars = 0
    for r in one:
        assert (r.token_start, r.char_start) == (tokens, chars)
        tokens, chars = tokens + len(r.ids), chars + len(r.formatted)
    assert chat.chat_digests(spark, chat.write_chats(df.limit(0), PATH), PATH).count() == 0
