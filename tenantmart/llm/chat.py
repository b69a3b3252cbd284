"""Chat formatting by token-level assembly.

A turn is written as ``<turn>role<body>text</turn>``.  The three control
strings have reserved ids above the tokenizer's vocabulary; role and text are
encoded as segments of their own, so no token spans a border and no content
can make a reserved id.  Prefix sums over the segment lengths give the token
ranges, from which the loss mask (the text tokens of assistant turns) follows.

In the readable form, a control string inside a role or text is escaped with a
backslash, and so is every backslash; the tokens hold the escaped form too.
Both forms read back to the exact roles and texts.

Rows are encoded where they lie; only then are a conversation's rows put in
order (turn, role, text; nulls first) for the running starts, and the check
sums are taken over ordered rows as a stream, so no conversation is ever held
as a whole.  Null roles and texts count as empty; a null conv_id is a
conversation; repeated rows are turns of their own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import map_arrow, take

TURN, BODY, END = "<turn>", "<body>", "</turn>"
CONTROL = (TURN, BODY, END)
_CONTROL = re.compile("|".join(["\\\\", *map(re.escape, CONTROL)]))
_ESCAPED = re.compile(r"\\(.)", re.S)
LOSS_ROLE = "assistant"
BATCH_IDS = 200_000


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class ChatCodec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True    # their strings in content are ordinary text
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.turn, self.body, self.end = size, size + 1, size + 2

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def decode(self, ids) -> str:
        return self.tokenizer.decode(list(ids), skip_special_tokens=False) if len(ids) else ""

    def assemble(self, role: str, text: str):
        """Readable form, ids and loss mask of one turn."""
        import numpy as np

        role_form, text_form = escape(role), escape(text)
        segments = [[self.turn], self.encode(role_form), [self.body], self.encode(text_form), [self.end]]
        edges = np.concatenate(([0], np.cumsum([len(s) for s in segments])))
        mask = np.zeros(edges[-1], dtype=bool)
        if role == LOSS_ROLE:
            mask[edges[3]:edges[4]] = True
        return f"{TURN}{role_form}{BODY}{text_form}{END}", [i for s in segments for i in s], mask.tolist()

    def take_apart(self, ids) -> tuple[str, str]:
        """Role and text of one turn's ids."""
        ids = list(ids)
        if ids[0] != self.turn or ids[-1] != self.end:
            raise ValueError("not a turn")
        at = ids.index(self.body)
        return unescape(self.decode(ids[1:at])), unescape(self.decode(ids[at + 1:-1]))

    def masked(self, ids, mask) -> str:
        return unescape(self.decode([i for i, m in zip(ids, mask) if m]))


_codecs: dict = {}


def codec(path: str) -> ChatCodec:
    if path not in _codecs:
        _codecs[path] = ChatCodec(path)
    return _codecs[path]


def format_turns(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """Per turn: conv_id, position, formatted, ids, loss_mask, token_start, char_start."""
    rows = take(conversations, "conv_id", "turn", "role", "text")
    schema = "conv_id long, turn long, role string, text_order binary, formatted string, ids array<int>, loss_mask array<boolean>"

    def run(batches):
        import hashlib

        import pyarrow as pa

        own = codec(tokenizer)
        kinds = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text_order", pa.binary()), ("formatted", pa.string()),
                           ("ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_()))])
        for batch in batches:
            out, n = [], 0
            for r in range(batch.num_rows):
                conv, turn, role, text = (batch.column(i)[r].as_py() for i in range(4))
                formatted, ids, mask = own.assemble(role or "", text or "")
                tie = None if text is None else hashlib.sha256(text.encode()).digest()
                out.append((conv, turn, role, tie, formatted, ids, mask))
                n += len(ids)
                if n >= BATCH_IDS or r + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)
                    out, n = [], 0

    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    turns = map_arrow(rows, run, schema)
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text_order")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return turns.select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("position"), "formatted", "ids", "loss_mask",
        F.coalesce(F.sum(F.size("ids").cast("long")).over(before), zero).alias("token_start"),
        F.coalesce(F.sum(F.length("formatted").cast("long")).over(before), zero).alias("char_start"))


def write_chats(conversations: DataFrame, tokenizer: str, path: str | None = None) -> str:
    path = path or scratch_path(conversations.sparkSession, "chats")
    format_turns(conversations, tokenizer).write.parquet(path)
    return path


def chat_digests(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Per conversation, read back from the files: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    rows = spark.read.parquet(path).select("conv_id", "position", F.length("formatted").alias("chars"), "ids", "loss_mask")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        import hashlib

        import pyarrow as pa

        own = codec(tokenizer)
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])))
        now, out = (), []

        def close():
            if now:
                out.append((now[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in batches:
            convs, lengths, ids, masks = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), batch.column(4)
            for conv, length, i, m in zip(convs, lengths, ids, masks):
                if now != (conv,):
                    close()
                    now, n, turns, loss, loss_chars, chars = (conv,), 0, hashlib.sha256(), hashlib.sha256(), 0, 0
                i, m = i.as_py(), m.as_py()
                role, text = own.take_apart(i)
                turns.update(f"{role}\n{text}\n".encode())
                part = own.masked(i, m)
                loss.update(part.encode())
                n, loss_chars, chars = n + 1, loss_chars + len(part), chars + length
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)

    return map_arrow(rows.repartition("conv_id").sortWithinPartitions("conv_id", "position"), run, schema)


#: The conversation that every run of the query adds to the table.
PROBE = (-7, r"\### Assistant: </turn> ok")

#: DuckDB SQL for the query (the template's escapes count in formatted_chars).
ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), joined AS (
  SELECT *, role || chr(1) || text AS whole FROM rows
), counted AS (
  SELECT *, 19 + length(role) + length(text)
    + length(whole) - length(replace(whole, '\', ''))
    + (length(whole) - length(replace(whole, '<turn>', ''))) // 6
    + (length(whole) - length(replace(whole, '<body>', ''))) // 6
    + (length(whole) - length(replace(whole, '</turn>', ''))) // 7 AS chars
  FROM joined
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM counted GROUP BY conv_id
"""
