"""BPE encoding and decoding by dynamic programming over prefixes.

A byte-pair encoding is decided by its adjacent pairs: a token sequence is
the encoding of its text exactly when every two neighbours encode to
themselves.  Hence every prefix of a word has one possible last token.  For
each prefix, an automaton over the vocabulary lists the tokens that are a
suffix of it; the one that is compatible with the last token of the prefix
before it is stored, and the back-pointers give the ids of the word.  The
cost is linear in the word's length, however long the word.

Two tokens are compatible when no merge ever crosses the border between them.
A merge of rank ``r`` crosses it if its left part is on the right edge of the
first token's merge tree, its right part on the left edge of the second's, and
both are still unmerged when ``r`` is applied.

Texts are cut into words as the tokenizer file says (special tokens, NFC,
lower case, its word pattern), and encodings of words are remembered in a
dictionary of bounded size.  Null and empty texts have no ids; any length of
text or word works; rows are independent, so repeated rows and ties need no
rule, and an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, take

#: Fixed value: the word pattern of the tokenizer file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE_AT = re.compile(r"[\x20\x09-\x0D]")
WORDS_KEPT = 100_000
CHUNKS_KEPT = 500_000
PAIRS_KEPT = 300_000
#: Characters that are encoded at once.
PIECE = 3_000_000
FINAL = 0xE000      # private-use block for a word's last byte


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class PrefixBpe:
    """Word encoder: ``encode(word)`` gives the ids of one pre-token (UTF-8 text)."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        import ahocorasick

        symbol = byte_symbols()
        self.suffix = suffix
        self.byte_of = {s: b for b, s in enumerate(symbol)}
        self.inner = {b: symbol[b] for b in range(256)}
        self.last = {b: chr(FINAL + b) for b in range(256)}
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            a, b, whole = vocab[a], vocab[b], vocab[a + b]
            self.parts[whole] = (a, b, rank)
            self.pair[a, b] = rank
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if key := self._key(token):
                self.automaton.add_word(key, (i, len(key)))
        self.automaton.make_automaton()
        self.right: dict[int, list] = {}
        self.left: dict[int, list] = {}
        self.known: dict[int, bool] = {}

    def _key(self, token: str) -> str:
        body = token.removesuffix(self.suffix)
        if any(c not in self.byte_of for c in body) or not body:
            return ""
        if body == token:
            return body
        return body[:-1] + self.last[self.byte_of[body[-1]]]

    def _edge(self, token: int, side: int) -> list[tuple[int, int, float]]:
        """Nodes on one edge of the token's merge tree, with the ranks at which each comes and goes."""
        out, gone = [], float("inf")
        while True:
            parts = self.parts.get(token)
            out.append((token, parts[2] if parts else -1, gone))
            if parts is None:
                return out
            token, gone = parts[side], parts[2]

    def compatible(self, first: int, second: int) -> bool:
        key = first << 20 | second
        known = self.known.get(key)
        if known is None:
            if first not in self.right:
                self.right[first] = self._edge(first, 1)
            if second not in self.left:
                self.left[second] = self._edge(second, 0)
            known = True
            for a, a_from, a_to in self.right[first]:
                for b, b_from, b_to in self.left[second]:
                    rank = self.pair.get((a, b))
                    # equal ranks: the leftmost of two overlapping merges goes first
                    if rank is not None and max(rank, a_from) < a_to and max(rank, b_from) <= b_to and a_from < b_to and b_from < a_to:
                        known = False
            if len(self.known) >= PAIRS_KEPT:
                self.known.clear()
            self.known[key] = known
        return known

    def encode(self, word: str) -> list[int]:
        if word.isascii() and word.isprintable():    # then every byte stands for itself
            symbols = word[:-1] + self.last[ord(word[-1])]
        else:
            raw = word.encode()
            inner = self.inner
            symbols = "".join([inner[b] for b in raw[:-1]]) + self.last[raw[-1]]
        n = len(symbols)
        last: list = [None] * n
        size = [0] * n
        known, compatible = self.known, self.compatible
        for end, (token, length) in self.automaton.iter(symbols):
            if last[end] is None:
                before = end - length
                if before >= 0:
                    first = last[before]
                    ok = known.get(first << 20 | token)
                    if ok is None:
                        ok = compatible(first, token)
                    if not ok:
                        continue
                last[end] = token
                size[end] = length
        out = []
        at = n - 1
        while at >= 0:
            out.append(last[at])
            at -= size[at]
        return out[::-1]


class LibraryBpe:
    """Word encoder that asks the tokenizers library for each new word."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model
        self.symbol = byte_symbols()

    def encode(self, word: str) -> list[int]:
        if not (word.isascii() and word.isprintable()):
            symbol = self.symbol
            word = "".join([symbol[b] for b in word.encode()])
        return [t.id for t in self.model.tokenize(word)]


class Remembered(dict):
    """A dictionary that computes what it lacks, looking into the generation before it first."""

    def __init__(self, compute, old: dict):
        super().__init__()
        self.compute, self.old = compute, old

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def renewed(self, most: int):
        """Itself, or once it holds half of ``most`` entries, a new generation that
        keeps only this one behind it."""
        if 2 * len(self) < most:
            return self
        self.old = {}
        return Remembered(self.compute, self)


class TextCodec:
    """Whole texts to ids and back for one tokenizer file."""

    def __init__(self, path: str, by_library: bool = False):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if split != WORD_PATTERN:
            raise ValueError(f"unknown word pattern {split}")
        self.pattern = regex.compile(split)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.tokens = {i: t for t, i in {**model["vocab"], **self.special}.items()}
        if by_library:
            self.words = LibraryBpe(self.library)
        else:
            merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
            self.words = PrefixBpe(model["vocab"], merges, model["end_of_word_suffix"])
        self.assigned: dict[str, bool] = {}
        self.token_column = None
        # ids are kept packed, four bytes each
        self.word = Remembered(self._word, {})
        self.chunk = Remembered(self._chunk, {})

    def _word(self, word: str) -> bytes:
        return array("i", self.words.encode(word)).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        """Ids of a normalised text without ASCII white space."""
        text = chunk.decode()
        if text.isalpha():
            return self._word(text)
        if text[-1] in ".," and text[:-1].isalpha():
            return self.chunk[chunk[:-1]] + self.word[text[-1]]
        return b"".join([self.word[w] for w in self.pattern.findall(text)])

    def _known(self, text: str) -> bool:
        """Whether Python's Unicode tables have all characters of a text."""
        for c in set(text):
            known = self.assigned.get(c)
            if known is None:
                known = self.assigned[c] = unicodedata.category(c) != "Cn"
            if not known:
                return False
        return True

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit numbers."""
        if not text:
            return b""
        self.word = self.word.renewed(WORDS_KEPT)
        self.chunk = self.chunk.renewed(CHUNKS_KEPT)
        if not any(s in text for s in self.special):
            return self._packed(text)
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += [self._packed(text[at:m.start()]), array("i", [self.special[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._packed(text[at:])])

    def _packed(self, text: str) -> bytes:
        if not text.isascii():
            if not self._known(text):
                # The library's newer tables may class the character; it cuts such texts itself.
                back = {s: b for b, s in enumerate(byte_symbols())}
                plain = self.library.normalizer.normalize_str(text)
                words = [bytes([back[c] for c in w]).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]
                return b"".join([self.word[w] for w in words])
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        # No word crosses white space, so chunks between ASCII white space are encoded by themselves.
        return b"".join(map(self.chunk.__getitem__, text.lower().encode().split()))

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def _plain(self, text: str | None) -> str | None:
        """The normalised text, or None where a text needs the way of ``packed``."""
        if not text:
            return ""
        if any(s in text for s in self.special):
            return None
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower() if self._known(text) else None

    def encode_many(self, texts: list):
        """Ids of all texts in one array, and each text's number of ids.

        Chunks are numbered by Arrow, looked up once each, and their ids are
        laid out by index arithmetic.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        self.word = self.word.renewed(WORDS_KEPT)
        self.chunk = self.chunk.renewed(CHUNKS_KEPT)
        column = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = pc.dictionary_encode(column.flatten())
        keys = coded.dictionary.cast(pa.binary()).to_pylist()
        packed = [self.chunk[k] if k else b"" for k in keys]
        lengths = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        known = np.frombuffer(b"".join(packed), dtype="<i4")
        which = coded.indices.to_numpy(zero_copy_only=False)
        count = lengths[which] if len(lengths) else np.zeros(0, dtype=np.int64)
        ends = np.concatenate(([0], np.cumsum(count)))
        first = (np.cumsum(lengths) - lengths)[which] if len(lengths) else count
        place = np.arange(ends[-1], dtype=np.int32)
        place += np.repeat((first - ends[:-1]).astype(np.int32), count)
        ids = known[place]
        offsets = np.asarray(column.offsets)
        return ids, ends[offsets[1:]] - ends[offsets[:-1]]

    def batches(self, texts):
        """(ids, numbers of ids) for consecutive texts, some PIECE characters at a time."""
        import numpy as np

        waiting, size = [], 0
        for text in texts:
            plain = self._plain(text)
            if plain is not None and len(plain) <= PIECE:
                waiting.append(plain)
                size += len(plain)
                if size >= PIECE:
                    yield self.encode_many(waiting)
                    waiting, size = [], 0
                continue
            if waiting:
                yield self.encode_many(waiting)
                waiting, size = [], 0
            if plain is None:
                ids = np.frombuffer(self.packed(text), dtype="<i4")
            else:
                ids = np.concatenate([self.encode_many([part])[0] for part in pieces(plain)])
            yield ids, np.array([len(ids)])
        if waiting:
            yield self.encode_many(waiting)

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def decode_many(self, column):
        """Texts of an Arrow column of id lists; ids that the vocabulary lacks are left out."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.token_column is None:
            self.token_column = pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], pa.string())
        ids = column.flatten()
        if len(ids) and (pc.min(ids).as_py() < 0 or pc.max(ids).as_py() >= len(self.token_column) or column.null_count):
            return pa.array([self.decode(x or ()) for x in column.to_pylist()], pa.string())
        tokens = self.token_column.take(ids)
        if tokens.null_count:
            return pa.array([self.decode(x) for x in column.to_pylist()], pa.string())
        offsets = pc.subtract(column.offsets, column.offsets[0])
        return pc.binary_join(pa.ListArray.from_arrays(offsets, tokens), " ")


def pieces(text: str):
    """A text cut at white space after some PIECE characters each."""
    at = 0
    while at < len(text):
        cut = SPACE_AT.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


_codecs: dict = {}


def codec(path: str, by_library: bool = False) -> TextCodec:
    """The codec of a file, built once in each Python worker."""
    if (path, by_library) not in _codecs:
        _codecs[path, by_library] = TextCodec(path, by_library)
    return _codecs[path, by_library]


def gathered(batches):
    """Arrow batches put together until they hold PIECE bytes: more chunks then share a lookup."""
    import pyarrow as pa

    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size >= PIECE:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, size = [], 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", by_library: bool = False,
           end_id: int | None = None, decoded: str | None = None) -> DataFrame:
    """``df`` (its columns but the text) with an ``array<int>`` column of token ids.

    ``end_id`` is appended to every row's ids when given.  ``decoded`` names a
    column for the text that the ids decode to, for a round trip in one pass.
    """
    keep = [f for f in df.schema.fields if f.name != text]
    more = [T.StructField(decoded, T.StringType())] if decoded else []
    schema = T.StructType([*keep, T.StructField(ids, T.ArrayType(T.IntegerType())), *more])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        own = codec(path, by_library)
        for batch in gathered(batches):
            texts = (t.as_py() for t in batch.column(text))
            rest = [batch.column(f.name) for f in keep]
            done = 0
            for found, counts in own.batches(texts):
                if end_id is not None:
                    found = np.insert(found, np.cumsum(counts), end_id)
                    counts = counts + 1
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found, pa.int32()))
                back = [own.decode_many(column)] if decoded else []
                yield pa.RecordBatch.from_arrays([*(c.slice(done, len(counts)) for c in rest), column, *back], names=schema.names)
                done += len(counts)

    return map_arrow(df, run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that the tokenizer file gives for the ids of each row."""
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])

    def run(batches):
        import pyarrow as pa

        own = codec(path, True)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, own.decode_many(batch.column(ids))], names=schema.names)

    return map_arrow(df, run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, from encoded and then decoded texts."""
    both = encode(take(docs, "doc_id", "text"), path, decoded="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
