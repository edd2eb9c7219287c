"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

The last token of a prefix's encoding is unique. For each prefix of a word the tokens
that end there are found by walking a suffix automaton of the vocabulary backwards; the
one whose pair with the last token of the prefix before it is compatible (no merge would
ever cross their border) is stored, and back-pointers give the ids.

The tables come from a vocabulary file in the tokenizers format, read once and broadcast;
their size is the file's. Null text: empty, no tokens. Special tokens' strings in a text
become their ids, as the library does by default.
"""

from __future__ import annotations

import gc
import hashlib
import json
import pickle
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Words whose encodings a task remembers at a time.
REMEMBERED = 500_000
#: Texts whose new words are encoded together.
SLICE = 1000
NEVER = 1 << 60


def byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in plain else chr(next(spare)) for b in range(256))


class Vocabulary:
    """Tokens, merges and the automaton of one vocabulary file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.inner = {t: i for t, i in vocab.items() if not (self.end and t.endswith(self.end))}
        self.final = {t[: -len(self.end)]: i for t, i in vocab.items() if t.endswith(self.end)} if self.end else self.inner
        self.rank, self.parts = {}, {}
        for k, (a, b) in enumerate(model["merges"]):
            pair = vocab[a], vocab[b]
            self.rank[pair] = k
            self.parts[vocab[a + b]] = (*pair, k)
        self.known: dict[int, dict[int, bool]] = {}
        self.alone: dict[int, bool] = {}
        self.memory: dict[str, tuple[bytes, str]] = {}
        self.chunks: dict[str, tuple[bytes, str]] = {}
        self.root = None

    def automaton(self) -> list:
        """States of the reversed tokens: [next state by letter, inner token, final token]."""
        if self.root is None:
            self.root = [{}, None, None]
            for kind, tokens in ((1, self.inner), (2, self.final)):
                for token, number in tokens.items():
                    if self.whole(number):
                        state = self.root
                        for letter in reversed(token):
                            state = state[0].setdefault(letter, [{}, None, None])
                        state[kind] = number
            gc.freeze()  # many small objects that stay: keep the collector from walking them again and again
        return self.root

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that takes it up) down the left or right edge."""
        out, taken = [], NEVER
        while True:
            out.append((token, taken))
            if token not in self.parts:
                return out
            *both, taken = self.parts[token]
            token = both[side]

    def crosses(self, left: int, right: int, before: int) -> bool:
        """Whether some merge of a rank below `before` would join the two tokens."""
        rights = self.edge(right, 0)
        for a, a_taken in self.edge(left, 1):
            for b, b_taken in rights:
                r = self.rank.get((a, b), NEVER)
                # equal ranks: the pair further left is merged first
                if r < before and r < a_taken and r <= b_taken:
                    return True
        return False

    def whole(self, token: int) -> bool:
        """Whether the token's own letters encode to it."""
        got = self.alone.get(token)
        if got is None:
            if token in self.parts:
                a, b, rank = self.parts[token]
                got = self.whole(a) and self.whole(b) and not self.crosses(a, b, rank)
            else:
                got = True
            self.alone[token] = got
        return got

    def compatible(self, left: int, right: int) -> bool:
        """Whether both stay apart when they stand side by side."""
        beside = self.known.setdefault(left, {})
        got = beside.get(right)
        if got is None:
            got = beside[right] = not self.crosses(left, right, NEVER)
        return got

    def last_token(self, word: str, end: int, kind: int, last: list) -> tuple[int, int]:
        """(last token, where it starts) of the encoding of word[:end]."""
        state, start = self.automaton(), end - 1
        while start >= 0:
            state = state[0].get(word[start])
            if state is None:
                break
            token = state[kind]
            if token is not None and (start == 0 or (last[start] >= 0 and self.compatible(last[start], token))):
                return token, start
            start -= 1
        return -1, 0

    def encode_sorted(self, words: list[str]):
        """Ids of words given in byte letters and in order, so that prefixes are shared."""
        before, last, back = "", [-1], [0]
        for word in words:
            n = len(word)
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            same = min(same, len(last) - 1)
            del last[same + 1 :], back[same + 1 :]
            for end in range(same + 1, n):
                token, start = self.last_token(word, end, 1, last)
                last.append(token)
                back.append(start)
            token, at = self.last_token(word, n, 2, last)
            out = []
            while True:
                if token < 0:
                    raise ValueError(f"the vocabulary does not cover {word!r}")
                out.append(token)
                if at == 0:
                    break
                token, at = last[at], back[at]
            yield out[::-1]
            before = word


def lower(text: str) -> str:
    """Lower case letter by letter (a final sigma is not treated apart)."""
    return text.replace("Σ", "σ").lower()


class Encoder:
    """Texts to ids; remembers a bounded number of words beside the vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        import regex

        self.split = regex.compile(vocabulary.pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")").split if vocabulary.special else None
        self.letters = dict(enumerate(byte_letters()))

    def learn(self, words: set[str]) -> None:
        """Encode words that are not in memory."""
        v = self.vocabulary
        coded = sorted((w.encode().decode("latin-1").translate(self.letters), w) for w in words)
        for (_, word), ids in zip(coded, v.encode_sorted([c for c, _ in coded]), strict=True):
            v.memory[word] = struct.pack(f"<{len(ids)}I", *ids), " ".join([v.names[i] for i in ids])

    def texts(self, texts: list[str | None]):
        """(ids as little-endian 32-bit integers, tokens joined by a space) of each text.

        No word crosses white space, so the stretches between white space are looked up
        whole; those not in memory are split into words, and new words encoded in order.
        """
        v = self.vocabulary
        if len(v.memory) + len(v.chunks) > REMEMBERED:
            for held in (v.memory, v.chunks, v.known):
                held.clear()
        for name, number in v.special.items():
            v.chunks[name] = struct.pack("<I", number), name
        found, split = [], {}
        for text in texts:
            text = text or ""
            if any(name in text for name in v.special):
                chunks = []
                for part in self.parts(text):
                    chunks += [part] if part in v.special else self.chunks_of(part)
            else:
                chunks = self.chunks_of(text)
            got = list(map(v.chunks.get, chunks))
            if None in got:
                for chunk, known in zip(chunks, got, strict=True):
                    if known is None and chunk not in split:
                        split[chunk] = self.split(chunk)
            found.append((chunks, got))
        self.learn({w for some in split.values() for w in some if w not in v.memory})
        for chunk, some in split.items():
            if len(some) == 1:
                v.chunks[chunk] = v.memory[some[0]]
            else:
                both = [v.memory[w] for w in some]
                v.chunks[chunk] = b"".join([x[0] for x in both]), " ".join([x[1] for x in both])
        for chunks, got in found:
            if None in got:
                got = list(map(v.chunks.__getitem__, chunks))
            yield b"".join([x[0] for x in got]), " ".join([x[1] for x in got])

    def chunks_of(self, text: str) -> list[str]:
        """The stretches between white space of a text, normalised."""
        text = lower(text if text.isascii() else unicodedata.normalize("NFC", text))
        # these four are white space to str.split but not to the vocabulary's pattern
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.split(text)
        return text.split()


def decode(ids: bytes, names: dict[int, str]) -> str:
    """The text the library's decode gives without a decoder: tokens joined by a space."""
    return " ".join(names[i] for i in np.frombuffer(ids, "<u4").tolist())


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) for every row: ids as little-endian 32-bit integers."""
    return _encoded(docs, vocabulary_path, id_col, text_col, False)


def digest_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) for every row."""
    return _encoded(docs, vocabulary_path, id_col, text_col, True)


def _encoded(docs, vocabulary_path, id_col, text_col, digest):
    with open(vocabulary_path, encoding="utf-8") as file:
        # sent by value in the one list that a worker keeps, so that it needs no package; what
        # it remembers stays with the vocabulary it makes of that, from task to task
        shared = docs.sparkSession.sparkContext.broadcast([cloudpickle.dumps(Vocabulary(file.read()))])
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        if isinstance(shared.value[0], bytes):
            shared.value[0] = pickle.loads(shared.value[0])
        encoder = Encoder(shared.value[0])
        names = encoder.vocabulary.names
        for batch in batches:
            out = [[], [], []]
            for ids, joined in (pair for at in range(0, batch.num_rows, SLICE) for pair in encoder.texts(batch.column(1).slice(at, SLICE).to_pylist())):
                if digest:
                    # words were decoded when they were first met; joining them decodes the text
                    row = len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(joined.encode()).hexdigest()
                else:
                    row = len(ids) // 4, ids, decode(ids, names)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.string() if digest else pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))], names=["id", *columns])

    columns = ["n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["n_tokens", "ids", "decoded"]
    kinds = "long", "string" if digest else "binary", "string"
    schema = ", ".join([f"id {own.schema['id'].dataType.simpleString()}", *(f"{c} {k}" for c, k in zip(columns, kinds, strict=True))])
    return own.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_bpe(spark, folder: str) -> DataFrame:
    return digest_documents(table(spark, folder, "documents"), public_vocabulary())
