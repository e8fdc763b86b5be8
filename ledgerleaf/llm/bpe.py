"""Byte-pair encoding and decoding with the vocabulary of a public tokenizer.

Method: merge rounds over many words at once. The symbols of all words that are
not known yet lie in one flat array. Every round finds the rank of each adjacent
pair by binary search over the sorted pair keys, takes the lowest rank of each
word and merges its occurrences from left to right, until no pair is left.

Spark deals out the rows; a task sees Arrow batches and cuts them to a few MB of
text. Encoded words are kept in a pool that is emptied when it is full, so its
memory is bounded and the result does not depend on it.

Nulls and empty texts have no tokens. Repeated rows each get their result, other
columns of the input are not looked at.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ledgerleaf.llm.common import by_size

NO_RANK = np.int64(1 << 40)
POOL_WORDS = 100_000
ROUND_BYTES = 1 << 19
BATCH_BYTES = 1 << 20
# White space as the vocabulary's own splitting rule knows it.
SPACE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")
CHUNKS = regex.compile(rf"[^{SPACE}]+")
SPLIT_TOO_MUCH = regex.compile("[\x1c-\x1f]")


def _byte_names() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the rest above it."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tokens, merge rules and special tokens of a tokenizer file with word ends."""

    def __init__(self, path: str) -> None:
        data = _read(path)
        ids: dict[str, int] = data["model"]["vocab"]
        suffix = data["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        names = _byte_names()
        self.byte_of = {name: b for b, name in enumerate(names)}
        self.path = path
        self.inner = np.array([ids[n] for n in names], np.int64)
        self.last = np.array([ids[n + suffix] for n in names], np.int64)
        self.base = np.int64(max(ids.values()) + 1)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        keys = np.array([ids[a] * int(self.base) + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def pieces(self, chunk: str) -> list[bytes]:
        """The words that merges stay within, of a text without white space."""
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower().encode()]
        elif any(unicodedata.category(c) in ("Cn", "Mn", "Mc", "Me") for c in chunk):
            # Unicode versions differ in these: the tokenizer's own rules say what they are.
            rules = load_rules(self.path)
            parts = rules.pre_tokenizer.pre_tokenize_str(rules.normalizer.normalize_str(chunk))
            return [bytes(map(self.byte_of.__getitem__, part)) for part, _ in parts]
        own = PIECES.findall(_lower(unicodedata.normalize("NFC", chunk)))
        return [p.encode("utf-8") for p in own]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, by binary search over the sorted keys."""
        wanted = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_rank[at], NO_RANK)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in a row, and the number of tokens of each word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbols), NO_RANK)
        rank[:-1] = np.where(word[:-1] == word[1:], self.ranks(symbols[:-1], symbols[1:]), NO_RANK)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(rank, starts)
            finished = lowest == NO_RANK
            if finished.any():
                out = np.repeat(finished, sizes)
                done.append((word[out], symbols[out]))
                symbols, word, rank = symbols[~out], word[~out], rank[~out]
                sizes, lowest = sizes[~finished], lowest[~finished]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # Of overlapping occurrences (a a a) every second one counts, from the left.
            fresh = np.r_[True, np.diff(hits) > 1]
            run_start = hits[np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))]
            hits = hits[(hits - run_start) % 2 == 0]
            symbols[hits] = self.merged[rank[hits]]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            at = hits - np.arange(len(hits))
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                j = np.minimum(i + 1, len(symbols) - 1)
                inside = (j > i) & (word[i] == word[j])
                rank[i] = np.where(inside, self.ranks(symbols[i], symbols[j]), NO_RANK)
        if not done:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        owner = np.concatenate([w for w, _ in done])
        tokens = np.concatenate([s for _, s in done])
        return tokens[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def _lower(text: str) -> str:
    # Character by character: a sigma at the end of a word stays the usual one.
    return text.replace("Σ", "σ").lower()


class _Codes(dict):
    """Numbers for words in order of appearance; ``new`` collects those not encoded yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


class Encoder:
    """Encodes texts; what it remembers of earlier words is bounded."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.pool = np.empty(0, np.int32)
        self.begin = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)

    def _chunks(self, text: str) -> list[str]:
        if "<|" not in text:
            return CHUNKS.findall(text) if SPLIT_TOO_MUCH.search(text) else text.split()
        found: list[str] = []
        for i, part in enumerate(self.vocabulary.special_split.split(text)):
            if i % 2:
                found.append("\n" + part)  # no chunk holds white space
            else:
                found += CHUNKS.findall(part)
        return found

    def _learn(self) -> None:
        """Encode the new chunks in rounds of a bounded number of bytes."""
        new, self.codes.new = self.codes.new, []
        pieces: list[bytes] = []
        per_chunk: list[int] = []
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def flush() -> None:
            tokens, sizes = self.vocabulary.merge(pieces) if pieces else (np.empty(0, np.int64), [])
            ends = np.r_[0, np.cumsum(sizes)].astype(np.int64)
            bounds = np.r_[0, np.cumsum(per_chunk)].astype(np.int64)
            counts.append(np.diff(ends[bounds]))
            ids.append(tokens)
            pieces.clear()
            per_chunk.clear()

        held = 0
        for chunk in new:
            if chunk[0] == "\n":
                flush()
                ids.append(np.array([self.vocabulary.special[chunk[1:]]], np.int64))
                counts.append(np.ones(1, np.int64))
                continue
            own = self.vocabulary.pieces(chunk)
            pieces += own
            per_chunk.append(len(own))
            held += len(chunk)
            if held > ROUND_BYTES:
                flush()
                held = 0
        flush()
        fresh = np.concatenate(counts).astype(np.int64)
        first = len(self.pool) + np.r_[0, np.cumsum(fresh)[:-1]] if len(fresh) else fresh
        self.begin = np.concatenate([self.begin, first])
        self.count = np.concatenate([self.count, fresh])
        self.pool = np.concatenate([self.pool, *[i.astype(np.int32) for i in ids]])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offsets of the texts in it."""
        if len(self.codes) > POOL_WORDS:
            self._forget()
        look_up = self.codes.__getitem__
        coded = [
            np.fromiter(map(look_up, chunks), np.int64, len(chunks))
            for chunks in (self._chunks(t) if t else [] for t in texts)
        ]
        if self.codes.new:
            self._learn()
        codes = np.concatenate(coded) if coded else np.empty(0, np.int64)
        sizes = self.count[codes]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.begin[codes] - (ends - sizes), sizes)
        ids = self.pool[shift + np.arange(len(shift))]
        words_end = np.cumsum([len(c) for c in coded], dtype=np.int64)
        return ids, np.r_[0, np.r_[0, ends][words_end]] if coded else np.zeros(1, np.int64)


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(maxsize=1)
def load_rules(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def load_tokens(path: str) -> np.ndarray:
    """The text of each token, by id."""
    data = _read(path)
    ids = [*data["model"]["vocab"].items(), *((t["content"], t["id"]) for t in data["added_tokens"])]
    tokens = np.full(max(i for _, i in ids) + 1, "", object)
    for token, i in ids:
        tokens[i] = token
    return tokens


@lru_cache(maxsize=1)
def load_vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def bpe_encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its key and ``ids``, the token ids of the whole text.

    ``path`` names the tokenizer file on every machine. Texts are brought to
    composed form and lower case; the file's special tokens in a text are one
    token each.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_vocabulary(path))
        for batch in by_size(batches, "text", BATCH_BYTES):
            ids, offsets = encoder.encode(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["key", "ids"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(encode, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def bpe_decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the tokens of ``ids`` joined by blanks, special ones included.

    That is what decoding gives for a tokenizer file without a decoder of its
    own. Null ids decode to an empty text. A column named ``decoded`` is replaced.
    """

    rows = rows.drop("decoded")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load_tokens(path)
        for batch in by_size(batches, ids, BATCH_BYTES):
            texts = []
            for own in batch.column(batch.schema.get_field_index(ids)):
                texts.append(" ".join(tokens[own.values.to_numpy()]) if own.is_valid else "")
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(decode, schema)


def joined_ids(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")
