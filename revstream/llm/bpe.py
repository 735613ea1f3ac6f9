"""Byte-level BPE over DataFrames: encode texts to ids and decode ids to texts.

A word holds its symbols and the ranks of its adjacent pairs in two contiguous lists. Merging scans the ranks
for the minimum, deletes that boundary and refreshes the two neighbouring ranks. Words of more than
``LONG_WORD`` symbols use a heap over the same pairs, because repeated scans would be quadratic.

Defined cases: NULL text is empty and has no ids; the special token's own text becomes its id, as in the
tokenizer file; rows are independent, so repeated rows repeat their result; NULL ids decode to the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstream.llm.common import ship, tidied

LONG_WORD = 256
CACHE_CHUNKS = 300_000  # of each of two generations in a Python worker, while a task runs
NEVER = 1 << 60
END_MARKS = frozenset(",.;:!?")
# Fixed value: how the tokenizer file's byte-level step splits a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""


def byte_letters() -> list[str]:
    """The printable stand-in of every byte in the tokenizer file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one byte-level BPE file (its JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.first = [vocab[c] for c in letters]
        self.rank: dict[int, int] = {}
        self.result: list[int] = []
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            if self.rank.setdefault(vocab[a] << 32 | vocab[b], len(self.result)) == len(self.result):
                self.result.append(vocab[a + b])
            else:
                self.result.append(-1)
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(of_letter[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.text_of = [str(i) for i in range(size)]
        self.words = regex.compile(SPLIT)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.inner_space = re.compile(r"\s (?!\S)")
        self.cache: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        if self.specials and self.specials.search(text):
            out: list[int] = []
            for part in self.specials.split(text):
                if part in self.special:
                    out.append(self.special[part])
                elif part:
                    out += self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        """Cut at spaces that begin a word, where the split pattern cuts too, and look the chunks up.

        A text with a space inside a run of white space is split as one chunk.
        """
        if not text:
            return []
        if self.inner_space.search(text):
            return self._split(text)
        head, *rest = text.split(" ")
        cache, out = self.cache, []
        if len(cache) > CACHE_CHUNKS:
            self.older, self.cache = cache, {}
            cache = self.cache
        if head:
            out += self._split(head)
        for piece in rest:
            ids = cache.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    ids = self._chunk(piece)
                if len(piece) < LONG_WORD:
                    cache[piece] = ids
            out += ids
        return out

    def _chunk(self, piece: str) -> list[int]:
        """Ids of a space and ``piece``; letters, perhaps with one mark after them, need no pattern."""
        if piece.isalpha():
            return self.merge(b" " + piece.encode())
        if piece[-1:] in END_MARKS and piece[:-1].isalpha():
            word = piece[:-1]
            ids = self.cache.get(word) or self.older.get(word)
            if ids is None:
                ids = self.merge(b" " + word.encode())
                if len(word) < LONG_WORD:
                    self.cache[word] = ids
            return ids + self.merge(piece[-1].encode())
        return self._split(" " + piece)

    def _split(self, text: str) -> list[int]:
        out: list[int] = []
        for word in self.words.findall(text):
            out += self.merge(word.encode())
        return out

    def merge(self, word: bytes) -> list[int]:
        first, rank, result = self.first, self.rank, self.result
        ids = [first[b] for b in word]
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        ranks = [rank.get(a << 32 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            ids[i] = result[low]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank.get(ids[i - 1] << 32 | ids[i], NEVER)
            if i < len(ranks):
                ranks[i] = rank.get(ids[i] << 32 | ids[i + 1], NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        rank, result, n = self.rank, self.result, len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i) for i in range(n - 1) if (r := rank.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or rank.get(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], ids[j] = result[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (x := rank.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (x, a))
        return [x for x in ids if x >= 0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


_CODECS: dict[str, Codec] = {}


def forget_chunks() -> None:
    """Empty the caches of this Python worker's codec: several idle workers would keep theirs beside other work."""
    for codec in _CODECS.values():
        codec.cache, codec.older = {}, {}


def _codec(source: tuple) -> Codec:
    """The codec of a broadcast tokenizer file, built once in each Python worker and kept between tasks, without its caches."""
    digest, file = source
    if digest not in _CODECS:
        _CODECS.clear()
        _CODECS[digest] = Codec(file.value)
    return _CODECS[digest]


def _file(df: DataFrame, path: str) -> tuple:
    """The tokenizer file (one to two megabytes, whatever the data) for all executors, and its digest."""
    ship(df.sparkSession)
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return hashlib.sha256(text.encode()).hexdigest(), df.sparkSession.sparkContext.broadcast(text)


def _mapped(df: DataFrame, schema: str, one) -> DataFrame:
    """``one(id, value)`` gives a row of ``schema`` for every input row."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = [one(i, x.as_py()) for i, x in zip(part.column(0).to_pylist(), part.column(1))]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([(c, KINDS[k]) for c, k in (x.split() for x in schema.split(", "))]))
        forget_chunks()

    return df.mapInArrow(tidied(run), schema)


KINDS = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every row."""
    source = _file(docs, path)

    def one(i, text):
        ids = _codec(source).encode(text or "")
        return i, len(ids), ids

    return _mapped(docs.select(F.col(id_col).cast("long"), text_col), "doc_id long, n_tokens long, ids array<int>", one)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of every row of ids."""
    source = _file(tokens, path)
    return _mapped(tokens.select(F.col(id_col).cast("long"), ids_col), "doc_id long, text string", lambda i, ids: (i, _codec(source).decode(ids or [])))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: token count, digest of the ids (decimal, comma-joined) and of the decoded text."""
    source = _file(docs, path)

    def one(i, text):
        codec = _codec(source)
        ids = codec.encode(text or "")
        listed = ",".join(map(codec.text_of.__getitem__, ids))
        row = i, len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()
        return (*row, ids) if with_ids else row

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _mapped(docs.select(F.col(id_col).cast("long"), text_col), schema, one)
