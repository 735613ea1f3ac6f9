"""Substring dedup over words by fixed-block anchors.

Non-overlapping blocks of ``BLOCK`` words of every text (at multiples of ``BLOCK``) form the index; every rolling
window of ``BLOCK`` words of every text probes it. A run of ``WINDOW`` = 2 * ``BLOCK`` words always holds a whole
block, so each repeated window holds a hit in all its copies. Hits are extended to the windows around them, and
a word goes when it lies in a window whose words also start earlier: at a smaller id, or in the same text
further left. Windows are judged on the input.

Defined cases: NULL text has no words; texts of fewer than ``WINDOW`` words lose nothing; a periodic text repeats
itself and keeps its first window; equal rows are one document and have the same result; rows that share only
the id are ordered by a hash; documents without an id come last; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstream.llm import segments
from revstream.llm.common import WordHasher, repeated_places, rolling, texts

BLOCK, WINDOW = 10, 20
NONE = np.iinfo(np.uint64).max
_HASHER: list[WordHasher] = []


def hasher() -> WordHasher:
    if not _HASHER:
        _HASHER.append(WordHasher())
    return _HASHER[0]


def block_hashes(words: bytes) -> np.ndarray:
    return rolling(hasher().words(words)[2], BLOCK)


def probes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every run of ``BLOCK`` words, of texts that have a whole window."""
    h = block_hashes(text.encode())
    if len(h) <= WINDOW - BLOCK:
        h = h[:0]
    return h, np.arange(len(h), dtype=np.uint32)


def word_bounds(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text with single spaces."""
    gaps = np.flatnonzero(np.frombuffer(body, dtype=np.uint8) == 32)
    return np.concatenate([[0], gaps + 1]), np.append(gaps, len(body))


def extend(text: str, places: np.ndarray) -> tuple[bytes, list[tuple]]:
    """The words joined by one space, and the windows around hits as segments that share an anchor.

    A window's anchor is its hit with the smallest hash.
    """
    body = b" ".join(text.encode().split())
    starts, ends, h = hasher().words(body)
    h = rolling(h, BLOCK)
    places = places[places < len(h)]
    value = np.full(len(h), NONE, dtype=np.uint64)
    value[places] = np.minimum(h[places], NONE - np.uint64(1))
    own = segments.owners(value, WINDOW - BLOCK + 1)
    hit = value[own] != NONE
    begin = np.flatnonzero(np.diff(np.where(hit, own, -1), prepend=-2))
    size = np.diff(np.append(begin, len(own)))
    begin, size = begin[hit[begin]], size[hit[begin]]
    anchor = own[begin]
    columns = h[anchor].view(np.int64), begin, size, starts[begin], ends[begin + size + WINDOW - 2], anchor - begin
    return body, list(zip(*(c.tolist() for c in columns)))


def windows(body: bytes, look: list) -> Iterator[tuple[int, bytes]]:
    starts, ends = word_bounds(body)
    for s in look:
        for w in range(s["first"], s["first"] + s["n"]):
            yield w, body[starts[w] : ends[w + WINDOW - 1]]


def render(body: bytes, runs: np.ndarray) -> tuple[int, bytes]:
    starts, ends = word_bounds(body)
    gone = segments.covered_mask(runs, WINDOW, len(starts))
    return int(gone.sum()), b" ".join(body[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist()))


def kept_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(id, rk, text)`` of every row, and ``(rk, n_removed, kept)`` of the texts that lose words."""
    source = texts(docs, id_col, text_col)
    hits = repeated_places(source, probes, bytes_per_entry=6, index_step=BLOCK, settle=False)
    found = segments.candidate_texts(source, hits, extend)
    covered, closer = segments.resolve(found)
    more = segments.repeated_windows(segments.with_bodies(closer, found), windows)
    return source, segments.without_covered(found, covered.union(more), render, "n_removed long, kept binary")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with the kept words joined by one space."""
    source, changed = kept_words(docs, id_col, text_col)
    words = F.btrim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    return source.join(changed, "rk", "left").select(F.col("id").alias("doc_id"), F.coalesce(F.decode("kept", "UTF-8"), words).alias("text"))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, rk``, the number of words, and the digest of the words joined by one space."""
    for batch in batches:
        sizes, digests = [], []
        for text in batch.column("text").cast(pa.binary()):
            words = text.as_py().split()
            sizes.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("rk"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], names=["id", "rk", "n", "whole"])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    source, changed = kept_words(docs, id_col, text_col)
    plain = source.mapInArrow(counted, "id long, rk long, n long, whole string")
    short = changed.select("rk", "n_removed", F.sha2("kept", 256).alias("kept"))
    return plain.join(short, "rk", "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_words"), F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                                                  F.coalesce("kept", "whole").alias("kept_sha256"))
