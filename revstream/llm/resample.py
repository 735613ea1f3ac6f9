"""Importance resampling towards a target: hashed n-gram gains, Gumbel scores, the highest are drawn.

Arrow kernels do the text work per slice of a batch: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten``
and ``dictionary_encode``. An n-gram is a pair of a shorter n-gram's index and the next word's, formed by shifting
the dictionary's indices; only distinct pairs meet the CRC, which goes on from the shorter one's. Gains are taken
by bucket and reduced per document.

Every document is read twice: once for the corpus's counts (a table of ``BUCKETS`` rows at most, so it may travel
to every task), once for the weights. Words of long documents come in pieces that carry the last two words.

Ranks of the drawn documents are global: rows are dealt by ranges of the order, counted per range, and numbered
within their range from where it begins.

Defined cases: NULL text has no words; a document without an id hashes as an empty id and comes after all others
among equal scores; equal rows are documents of their own; empty tables have no features (gains then compare with
the uniform distribution); with no document long enough nothing is drawn; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstream.llm.common import partitions, ship, stored

BUCKETS = 10_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing A-Z
ORDERS = 3
SLICE = 4_000_000  # bytes of text whose words are encoded together
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def pieces(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Texts, the number of their document within the task, and how many words of each were counted before.

    Groups hold about ``size`` bytes. A longer text is cut between words; a piece begins with the last two words
    of the one before it, which its n-grams need and must not count again.
    """
    texts, docs, carried, held, doc = [], [], [], 0, -1
    for batch in batches:
        for value in batch.column("text"):
            doc += 1
            text, carry = value.as_py() or "", []
            while True:
                gap = _GAP.search(text, size) if len(text) > size else None
                head, text = (text[: gap.start()], text[gap.start() :]) if gap else (text, "")
                texts.append(" ".join([*carry, head]))
                docs.append(doc)
                carried.append(len(carry))
                held += len(head)
                if held >= size:
                    yield pa.array(texts, pa.large_string()), np.array(docs), np.array(carried)
                    texts, docs, carried, held = [], [], [], 0
                if not text:
                    break
                carry = [*carry, *last_words(head)][-(ORDERS - 1) :]
    if texts:
        yield pa.array(texts, pa.large_string()), np.array(docs), np.array(carried)


def last_words(text: str) -> list[str]:
    """The last two words, looked for from the end."""
    found, end = [], len(text)
    while len(found) < ORDERS - 1 and end > 0:
        while end > 0 and _GAP.match(text, end - 1):
            end -= 1
        start = end
        while start > 0 and not _GAP.match(text, start - 1):
            start -= 1
        if end > start:
            found.insert(0, text[start:end])
        end = start
    return found


def features(texts: pa.Array, carried: np.ndarray, buckets: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words per text, and per order of n-grams the text and the bucket of every n-gram, repeats included."""
    words = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)
    parent, flat = pc.list_parent_indices(words), pc.list_flatten(words)
    filled = pc.greater(pc.binary_length(flat), 0)
    parent, flat = parent.filter(filled).to_numpy().astype(np.int64), flat.filter(filled)
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    n_words = np.bincount(parent, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    fresh = np.arange(len(index)) - first[parent] >= carried[parent]
    plain = coded.dictionary.cast(pa.large_binary()).to_pylist()
    spaced = [b" " + w for w in plain]
    crcs, gram, where, found = [zlib.crc32(w) for w in plain], index, [], []
    for order in range(1, ORDERS + 1):
        if order > 1:  # the n-gram before, shifted against the word that follows
            after = index[order - 1 :]
            pair = gram[: len(after)] * len(spaced) + after
            same = parent[: len(after)] == parent[order - 1 :]
            distinct = pa.array(pair).dictionary_encode()
            gram, keys = distinct.indices.to_numpy().astype(np.int64), distinct.dictionary.to_numpy()
            shorter, word = (keys // len(spaced)).tolist(), (keys % len(spaced)).tolist()
            crcs = [zlib.crc32(spaced[w], crcs[s]) for s, w in zip(shorter, word)]
        else:
            after, same = index, np.ones(len(index), dtype=bool)
        counted = same & fresh[order - 1 :]
        bucket = (np.array(crcs, dtype=np.uint32) % np.uint32(buckets)).astype(np.int64)
        found.append(pc.take(pa.array(bucket), pa.array(gram[counted])).to_numpy())
        where.append(parent[: len(after)][counted])
    return n_words - np.minimum(carried, n_words), where, found


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, slice_bytes: int = SLICE) -> DataFrame:
    """``(bucket, n)``: features of all texts by bucket; tasks add up their own before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for texts, _, carried in pieces(batches, slice_bytes):
            for bucket in features(texts, carried, buckets)[2]:
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    ship(docs.sparkSession)
    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def counts_array(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counts.collect():  # at most `buckets` rows, whatever the data
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the thousandfold log ratio of its smoothed shares in target and source, rounded down."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([floor(1000 * log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)))) for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(gain)
        ids: list = []  # of the documents whose sums are not complete
        sums = np.zeros((0, 3), dtype=np.int64)
        done = 0

        def tee(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                ids.extend(batch.column("id").to_pylist())
                yield batch

        def out(n: int) -> pa.RecordBatch:
            columns = [pa.array(ids[:n], pa.int64()), *(pa.array(sums[:n, i]) for i in range(3))]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

        for texts, number, carried in pieces(tee(batches), slice_bytes):
            n_words, where, found = features(texts, carried, buckets)
            if len(sums) < len(ids):
                sums = np.concatenate([sums, np.zeros((len(ids) - len(sums), 3), dtype=np.int64)])
            at = number - done
            np.add.at(sums[:, 0], at, n_words)
            for parent, bucket in zip(where, found):
                if not len(parent):
                    continue
                begin = np.flatnonzero(np.diff(parent, prepend=-1))
                own = at[parent[begin]]
                np.add.at(sums[:, 1], own, np.diff(np.append(begin, len(parent))))
                np.add.at(sums[:, 2], own, np.add.reduceat(pc.take(table, pa.array(bucket)).to_numpy(), begin))
            whole = int(at[-1])  # the last document may have more pieces
            if whole:
                yield out(whole)
                del ids[:whole]
                sums, done = sums[whole:], done + whole
        if ids:
            yield out(len(ids))

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: int) -> Column:
    """Thousandfold Gumbel noise of a document, from a hash of seed and id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(df: DataFrame, order: list[Column], first: int) -> DataFrame:
    """``df`` with ``rank``, from 1 in ``order`` for the ``first`` rows and NULL beyond; no task sees all rows."""
    dealt = stored(df.repartitionByRange(partitions(df.sparkSession), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dict(dealt.groupBy("_range").count().collect())  # one row per range
    begins, before = [], 0
    for i in sorted(sizes):
        if before < first:
            begins.append((i, before))
        before += sizes[i]
    last = begins[-1][0] if begins else -1
    within = Window.partitionBy("_range").orderBy(*order)
    starts = df.sparkSession.createDataFrame(begins, "_range int, _before long")
    rank = F.col("_before") + F.row_number().over(within)
    top = dealt.filter(F.col("_range") <= last).join(F.broadcast(starts), "_range").withColumn("rank", rank)
    top = top.withColumn("rank", F.when(F.col("rank") <= first, F.col("rank")))
    rest = dealt.filter(F.col("_range") > last).withColumn("rank", F.lit(None).cast("long"))
    return top.select(*df.columns, "rank").union(rest.select(*df.columns, "rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    min_words: int = 20,
    percent: int = 5,
    seed: int = 42,
    buckets: int = BUCKETS,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every row of ``docs``; ``rank`` is NULL where not drawn."""
    source = counts_array(bucket_counts(docs, text_col, buckets, slice_bytes), buckets)
    aim = counts_array(bucket_counts(target, target_col, buckets, slice_bytes), buckets)
    scored = stored(weights(docs, gains(source, aim), id_col, text_col, slice_bytes).withColumn("score", F.col("weight") + gumbel("doc_id", seed)), "scored")
    long_enough = F.col("n_words") >= min_words
    draw = percent * scored.filter(long_enough).count() // 100
    order = [long_enough.desc(), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("n_words")]
    return ranked(scored, order, draw)
