"""Repeats across texts, found without pairs of texts.

A text is covered by windows of fixed length. Anchors are places chosen by content alone, so equal windows have
the same anchor at the same place in them; the windows that share an anchor form a segment. Of equal segments
all but the first (by id, then place) consist of windows that start earlier elsewhere. Only the first
occurrences of different segments around equal anchors need a closer look, and the operators differ in how they
look. A hot passage leaves every task as one row per segment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstream.llm.common import id_order, stored

PLACE = "o", "rk", "first"


def owners(value: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the minimum of every ``width`` consecutive entries, by doubling."""
    n = len(value) - width + 1
    v, at, have = value, np.arange(len(value), dtype=np.int64), 1
    while have < width:
        step = min(have, width - have)
        m = len(v) - step
        right = v[step : step + m] < v[:m]
        v, at = np.where(right, v[step : step + m], v[:m]), np.where(right, at[step : step + m], at[:m])
        have += step
    return at[:n]


def candidate_texts(source: DataFrame, hits: DataFrame, cut: Callable[[str, np.ndarray], tuple]) -> DataFrame:
    """Texts with hits, their bodies and segments: ``(o, rk, body, segments)``.

    ``cut(text, places)`` gives the body (bytes) and, per segment, anchor hash, first window, windows, and the
    bounds of its bytes in the body together with the anchor's offset in it (``at``).
    """
    kind = pa.list_(pa.struct([("ah", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("at", pa.int64())]))

    digest = xxhash.xxh3_128_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                bodies, sizes, found, digests = [], [0], [], []
                for text, places in zip(part.column("text"), part.column("place").to_pylist()):
                    body, segments = cut(text.as_py(), np.unique(np.frombuffer(places, dtype=np.uint32)).astype(np.int64))
                    bodies.append(body)
                    sizes.append(sizes[-1] + len(segments))
                    found += segments
                    digests += [digest(body[a:b], anchor) for _, _, _, a, b, anchor in segments]
                h = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                ah, first, n, _, _, at = np.array(found, dtype=np.int64).reshape(-1, 6).T
                columns = [pa.array(np.ascontiguousarray(c)) for c in (ah, h[:, 0], h[:, 1], first, n, at)]
                lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(kind.value_type)))
                yield pa.RecordBatch.from_arrays([part.column("o"), part.column("rk"), pa.array(bodies, pa.binary()), lists], names=["o", "rk", "body", "segments"])

    rows = source.join(hits, "rk").select(id_order().alias("o"), "rk", "text", "place")
    return stored(rows.mapInArrow(run, "o long, rk long, body binary, segments array<struct<ah:long,h1:long,h2:long,first:long,n:long,at:long>>"), "candidates")


def resolve(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rk, first, n)`` runs of windows known to start earlier, and first occurrences to look at more closely.

    The latter, ``(ah, o, rk, first, n, at, several)``, are segments whose anchor also stands in a different segment;
    ``several`` is the number of different segments of the anchor.
    """
    each = candidates.select("o", "rk", F.explode("segments").alias("s")).select("o", "rk", "s.*")
    place = F.struct(*PLACE)
    distinct = stored(each.groupBy("ah", "h1", "h2").agg(F.min(place).alias("p"), F.max(place).alias("q"), F.first("n").alias("n"), F.first("at").alias("at")), "distinct")
    again = distinct.filter("p <> q").select("ah", "h1", "h2", "p")
    covered = each.join(again, ["ah", "h1", "h2"]).filter(place != F.col("p")).select("rk", "first", "n")
    several = stored(distinct.groupBy("ah").agg(F.count("*").alias("several")).filter("several > 1"), "several")
    closer = distinct.join(several, "ah").select("ah", "p.o", "p.rk", "p.first", "n", "at", "several")
    return covered, stored(closer, "closer")


def with_bodies(closer: DataFrame, candidates: DataFrame) -> DataFrame:
    """Segments to look at, gathered by text beside the text's body: one row per text."""
    # Equal rows are one document: their segments are given once, and looking twice changes nothing.
    mine = stored(closer.groupBy("rk").agg(F.collect_list(F.struct("ah", "first", "n", "at", "several")).alias("look")), "look")
    return candidates.select("o", "rk", "body").join(mine, "rk")


def repeated_windows(rows: DataFrame, windows: Callable[[bytes, list], Iterator[tuple]]) -> DataFrame:
    """``(rk, first, n)`` of windows whose bytes also start earlier, by their 128-bit hashes.

    ``windows(body, look)`` gives the first window's number and the bytes of each window of the segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 50):
                part = batch.slice(i, 50)
                out: list[tuple] = []
                for o, rk, body, look in zip(*(part.column(c).to_pylist() for c in ("o", "rk", "body", "look"))):
                    for start, window in windows(body, look):
                        h = np.frombuffer(xxhash.xxh3_128_digest(window), dtype=np.int64)
                        out.append((o, rk, start, h[0], h[1]))
                columns = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["o", "rk", "first", "h1", "h2"])

    each = stored(rows.mapInArrow(run, "o long, rk long, first long, h1 long, h2 long"), "windows")
    place = F.struct(*PLACE)
    firsts = stored(each.groupBy("h1", "h2").agg(F.min(place).alias("p"), F.max(place).alias("q")).filter("p <> q").select("h1", "h2", "p"), "window-firsts")
    return each.join(firsts, ["h1", "h2"]).filter(place != F.col("p")).select("rk", "first", F.lit(1).cast("long").alias("n"))


def without_covered(candidates: DataFrame, covered: DataFrame, render: Callable[[bytes, np.ndarray], tuple], schema: str) -> DataFrame:
    """``rk`` and ``render(body, runs)`` of the texts that lose something; runs are rows of (first window, windows)."""
    runs = stored(covered.groupBy("rk").agg(F.collect_set(F.struct("first", "n")).alias("runs")), "runs")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 50):
                part = batch.slice(i, 50)
                rows = [(rk, *render(body, np.array([(r["first"], r["n"]) for r in found], dtype=np.int64)))
                        for rk, body, found in zip(*(part.column(c).to_pylist() for c in ("rk", "body", "runs")))]
                columns = list(zip(*rows)) if rows else [[]] * (len(names) + 1)
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(columns, ["long", *(x.split()[1] for x in schema.split(", "))])], names=["rk", *names])

    out = candidates.select("rk", "body").join(runs, "rk").mapInArrow(run, f"rk long, {schema}")
    return stored(out.dropDuplicates(["rk"]), "rendered")


def covered_mask(runs: np.ndarray, window: int, length: int) -> np.ndarray:
    """Which of ``length`` units lie in a covered window."""
    delta = np.zeros(length + 1, dtype=np.int64)
    np.add.at(delta, runs[:, 0], 1)
    np.add.at(delta, np.minimum(runs[:, 0] + runs[:, 1] - 1 + window, length), -1)
    return np.cumsum(delta[:-1]) > 0
