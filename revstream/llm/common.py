"""Helpers the corpus operators share: stored intermediate tables, row keys, repeated hashes, components."""

from __future__ import annotations

import math
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revstream.session import scratch_dir, shuffles_released

_SHIPPED: set[str] = set()
LAST_ID = (1 << 63) - 1  # documents without an id come after all others
PIECE = 4_000_000  # bytes of a text hashed at once
GAPS = re.compile(rb"[\x20\x09-\x0D]+")
FLUSH_ENTRIES = 2_000_000  # hashes a task holds before it hands them on


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there.

    What was shuffled for it is not needed after that: an executor lost later costs only a new read.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    with shuffles_released(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application: their Python workers need it for its functions."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="run-"), f"{package.name}_shipped.zip")  # the driver serves this copy
    with zipfile.ZipFile(out, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(out))
    _SHIPPED.add(context.applicationId)


def release_memory() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks, and allocators keep what was freed."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, whose worker keeps no freed memory after it."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        release_memory()

    return whole


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, rk, text)`` of every row: NULL text is empty, ``rk`` is a 64-bit key of the row's id and text.

    Equal rows share their key and so count as one document; rows that share only the id do not.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))).alias("rk"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def id_order(col: str = "id") -> Column:
    return F.coalesce(F.col(col), F.lit(LAST_ID))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer over uint64: spreads the entropy of ``h`` over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def byte_powers(n: int, base: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for ``i < n``, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done, step = 1, base & 0xFFFFFFFFFFFFFFFF
    while done < n:
        k = min(done, n - done)
        out[done : done + k] = out[:k] * np.uint64(step)
        step = step * step & 0xFFFFFFFFFFFFFFFF
        done += k
    return out


def order32(x: np.ndarray) -> np.ndarray:
    """A stable order of uint32: values and places are sorted as one number, much faster than an argsort."""
    if len(x) >= 1 << 32:
        return np.argsort(x, kind="stable")
    keys = (x.astype(np.uint64) << np.uint64(32)) | np.arange(len(x), dtype=np.uint64)
    keys.sort()
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def order_of_parts(x: np.ndarray, parts: int) -> np.ndarray:
    """A stable order of whole numbers from 0 to below ``parts``: numpy sorts 16 bits by radix."""
    return np.argsort(x.astype(np.uint16), kind="stable") if parts <= 1 << 16 else order32(x.astype(np.uint32))


class WordHasher:
    """64-bit hashes of the white-space separated words of a byte string, one vector operation per step."""

    BASE = 0x9E3779B97F4A7C15 | 1
    SPACE = np.zeros(256, dtype=bool)
    SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

    def __init__(self) -> None:
        rng = np.random.default_rng(20_240_601)
        self.byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.up = byte_powers(1 << 16, self.BASE)
        self.down = byte_powers(1 << 16, pow(self.BASE, -1, 1 << 64))

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words of ``data``; a long text goes in pieces cut at white space."""
        if len(data) <= PIECE:
            return self._words(data)
        found, at = [], 0
        for gap in GAPS.finditer(data, PIECE):
            if gap.start() - at >= PIECE:
                found.append((at, self._words(data[at : gap.start()])))
                at = gap.start()
        found.append((at, self._words(data[at:])))
        return tuple(np.concatenate([part[i] + offset if i < 2 else part[i] for offset, part in found]) for i in range(3))

    def _words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        b = np.frombuffer(data, dtype=np.uint8)
        word = np.zeros(len(b) + 2, dtype=np.int8)
        word[1:-1] = ~self.SPACE[b]
        edge = np.diff(word)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return starts, ends, np.zeros(0, dtype=np.uint64)
        if len(b) > len(self.up):
            n = 1 << (len(b) - 1).bit_length()
            self.up, self.down = byte_powers(n, self.BASE), byte_powers(n, pow(self.BASE, -1, 1 << 64))
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(self.byte[b] * self.up[: len(b)], out=total[1:])
        h = (total[ends] - total[starts]) * self.down[starts]
        return starts, ends, mixed(h + (ends - starts).astype(np.uint64))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive entries of ``h`` (none when there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = 0xD6E8FEB86659FD93
    out, width, acc, have = h, 1, None, 0
    rest = k
    while rest:  # binary composition: out covers `width` entries, acc the first `have`
        if rest & 1:
            if acc is None:
                acc, have = out, width
            else:
                m = min(len(acc), len(out) - have)
                acc = acc[:m] * np.uint64(pow(base, width, 1 << 64)) + out[have : have + m]
                have += width
        rest >>= 1
        if rest:
            m = len(out) - width
            out = out[: max(m, 0)] * np.uint64(pow(base, width, 1 << 64)) + out[width : width + max(m, 0)]
            width *= 2
    return mixed(acc[:n])


# -- hashes that occur more than once ------------------------------------------------------------------

_PACKED = "bucket int, rk binary, n binary, hash binary, low binary, high binary"


def _settled(h: np.ndarray, rk: np.ndarray, place: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Which entries a task can tell to be repeated by itself, and which have to be dealt out.

    Of a hash with two different places, one of them in the index, all entries are hits. Only three of them go
    on to tell other tasks: one in the index, and two that show that places differ.
    """
    order = np.argsort(h, kind="stable")
    twin = np.zeros(len(h) + 1, dtype=bool)
    twin[1:-1] = h[order][1:] == h[order][:-1]
    order = order[twin[1:] | twin[:-1]]  # of hashes that stand here at least twice
    known, dealt = np.zeros(len(h), dtype=bool), np.ones(len(h), dtype=bool)
    if not len(order):
        return known, dealt
    key, own, indexed = h[order], _place_keys(rk[order], place[order]), place[order] % np.uint32(step) == 0
    new = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    least, most = np.minimum.reduceat(own, new), np.maximum.reduceat(own, new)
    sizes = np.diff(np.append(new, len(key)))
    hit = np.repeat((least != most) & np.logical_or.reduceat(indexed, new), sizes)
    known[order[hit]] = True
    dealt[order[hit]] = False
    group = np.repeat(np.arange(len(new)), sizes)
    for sign in (own == least[group], own == most[group], indexed):
        some = np.flatnonzero(hit & sign)
        dealt[order[some[np.unique(group[some], return_index=True)[1]]]] = True
    return known, dealt


def _pack(rks: list[int], counts: list[int], hashes: list[np.ndarray], places: list[np.ndarray], buckets: int, wide: bool, step: int | None) -> Iterator[pa.RecordBatch]:
    rk, n = np.array(rks, dtype=np.int64), np.array(counts, dtype=np.int64)
    h, p = np.concatenate(hashes), np.concatenate(places).astype(np.uint32)
    doc = np.repeat(np.arange(len(rk), dtype=np.int32), n)
    b = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    if step:
        known, dealt = _settled(h, rk[doc], p, step)
        parts = buckets + _parts(rk, buckets)
        b = np.concatenate([b[dealt], parts[doc[known]]])
        doc, h, p = (np.concatenate([x[dealt], x[known]]) for x in (doc, h, p))
    order = order_of_parts(b, 2 * buckets)
    sizes = np.bincount(b)
    which = np.flatnonzero(sizes)
    cuts = np.append(0, np.cumsum(sizes[which]))
    rows: dict[str, list] = {c: [] for c in ("bucket", "rk", "n", "hash", "low", "high")}
    for k, i in enumerate(which.tolist()):
        own = order[cuts[k] : cuts[k + 1]]
        d, at = doc[own], p[own]
        first = np.flatnonzero(np.diff(d, prepend=-1))
        rows["bucket"].append(i)
        rows["rk"].append(rk[d[first]].tobytes())
        rows["n"].append(np.diff(np.append(first, len(d))).astype(np.int32).tobytes())
        rows["hash"].append(b"" if i >= buckets else (h[own] if wide else h[own].astype(np.uint32)).tobytes())
        rows["low"].append(b"" if wide else at.astype(np.uint16).tobytes())
        rows["high"].append(b"" if wide else (at >> np.uint32(16)).astype(np.uint16).tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(rows["bucket"], pa.int32()), *(pa.array(rows[c], pa.binary()) for c in ("rk", "n", "hash", "low", "high"))], names=list(rows))


def packed_hashes(source: DataFrame, hashes: Callable[[str], tuple], buckets: int, wide: bool = False, step: int | None = None,
                  only: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """Hashes of every text, dealt to ``buckets`` by hash as packed arrays (one row per bucket and flush).

    ``hashes(text)`` gives hashes and their places, and may give a key that stands for the row's. Without ``wide`` 32 bits beside the bucket's number go on,
    which is enough for hits that are verified later. With ``step`` (of the index) a task settles the hashes that it
    holds repeatedly: those entries go as hits to the bucket of their text, numbered from ``buckets`` on, and each
    flush deals out at most three of a hash. ``only`` takes the texts of a batch that take part (default: all).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rks, counts, hs, ps, held = [], [], [], [], 0
        for batch in map(only, batches) if only else batches:
            for rk, text in zip(batch.column("rk").to_pylist(), batch.column("text")):
                h, p, *key = hashes(text.as_py())
                if len(h):
                    rks.append(key[0] if key else rk)
                    counts.append(len(h))
                    hs.append(h)
                    ps.append(p)
                    held += len(h)
                if held >= FLUSH_ENTRIES:
                    yield from _pack(rks, counts, hs, ps, buckets, wide, step)
                    rks, counts, hs, ps, held = [], [], [], [], 0
        if held:
            yield from _pack(rks, counts, hs, ps, buckets, wide, step)

    ship(source.sparkSession)
    return source.select("rk", "text").mapInArrow(tidied(run), _PACKED)


def unpack(table: pa.Table, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row key, hash and place of every entry of a bucket."""

    def joined(name: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, dtype=kind) for x in table.column(name).to_pylist()])

    rk = np.repeat(joined("rk", np.int64), joined("n", np.int32))
    if wide:
        return rk, joined("hash", np.uint64), np.zeros(0, dtype=np.uint32)
    return rk, joined("hash", np.uint32), joined("low", np.uint16) | joined("high", np.uint16).astype(np.uint32) << np.uint32(16)


def bucket_count(spark: SparkSession, source: DataFrame, bytes_per_entry: float) -> int:
    """Buckets of some two million entries each, by the size of all texts."""
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(partitions(spark), math.ceil(size / bytes_per_entry / 2_000_000))


def repeated_places(source: DataFrame, hashes: Callable[[str], tuple[np.ndarray, np.ndarray]], bytes_per_entry: float, index_step: int = 1, settle: bool = True) -> DataFrame:
    """``(rk, place)``, one row per text: where a text has a hash that occurs at two or more places of the corpus.

    With ``index_step`` the hash must also be in the index, that is, occur somewhere at a multiple of the
    step. With ``settle`` tasks settle the hashes they hold repeatedly (:func:`packed_hashes`). Hashes are compared on 32 bits beside the bucket, so some places are false; none is missing.
    """
    spark = source.sparkSession
    buckets = bucket_count(spark, source, bytes_per_entry)

    def match(table: pa.Table) -> pa.Table:
        rk, h, place = unpack(table, wide=False)
        if table.column("bucket")[0].as_py() >= buckets:
            return dealt_by_text(rk, {"place": place}, buckets)
        order = order32(h)
        rk, h, place = rk[order], h[order], place[order]
        new = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint32(1)))
        size = np.diff(np.append(new, len(h)))
        own = _place_keys(rk, place)
        several = np.minimum.reduceat(own, new) != np.maximum.reduceat(own, new)
        if index_step > 1:
            several &= np.logical_or.reduceat(place % np.uint32(index_step) == 0, new)
        hit = np.repeat(several, size)
        return dealt_by_text(rk[hit], {"place": place[hit]}, buckets)

    packed = packed_hashes(source, hashes, buckets, step=index_step if settle else None).repartition(buckets, "bucket")
    return gathered_by_text(packed, match, {"place": np.uint32}, buckets)


def _place_keys(rk: np.ndarray, place: np.ndarray) -> np.ndarray:
    """One key per place of a document; equal rows are one document."""
    return mixed(rk.view(np.uint64) + mixed(place.astype(np.uint64)))


def _parts(rk: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(rk.view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def dealt_by_text(rk: np.ndarray, columns: dict[str, np.ndarray], parts: int) -> pa.Table:
    """A bucket's findings as one packed row for each part of the texts, by their keys."""
    part = _parts(rk, parts)
    order = order_of_parts(part, parts)
    part, first = np.unique(part[order], return_index=True)
    data = {"rk": rk[order]} | {name: c[order] for name, c in columns.items()}
    out = {name: pa.array([x.tobytes() for x in np.split(c, first[1:])] if len(part) else [], pa.binary()) for name, c in data.items()}
    return pa.table({"part": pa.array(part, pa.int32())} | out)


def gathered_by_text(packed: DataFrame, match: Callable[[pa.Table], pa.Table], kinds: dict, parts: int) -> DataFrame:
    """``rk`` and packed columns, one row per text, of what ``match`` finds in the buckets of ``packed``."""

    def matched(table: pa.Table) -> pa.Table:
        out = match(table)
        release_memory()
        return out

    def merge(table: pa.Table) -> pa.Table:
        read = lambda name, kind: np.concatenate([np.frombuffer(x, dtype=kind) for x in table.column(name).to_pylist()])
        rk = read("rk", np.int64)
        order = np.argsort(rk, kind="stable")
        keys, first = np.unique(rk[order], return_index=True)
        out = {name: pa.array([x.tobytes() for x in np.split(read(name, kind)[order], first[1:])] if len(keys) else [], pa.binary()) for name, kind in kinds.items()}
        return pa.table({"rk": pa.array(keys, pa.int64())} | out)

    columns = ", ".join(f"{name} binary" for name in kinds)
    found = packed.groupBy("bucket").applyInArrow(matched, f"part int, rk binary, {columns}").repartition(parts, "part")
    return stored(found.groupBy("part").applyInArrow(merge, f"rk long, {columns}"), "gathered")


# -- connected components ----------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes of ``edges(a, b)``: the component is its smallest node.

    Large-star and small-star rounds (each hangs neighbours on the smallest one) until nothing changes;
    every round is stored, so a lost executor replays one round at most.
    """
    now = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        before = state
        # Every neighbour larger than u goes to the smallest of u and its neighbours.
        both = now.union(now.select("v", "u"))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(large.filter("u <> v").distinct(), "edges")
        # u and its smaller neighbours go to the smallest neighbour.
        least = stored(now.groupBy("u").agg(F.min("v").alias("m")), "stars")
        small = now.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = stored(small.filter("u <> v").distinct(), "edges")
