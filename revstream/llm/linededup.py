"""Line dedup by content-defined chunks of lines.

A rolling hash runs over the hashes of a text's lines. Chunks have two scales. The coarse ones lie between
boundaries: windows of two unlike lines whose rolling hash ends in ``CUT_BITS`` zero bits. A chunk holds the windows at
both of its ends, so its cuts depend on its own lines only and move with them. The fine ones take every window as a
boundary, so any run of two or more lines that repeats is covered by chunks that repeat, wherever it stands and
whatever surrounds it. A chunk (with a byte other than white space) that occurs more than once in the corpus
is removed from all places but the first, after its bytes were compared with the first's. Order is by id, then place in
the text. Copied passages are compared by their coarse chunks; fine chunks inside one of these go with it.

A run of equal lines is cut into pairs side by side, so that no repeat overlaps the first copy, which stays whole; its
first three and last two lines are chunks as well. Where only two of a line came before, the third of three stays.

Defined cases: NULL text stays NULL and has no lines; empty text is one empty line and stays; a document whose
lines all go keeps its row with empty text; equal rows are one document, and rows that share only the id
are ordered by a hash; documents without an id come last; a text of one line has no chunk of several lines
and stays; chunks of white space alone stay; long texts take time in proportion to their length; other columns are
kept by ``deduplicate``, whatever their names, and its result has the columns of its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revstream.llm.common import byte_powers, id_order, mixed, ship, stored, texts, tidied

SPAN = 2  # lines of a window
CUT_BITS = 3  # coarse chunks are some 2 ** CUT_BITS lines long
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
TEXTS = 1_000  # cut at once
FLUSH_BYTES = 16_000_000  # chunk bytes a task holds


def _rolling(h: np.ndarray, base: int, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hash of the ``n`` line hashes from ``first`` on: sum of ``h[first + i] * base ** i``, from prefix sums."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * byte_powers(len(h), base), dtype=np.uint64)])
    back = byte_powers(len(h), pow(base, -1, 1 << 64))
    return mixed((sums[first + n] - sums[first]) * back[first] + n.astype(np.uint64))


def spans(lines: list[bytes]) -> tuple[np.ndarray, ...]:
    """``(first, n, coarse, h1, h2)`` of the chunks of a text, by place, the coarse before the fine."""
    none = np.zeros(0, np.int64)
    if len(lines) < SPAN:
        return none, none, none.astype(bool), none.astype(np.uint64), none.astype(np.uint64)
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), dtype=np.uint64).reshape(-1, 2)
    one, two = np.ascontiguousarray(digests[:, 0]), np.ascontiguousarray(digests[:, 1])
    at = np.arange(len(lines) - 1)
    equal = (one[:-1] == one[1:]) & (two[:-1] == two[1:])
    begin = np.maximum.accumulate(np.where(np.concatenate([[True], ~equal[:-1]]), at, 0))
    run = at - begin + 1  # lines of a run of equal lines up to the current one
    last = np.concatenate([~equal[1:], [True]])
    pairs = at[~equal | (run % 2 == 1) | last & (run > 2)]
    threes = at[equal & (run == 2)] - 1
    window = _rolling(one, BASES[0], at, np.full(len(at), SPAN))
    edges = at[(window & np.uint64((1 << CUT_BITS) - 1) == 0) & ~equal]
    first = np.concatenate([edges[:-1], pairs, threes])
    n = np.concatenate([edges[1:] - edges[:-1] + SPAN, np.full(len(pairs), SPAN), np.full(len(threes), SPAN + 1)])
    coarse = np.arange(len(first)) < len(edges) - 1
    filled = np.concatenate([[0], np.cumsum([bool(x.strip()) for x in lines])])
    use = np.flatnonzero(filled[first + n] > filled[first])
    use = use[np.lexsort((~coarse[use], first[use]))]
    first, n, coarse = first[use], n[use], coarse[use]
    return first, n, coarse, _rolling(one, BASES[0], first, n), _rolling(two, BASES[1], first, n)


def chunks(text: str) -> list[tuple[int, int, bytes]]:
    """``(first line, lines, bytes)`` of the chunks of both scales, by place."""
    lines = text.encode().split(b"\n")
    first, n, *_ = spans(lines)
    return [(a, k, b"\n".join(lines[a : a + k])) for a, k in zip(first.tolist(), n.tolist())]


def uncovered(first: np.ndarray, n: np.ndarray, outer_first: np.ndarray, outer_n: np.ndarray) -> np.ndarray:
    """Which spans lie in none of the outer ones, whose ends rise with their beginnings."""
    if not len(outer_first):
        return np.ones(len(first), dtype=bool)
    order = np.argsort(outer_first, kind="stable")
    ends = (outer_first + outer_n)[order]
    k = np.searchsorted(outer_first[order], first, side="right") - 1
    return (k < 0) | (ends[np.maximum(k, 0)] < first + n)


def found_chunks(source: DataFrame) -> DataFrame:
    """``(id, rk, first, n, coarse, h1, h2)`` of all chunks of ``source(id, rk, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                cut = [spans(text.as_py().encode().split(b"\n")) for text in part.column("text")]
                of = np.repeat(np.arange(len(cut)), [len(c[0]) for c in cut])
                first, n, coarse, h1, h2 = (np.concatenate(x) for x in zip(*cut))
                own = [part.column(c).take(pa.array(of)) for c in ("id", "rk")]
                rest = [pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(coarse), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))]
                yield pa.RecordBatch.from_arrays([*own, *rest], names=["id", "rk", "first", "n", "coarse", "h1", "h2"])

    return source.mapInArrow(tidied(run), "id long, rk long, first int, n int, coarse boolean, h1 long, h2 long")


def chunk_bodies(held: DataFrame) -> DataFrame:
    """The bytes of the listed chunks ``cs`` of ``held(rk, text, cs)``, each text cut once.

    A fine chunk that came before is left out where a coarse one around it came before: that one is compared.
    """
    fields = {"first": pa.int32(), "n": pa.int32(), "h1": pa.int64(), "h2": pa.int64(), "is_first": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*rows)]
            out = [pa.array(columns[0], pa.int64()), *[pa.array(c, t) for c, t in zip(columns[1:], fields.values())], pa.array(bodies, pa.binary())]
            return pa.RecordBatch.from_arrays(out, names=["rk", *fields, "body"])

        for batch in batches:
            rows, bodies, size = [], [], 0
            for rk, text, listed in zip(batch.column("rk").to_pylist(), batch.column("text"), batch.column("cs")):
                c = {k: listed.values.field(k).to_numpy(zero_copy_only=False) for k in (*fields, "coarse")}
                later = c["coarse"] & ~c["is_first"]
                use = np.flatnonzero(c["coarse"] | c["is_first"] | uncovered(c["first"], c["n"], c["first"][later], c["n"][later]))
                data = text.as_py().encode()
                breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
                starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(data)]])
                first, n = c["first"][use].astype(np.int64), c["n"][use]
                for step in range(0, len(use), 10_000):
                    some = slice(step, step + 10_000)
                    cut = [data[a:b] for a, b in zip(starts[first[some]].tolist(), ends[first[some] + n[some] - 1].tolist())]
                    rows.append((np.full(len(cut), rk, np.int64), *[c[k][use[some]] for k in fields]))
                    bodies += cut
                    size += sum(map(len, cut))
                    if size > FLUSH_BYTES:
                        yield batch_of()
                        rows, bodies, size = [], [], 0
            if rows:
                yield batch_of()

    return held.mapInArrow(tidied(run), "rk long, first int, n int, h1 long, h2 long, is_first boolean, body binary")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(rk, first, n)``: for texts that lose lines, beginnings and lengths of chunks to drop; ``rk`` is the key of :func:`texts`."""
    ship(docs.sparkSession)
    source = texts(docs, id_col, text_col)
    found = stored(found_chunks(source), "chunks")
    # Merge joins at every size: the tables grow with the corpus, and a broadcast of a small one would not last.
    place = F.struct(id_order().alias("o"), F.col("rk").alias("rk"), F.col("first").alias("first"))
    often = stored(found.groupBy("h1", "h2").agg(F.min(place).alias("p"), F.max(place).alias("q")).filter("p <> q").select("h1", "h2", "p"), "often")
    repeated = found.join(often.hint("merge"), ["h1", "h2"]).select("rk", F.struct("first", "n", "h1", "h2", (place == F.col("p")).alias("is_first"), "coarse").alias("c"))
    wanted = stored(repeated.groupBy("rk").agg(F.collect_set("c").alias("cs")), "wanted")
    # Bytes are taken for repeated chunks only, from the texts that hold them.
    bodies = stored(chunk_bodies(source.join(wanted.hint("merge"), "rk").select("rk", "text", "cs")), "bodies")
    firsts = stored(bodies.filter("is_first").groupBy("h1", "h2").agg(F.min("body").alias("first_body")), "firsts")
    later = bodies.filter("not is_first").join(firsts.hint("merge"), ["h1", "h2"]).filter(F.col("body") == F.col("first_body"))
    marks = later.groupBy("rk").agg(F.collect_set(F.struct("first", "n")).alias("c"))
    return stored(marks.select("rk", F.col("c.first").alias("first"), F.col("c.n").alias("n")), "dropped")


REST = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType()), T.StructField("n_chunks", T.LongType())])


@F.pandas_udf(REST)
def _without(text: pd.Series, first: pd.Series, n: pd.Series) -> pd.DataFrame:
    """The texts without their chunks, lines lost, and runs of lines lost; NULL for texts that lose none."""
    return pd.DataFrame([(None, 0, 0) if t is None else without(t, a, k) for t, a, k in zip(text, first, n)], columns=["text", "n_removed", "n_chunks"])


def without(text: str, first: np.ndarray, n: np.ndarray) -> tuple[str, int, int]:
    data = text.encode()
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(data)]])
    depth = np.zeros(len(starts) + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, first + n, -1)
    gone = np.cumsum(depth[:-1]) > 0
    edge = np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8))
    kept = [data[starts[a] : ends[b - 1]] for a, b in zip(np.flatnonzero(edge == -1).tolist(), np.flatnonzero(edge == 1).tolist())]
    runs = np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1
    return b"\n".join(kept).decode(), int(gone.sum()), int(runs.sum())


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated chunks; a column ``n_chars`` follows the new text."""
    drops = dropped_lines(docs, id_col, text_col)
    key = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(key.alias("rk"), F.struct("*").alias("doc")).join(drops.hint("merge"), "rk", "left")
    changed = F.col("first").isNotNull()
    text = F.col("doc").getField(text_col)
    rest = _without(F.when(changed, text), "first", "n").getField("text")
    out = rows.select("doc", changed.alias("changed"), F.when(changed, rest).otherwise(text).alias("text"))
    return out.select(*[F.col("text").alias(c) if c == text_col else F.when(F.col("changed"), F.length("text").cast(docs.schema[c].dataType)).otherwise(
        F.col("doc").getField(c)).alias(c) if c == "n_chars" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, n_chunks, kept_sha256`` of every row."""
    drops = dropped_lines(docs, id_col, text_col)
    rows = texts(docs.filter(F.col(text_col).isNotNull()), id_col, text_col).join(drops.hint("merge"), "rk", "left")
    changed = F.col("first").isNotNull()
    out = rows.select("id", "text", changed.alias("changed"), _without(F.when(changed, F.col("text")), "first", "n").alias("rest"))
    out = out.select(F.col("id").alias("doc_id"), F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"), F.col("rest.n_removed").alias("n_removed"),
                     F.col("rest.n_chunks").alias("n_chunks"), F.sha2(F.when(F.col("changed"), F.col("rest.text")).otherwise(F.col("text")), 256).alias("kept_sha256"))
    none = docs.filter(F.col(text_col).isNull()).select(F.col(id_col).cast("long").alias("doc_id"), *[F.lit(0).cast("long").alias(c) for c in ("n_lines", "n_removed", "n_chunks")], F.sha2(F.lit(""), 256).alias("kept_sha256"))
    return out.union(none)
