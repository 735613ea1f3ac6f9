"""Byte-level substring dedup with suffix arrays built by linear grouping.

Anchors, chosen by content, find the byte runs that may repeat (:mod:`revstream.llm.segments`): every window of
``WINDOW`` bytes has as its anchor the ``GRAM`` bytes in it with the smallest hash. Equal segments around an
anchor are settled by their first occurrence. Different segments around equal anchors are joined, with a
separator each, and sorted by :func:`suffix_array`; suffixes that agree in ``WINDOW`` bytes stand together there,
and all but the earliest of them are covered.

A group of more than ``GROUP`` different segments (a hot passage with many edits) is not brought into one task:
its windows are grouped by a 128-bit hash instead.

Defined cases: NULL text is empty; texts of fewer than ``WINDOW`` bytes lose nothing; runs of one character and
other periods repeat themselves and keep their first window; matches never cross documents; equal rows are one
document with one result; rows that share only the id are ordered by a hash; documents without an id come
last; removal may cut a character, and the kept bytes are returned as bytes; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstream.llm import segments
from revstream.llm.common import mixed, repeated_places, rolling, texts

WINDOW, GRAM = 100, 40
PIECE = 1_000_000
GROUP, SUB = 64, 8
_BYTE = np.random.default_rng(7_100).integers(1, 1 << 63, 256, dtype=np.uint64)


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of ``text``, whose last symbol is smaller than all others.

    First the suffixes are grouped by their longest Lyndon prefix. Groups are taken in descending order. For
    every suffix of a group the nearest smaller suffix before it, in a group still to come, is found over the
    pointers of the groups already taken; that suffix's prefix grows by the group's word, as often as it
    follows in a row, and it moves to a new group right above its old one. Then groups are emitted in ascending
    order: a placed suffix places, in their groups, all suffixes whose Lyndon prefix ends where it begins.
    """
    n = len(text)
    alphabet = {c: g for g, c in enumerate(sorted(set(text)))}
    group = [alphabet[c] for c in text]
    members: list[list[int]] = [[] for _ in alphabet]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(members)
    above = [*range(1, len(members)), -1]
    below = [*range(-1, len(members) - 1)]
    taken = [False] * len(members)
    previous = [-1] * n
    now = len(members) - 1
    while now >= 0:
        own = members[now]
        if len(own) == 1:  # most groups: one suffix, whose prefix grows once
            i = own[0]
            taken[now] = True
            if group[i] == now:
                p = i - 1
                while p >= 0 and taken[group[p]]:
                    p = previous[p]
                previous[i] = p
                if p >= 0:
                    g = group[p]
                    new = group[p] = len(members)
                    members.append([p])
                    length.append(length[g] + length[now])
                    taken.append(False)
                    high = above[g]
                    above.append(high)
                    below.append(g)
                    above[g] = new
                    if high >= 0:
                        below[high] = new
            now = below[now]
            continue
        word, repeats = length[now], {}
        turns: dict[int, int] = {}
        for i in own:
            if group[i] != now:
                continue
            p = i - 1
            while p >= 0 and taken[group[p]]:
                p = previous[p]
            if p >= 0 and group[p] == now:  # the word once more
                times = turns.get(p, 1) + 1
                turns[i] = times
                p = previous[p]
            else:
                times = 1
            previous[i] = p
            if p >= 0:
                repeats[p] = times  # members come by place, so the last is the longest row
        taken[now] = True
        by_times: dict[tuple[int, int], list[int]] = {}
        for p, times in repeats.items():
            by_times.setdefault((-times, group[p]), []).append(p)
        for (times, g), moved in sorted(by_times.items()) if turns else by_times.items():
            new = len(members)
            moved.sort()
            members.append(moved)
            length.append(length[g] - times * word)
            taken.append(False)
            high = above[g]
            above.append(high)
            below.append(g)
            above[g] = new
            if high >= 0:
                below[high] = new
            for p in moved:
                group[p] = new
        now = below[now]
    # The lowest group is the last symbol alone.
    first = [0] * len(members)
    count = [0] * len(members)
    for g in group:
        count[g] += 1
    g = group[n - 1]
    at = 0
    while g >= 0:
        first[g] = at
        at += count[g]
        g = above[g]
    order = [-1] * n
    order[0] = n - 1
    first[group[n - 1]] = 1
    end = [i + length[g] for i, g in enumerate(group)]
    for s in order:
        j = s - 1
        while j >= 0 and end[j] == s:
            g = group[j]
            order[first[g]] = j
            first[g] += 1
            j = previous[j]
    return order


def owners(h: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the minimum of every ``width`` consecutive hashes, compared on their upper 44 bits.

    Hash and place share a word, so one minimum a step finds both; ``h`` has fewer than 2 ** 20 entries.
    """
    n, have = len(h) - width + 1, 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    low = np.uint64((1 << 20) - 1)
    v = h & ~low | np.arange(len(h), dtype=np.uint64)
    while have < width:
        step = min(have, width - have)
        v = np.minimum(v[step:], v[:-step])
        have += step
    return (v[:n] & low).astype(np.int64)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes and places, and the first window and number of windows of each, for the windows of ``data``.

    A long text goes in pieces of windows; an anchor cut by a piece's end appears once in each piece.
    """
    found = []
    for at in range(0, max(len(data) - WINDOW + 1, 0), PIECE):
        x = _BYTE[np.frombuffer(data[at : at + PIECE + WINDOW - 1], dtype=np.uint8)]
        h = rolling(x, GRAM)
        own = owners(h, WINDOW - GRAM + 1)
        begin = np.flatnonzero(np.diff(own, prepend=-1))
        anchor = own[begin]
        found.append((h[anchor], anchor + at, begin + at, np.diff(np.append(begin, len(own)))))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate([f[i] for f in found]) for i in range(4))


def probes(text: str) -> tuple[np.ndarray, np.ndarray]:
    h, place, _, _ = anchors(text.encode())
    return mixed(h), place.astype(np.uint32)  # least hashes are small: mixed once more, they fill all buckets alike


def extend(text: str, places: np.ndarray) -> tuple[bytes, list[tuple]]:
    body = text.encode()
    h, place, first, n = anchors(body)
    use = np.isin(place, places)
    h, place, first, n = h[use], place[use], first[use], n[use]
    return body, list(zip(h.view(np.int64).tolist(), first.tolist(), n.tolist(), first.tolist(), (first + n + WINDOW - 1).tolist(), (place - first).tolist()))


def render(body: bytes, runs: np.ndarray) -> tuple[int, int, bytes]:
    gone = segments.covered_mask(runs, WINDOW, len(body))
    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    return int(gone.sum()), spans, np.frombuffer(body, dtype=np.uint8)[~gone].tobytes()


def runs(count: int, at: int) -> Iterator[tuple[int, int, int, int]]:
    """The windows of a segment in runs of ``SUB``, cut at multiples of ``SUB`` from the anchor.

    First and last window of each run, and the bounds of the bytes that all windows of the run have in common.
    """
    for q in range((at - count + 1) // SUB, at // SUB + 1):
        yield max(0, at - SUB * q - SUB + 1), min(count - 1, at - SUB * q), at - SUB * q, at - SUB * q - SUB + 1 + WINDOW


def later_windows(parts: list[tuple[tuple, int, int, bytes]]) -> list[tuple[int, int]]:
    """``(part, window)`` of windows whose bytes start earlier in the parts of one group.

    A part is its place, number of windows, the anchor's offset and bytes. Windows can only be equal when the
    bytes common to their runs are, so a part is cut to the windows between its first and last run with a twin.
    Parts cut to the same bytes are settled by the earliest, the others are sorted.
    """
    sharers: dict[tuple[int, bytes], int] = {}
    for _, n, at, data in parts:
        for _, _, low, high in runs(n, at):
            core = low - at, data[low:high]
            sharers[core] = sharers.get(core, 0) + 1
    cut: dict[tuple[int, bytes], list[tuple[tuple, int, int]]] = {}
    for k, (place, n, at, data) in enumerate(parts):
        twins = [(a, b) for a, b, low, high in runs(n, at) if sharers[low - at, data[low:high]] > 1]
        if twins:
            a, b = min(twins)[0], max(y for _, y in twins)
            cut.setdefault((at - a, data[a : b + WINDOW]), []).append((place, k, a))
    out: list[tuple[int, int]] = []
    left = []
    for (at, data), same in cut.items():
        same.sort(key=lambda x: (*x[0][:2], x[0][2] + x[2]))
        n = len(data) - WINDOW + 1
        out += [(k, a + w) for _, k, a in same[1:] for w in range(n)]
        (o, rk, first), k, a = same[0]
        left.append(((o, rk, first + a), n, at, data, k, a))
    if len(left) > 1:
        out += [(left[i][4], left[i][5] + w) for i, w in sorted_repeats([x[:4] for x in left])]
    return out


def sorted_repeats(parts: list[tuple[tuple, int, int, bytes]]) -> list[tuple[int, int]]:
    """``(part, window)`` as :func:`later_windows`, of parts with different bytes, by their suffix array.

    All windows hold the anchor, at the same place where they are equal, so it stands in the sorted text as one
    symbol, together with the bytes that follow it in every part.
    """
    text: list[int] = []
    owner, offset = [], []
    many = len(parts) + 2
    shared = len(commonprefix([data[at + GRAM :] for _, _, at, data in parts]))
    for k, (_, n, at, data) in enumerate(parts):
        text += [c + many for c in data[:at]]
        text.append(many - 1)
        text += [c + many for c in data[at + GRAM + shared :]]
        text.append(k + 1)
        owner += [k] * (len(text) - len(owner))
        offset += range(len(text) - len(offset))
    text.append(0)
    owner.append(-1)
    offset.append(0)
    out: list[tuple[int, int]] = []
    before = least = None
    for s in suffix_array(text):
        k, w = owner[s], offset[s]
        if k < 0 or w >= parts[k][1]:
            continue
        (o, rk, first), _, _, data = parts[k]
        window, here = data[w : w + WINDOW], (o, rk, first + w, k, w)
        if window != before:
            before, least = window, here
        else:
            out.append(max(least, here)[3:])
            least = min(least, here)
    return out


def segment_bytes(rows: DataFrame) -> DataFrame:
    """``(ah, several, o, rk, first, n, at, bytes)``: the bytes of the segments to look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 50):
                part = batch.slice(i, 50)
                out = [(s["ah"], s["several"], o, rk, s["first"], s["n"], s["at"], body[s["first"] : s["first"] + s["n"] + WINDOW - 1])
                       for o, rk, body, look in zip(*(part.column(c).to_pylist() for c in ("o", "rk", "body", "look"))) for s in look]
                columns = list(zip(*out)) if out else [[]] * 8
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:7]), pa.array(columns[7], pa.binary())],
                                                 names=["ah", "several", "o", "rk", "first", "n", "at", "bytes"])

    return segments.stored(rows.mapInArrow(run, "ah long, several long, o long, rk long, first long, n long, at long, bytes binary"), "segment-bytes")


def sorted_groups(each: DataFrame) -> DataFrame:
    """``(rk, first, n)`` of the covered windows of groups of segments small enough for one suffix array."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rks, firsts, ns = [], [], []
            lists = batch.column("parts")
            cuts = lists.offsets.to_pylist()
            o, rk, first, n, at, data = (lists.values.field(c).to_pylist() for c in range(6))
            for begin, end in zip(cuts, cuts[1:]):
                each_place = zip(o[begin:end], rk[begin:end], first[begin:end])
                # Equal rows bring a segment twice.
                parts = [(place, n[i], at[i], data[i]) for place, i in dict(zip(each_place, range(begin, end))).items()]
                later = later_windows(parts)
                last = None
                for k, w in sorted(later):
                    if last == (k, w - 1):
                        ns[-1] += 1
                    else:
                        rks.append(parts[k][0][1])
                        firsts.append(parts[k][0][2] + w)
                        ns.append(1)
                    last = (k, w)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (rks, firsts, ns)], names=["rk", "first", "n"])

    grouped = each.groupBy("ah").agg(F.collect_list(F.struct("o", "rk", "first", "n", "at", "bytes")).alias("parts"))
    return grouped.select("parts").mapInArrow(sort, "rk long, first long, n long")


def hot_windows(each: DataFrame) -> DataFrame:
    """``(rk, first, n)`` of the covered windows of large groups.

    Runs of windows come first (:func:`runs`). Those whose common bytes stand nowhere else go; of runs with equal
    bytes all but the first are covered as a whole; the windows of the first ones are compared by 128-bit hashes.
    """
    digest = xxhash.xxh3_128_digest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                rows, hashes = [], []
                for o, rk, first, n, at, body in zip(*(batch.slice(i, 500).column(c).to_pylist() for c in ("o", "rk", "first", "n", "at", "bytes"))):
                    for a, b, low, high in runs(n, at):
                        data = body[a : b + WINDOW]
                        rows.append((o, rk, first + a, b - a + 1, data))
                        hashes += digest(body[low:high]), digest(data)
                columns = list(zip(*rows)) if rows else [[]] * 5
                h = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.binary()), *(pa.array(np.ascontiguousarray(c)) for c in h.T)],
                                                 names=["o", "rk", "first", "n", "bytes", "h1", "h2", "w1", "w2"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                places, hashes = [], []
                for o, rk, first, n, body in zip(*(batch.slice(i, 500).column(c).to_pylist() for c in ("o", "rk", "first", "n", "bytes"))):
                    for w in range(n):
                        places.append((o, rk, first + w))
                        hashes.append(digest(body[w : w + WINDOW]))
                columns = [*np.array(places, dtype=np.int64).reshape(-1, 3).T, *np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2).T]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["o", "rk", "first", "h1", "h2"])

    place = F.struct(*segments.PLACE)
    low, high = F.min(place).alias("p"), F.max(place).alias("q")

    def repeated(rows: DataFrame) -> DataFrame:
        return segments.stored(rows.groupBy("h1", "h2").agg(low, high).filter("p <> q").select("h1", "h2", "p"), "hot")

    cores = segments.stored(each.mapInArrow(cut, "o long, rk long, first long, n long, bytes binary, h1 long, h2 long, w1 long, w2 long"), "cores")
    left = segments.stored(cores.join(repeated(cores).drop("p"), ["h1", "h2"]).drop("h1", "h2"), "runs")
    firsts = segments.stored(left.groupBy("w1", "w2").agg(low, high, F.first("n").alias("n"), F.first("bytes").alias("bytes")), "first-runs")
    again = left.select(*segments.PLACE, "n", "w1", "w2").join(firsts.filter("p <> q").select("w1", "w2", "p"), ["w1", "w2"])
    ones = segments.stored(firsts.select("p.*", "n", "bytes").mapInArrow(single, "o long, rk long, first long, h1 long, h2 long"), "windows")
    later = ones.join(repeated(ones), ["h1", "h2"])
    return again.filter(place != F.col("p")).select("rk", "first", "n").union(later.filter(place != F.col("p")).select("rk", "first", F.lit(1).cast("long").alias("n")))


def kept_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """``(id, rk, text)`` of every row, and ``(rk, n_removed, n_spans, kept)`` of the texts that lose bytes."""
    source = texts(docs, id_col, text_col)
    found = segments.candidate_texts(source, repeated_places(source, probes, bytes_per_entry=30), extend)
    covered, closer = segments.resolve(found)
    look = segment_bytes(segments.with_bodies(closer, found))
    few, many = sorted_groups(look.filter(F.col("several") <= group)), hot_windows(look.filter(F.col("several") > group))
    return source, segments.without_covered(found, covered.union(few).union(many), render, "n_removed long, n_spans long, kept binary")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, kept`` (the bytes that stay)."""
    source, changed = kept_bytes(docs, id_col, text_col)
    return source.join(changed, "rk", "left").select(F.col("id").alias("doc_id"), F.coalesce("kept", F.encode("text", "UTF-8")).alias("kept"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    source, changed = kept_bytes(docs, id_col, text_col)
    plain = source.select("id", "rk", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    short = changed.select("rk", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept"))
    none = F.lit(0).cast("long")
    return plain.join(short, "rk", "left").select(F.col("id").alias("doc_id"), "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
                                                  F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept", "whole").alias("kept_sha256"))
