"""Language-model scores by a probabilistic suffix tree over words.

Contexts of one to three preceding words are counted over all training texts. A context stays in the tree when it
is frequent and its next-symbol distribution diverges from that of its suffix: at least ``MIN_NATS`` nats per
occurrence and ``MIN_TOTAL`` in all. A text is scored symbol by symbol from the longest suffix in the tree; every
distribution is smoothed towards that of the shorter suffix, and the root is the additive word distribution.

Sizes. Word counts of the whole corpus are a distributed table that grows with it. What travels to every task
is bounded by shares of the corpus, whatever its size: words of at least ``HEAD`` of all tokens (at most
1/HEAD), and the most frequent contexts, made of words of at least ``CONTEXT``. Texts are split once and stored
as word numbers; rarer words are 64-bit hashes there and find their counts in buckets by hash.

Every next word counts from two occurrences on, after every context. After the frequent contexts the counts of
the most frequent pairs travel to every task. All other words there, and words outside the head, are dealt out by word
(and context), where pairs are counted, and their counts go back to the texts.

Every other context is decided in shuffled buckets: each word of a text goes to the bucket of its shortest context that
is not among the frequent ones, where the longer ones that end in it meet as well. There they are counted, tested
and applied, whatever their share. What travels is the word and the three before it (numbers, or 31 bits of a hash
beside the bucket's number), its counts and the number of its text.

Defined cases: NULL text is empty and scores its end alone; a NULL id counts as the empty id; with no training
text N, V and all counts are 0, and scores are those of the additive base; repeated rows repeat their result and
count each time in training; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstream.llm.common import bucket_count, dealt_by_text, mixed, order_of_parts, release_memory, ship, stored

HEAD, CONTEXT, CONTEXT_2 = 2e-6, 5e-4, 2e-3
SHARED_WORD, SHARED = 2e-5, 2e-7  # of words and of pairs of a frequent context and a next word: their counts travel to every task
SYMBOL, ENTRY = 0.0, 0.0  # least share of a next word told apart after a frequent context, and of a pair that counts; 0: all
FREQUENT = 1e-4
PRIOR = 20.0  # weight of the shorter suffix, in occurrences
MIN_NATS, MIN_TOTAL = 0.02, 20.0
DEPTH = 3  # words of the longest context
ADD = 0.1
FLUSH_WORDS, FLUSH_PAIRS = 400_000, 2_000_000  # distinct words, pairs a task holds
TEXTS = 300  # coded at once
FLUSH_PLACES, PLACE_BYTES = 900_000, 1.2  # words a task holds before it deals them out; ``bucket_count`` by this makes buckets of some 400,000
STEP = 0x9E3779B97F4A7C15
SLICES = 2  # of the buckets, one after the other: each deals out its share of all words
NO_WORD = 0xFFFFFFFF
END = b"\n"  # no word holds a line end


def fold(col: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_part(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def word_counts(train: DataFrame) -> DataFrame:
    """``(word, n)`` of all tokens of ``train(text)``, counted in each task before the shuffle."""
    ship(train.sparkSession)

    def batch_of(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                held.update(text.as_py().encode().lower().split())
                if len(held) > FLUSH_WORDS:
                    yield batch_of(held)
                    held.clear()
            held[END] += batch.num_rows
        if held:
            yield batch_of(held)

    counted = train.select("text").mapInArrow(run, "word binary, n long")
    return stored(counted.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0"), "words")


class Tree:
    """The bounded part of the model: head words, frequent contexts and their most frequent next words.

    Words are numbered by falling count. ``apart`` says that every next word has a count of its own; otherwise those
    below ``SYMBOL`` are one symbol, the last, which divides its mass by word counts. Counts of the first ``n_shared``
    words travel in ``shared``.
    """

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int):
        self.words, self.total, self.distinct = words, total, distinct
        self.counts = np.array(counts, dtype=np.float64)
        self.scale = total + ADD * (distinct + 1)
        self.p0 = (self.counts + ADD) / self.scale
        self.least = max(2.0, ENTRY * total)
        self.apart = SYMBOL < HEAD
        self.n_shared = int((self.counts >= (SHARED_WORD if self.apart else SYMBOL) * total).sum())
        self.other = 1.0 - self.p0[: self.n_shared].sum()
        self.n_context = int((self.counts >= CONTEXT * total).sum())
        self.n_context_2 = int((self.counts >= CONTEXT_2 * total).sum())
        self.decided: list[np.ndarray] = []  # frequent contexts of each level, retained or not
        self.totals: list[np.ndarray] = []
        self.shared: list[tuple] = []  # ``context * (n_shared + 1) + symbol``, sorted, and their counts
        self.levels: list[tuple] = []  # retained contexts, their counts, and of these those of next words met once
        self.index: dict[bytes, int] | None = None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("flags", "slots")}  # made anew where needed

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words; -1 for those outside the head."""
        if self.index is None:
            self.index = {w: i for i, w in enumerate(self.words)}
        get = self.index.get
        return np.fromiter(map(get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def coded(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers (-1: outside the head), 64-bit hashes of the words outside it, and text lengths."""
        split = [t.lower().split() for t in texts]
        sizes = np.array([len(x) + 1 for x in split], dtype=np.int64)
        words = [w for x in split for w in (*x, END)]
        ids = self.ids(words)
        rare = [xxhash.xxh64_intdigest(words[i], 42) for i in np.flatnonzero(ids < 0).tolist()]  # as Spark's xxhash64
        return ids, np.array(rare, dtype=np.uint64), sizes

    @cached_property
    def end(self) -> int:
        """The number of a text's end; it is trained on wherever there is a training text."""
        return self.words.index(END) if END in self.words else -1

    def context_codes(self, previous: np.ndarray, before: np.ndarray) -> list[np.ndarray]:
        """Codes of the contexts of one and two words (-1: not among the frequent words)."""
        one = np.where((previous >= 0) & (previous < self.n_context), previous, -1)
        inside = (previous >= 0) & (previous < self.n_context_2) & (before >= 0) & (before < self.n_context_2)
        return [one, np.where(inside, before * max(self.n_context_2, 1) + previous, -1)]

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        return np.where((ids >= 0) & (ids < self.n_shared), ids, self.n_shared)

    def start_p(self, codes: list[np.ndarray], ids: np.ndarray, times: np.ndarray, pairs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of words by the root, and after the frequent contexts.

        ``times`` counts those outside the head, ``pairs`` those next words of both levels that are not in ``shared``.
        """
        p0 = np.append(self.p0, 0.0)[ids]
        rare = ids < 0
        p0[rare] = (times[rare] + ADD) / self.scale
        symbols = self.symbols(ids)
        other = symbols == self.n_shared if not self.apart else np.zeros(len(ids), dtype=bool)
        p = np.where(other, self.other, p0)
        for level in range(len(self.levels)):
            p = self.refine(level, codes[level], symbols, pairs[level], p)
        p[other] *= p0[other] / self.other
        return p0, p

    @cached_property
    def flags(self) -> list[np.ndarray]:
        """Which codes of contexts are frequent ones; the last place is that of code -1."""
        out = []
        for decided, size in zip(self.decided, (self.n_context, self.n_context_2**2)):  # at most 1 / CONTEXT_2 squared
            table = np.zeros(size + 1, dtype=bool)
            table[decided] = True
            out.append(table)
        return out

    def frequent(self, codes: list[np.ndarray]) -> list[np.ndarray]:
        """``codes`` of the frequent contexts, -1 for others. The end of a frequent context is one as well."""
        return [np.where(table[code], code, -1) for code, table in zip(codes, self.flags)]

    def passed(self, codes: list[np.ndarray]) -> np.ndarray:
        """How many contexts of each word, from the shortest on, are among the frequent ones."""
        out = np.zeros(len(codes[0]), dtype=np.int64)
        for level, (code, table) in enumerate(zip(codes, self.flags)):
            out[table[code] & (out == level)] += 1
        return out

    def known(self, level: int, codes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Counts of symbols after the contexts of a level as far as they are shared, else 0."""
        keys, counts = self.shared[level]
        out = np.zeros(len(codes))
        at = np.flatnonzero((codes >= 0) & (symbols < self.n_shared) if self.apart else codes >= 0)
        if len(keys) and len(at):
            slots, bits = self.slots[level]
            key = codes[at] * (self.n_shared + 1) + symbols[at]
            at, key = (x[slots[key & bits]] for x in (at, key))  # most others are told by some of their bits
            k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            out[at] = np.where(keys[k] == key, counts[k], 0.0)
        return out

    @cached_property
    def slots(self) -> list[tuple[np.ndarray, int]]:
        """Low bits that shared keys have."""
        out = []
        for keys, _ in self.shared:
            table = np.zeros(1 << (8 * len(keys)).bit_length(), dtype=bool)
            table[keys & (len(table) - 1)] = True
            out.append((table, len(table) - 1))
        return out

    def refine(self, level: int, codes: np.ndarray, symbols: np.ndarray, pairs: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Probabilities of symbols after the contexts of a level, where retained; ``p`` is the shorter suffix's."""
        contexts, totals, left = self.levels[level]
        if not len(contexts):
            return p
        some = np.flatnonzero(codes >= 0)
        at = np.minimum(np.searchsorted(contexts, codes[some]), len(contexts) - 1)
        same = contexts[at] == codes[some]
        some, at = some[same], at[same]
        n = self.known(level, codes[some], symbols[some])
        n = np.where((n == 0) & (pairs[some] >= self.least), pairs[some], n)
        out = p.copy()
        out[some] = (n + (PRIOR + left[at]) * p[some]) / (totals[at] + PRIOR)
        return out


PLANES = "low", "middle", "high"  # bytes of word numbers, apart: they compress better
CODED = "num long, id long, train boolean, low binary, middle binary, high binary, rare binary"


def coded_texts(rows: DataFrame, tree) -> DataFrame:
    """``rows(id, train, text)`` split into words, once: word numbers plus one (0: see ``rare``), and 64-bit hashes of the others.

    ``num`` numbers the rows; equal rows have different numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tree.value
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids, rare, sizes = model.coded(part.column("text").cast(pa.binary()).to_pylist())
                ends = np.cumsum(sizes)
                of = np.searchsorted(ends, np.flatnonzero(ids < 0), side="right")
                code = (ids + 1).astype(np.uint32)
                cut = lambda x, bounds: pa.array([y.tobytes() for y in np.split(x, bounds)], pa.binary())
                columns = [cut((code >> np.uint32(8 * k)).astype(np.uint8), ends[:-1]) for k in range(len(PLANES))]
                columns.append(cut(rare, np.cumsum(np.bincount(of, minlength=len(sizes)))[:-1]))
                yield pa.RecordBatch.from_arrays([part.column("num"), part.column("id"), part.column("train"), *columns], names=["num", "id", "train", *PLANES, "rare"])

    numbered = rows.select(F.monotonically_increasing_id().alias("num"), "id", "train", F.col("text").cast("binary").alias("text"))
    return stored(numbered.mapInArrow(run, CODED), "coded", compression="zstd")


def _joined(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x is not None), dtype=kind)


def _ids(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of a batch of coded texts (-1: outside the head), and text lengths."""
    sizes = np.array([len(x) for x in part.column("high").to_pylist()], dtype=np.int64)
    low, middle, high = (_joined(part.column(name), np.uint8).astype(np.uint32) for name in PLANES)
    return (low | middle << np.uint32(8) | high << np.uint32(16)).astype(np.int64) - 1, sizes


def _contexts(model: Tree, ids: np.ndarray, sizes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Context codes of one and two words, and places in the text. A text's end precedes its first word."""
    starts = np.cumsum(sizes) - sizes
    previous = np.concatenate([[model.end], ids[:-1]])
    before = np.concatenate([[model.end, model.end], ids[:-2]])[: len(ids)]
    before[starts] = -1  # the word before a text's beginning belongs to another text
    return model.context_codes(previous, before), np.arange(len(ids)) - np.repeat(starts, sizes)


def _context_counts(coded: DataFrame, tree) -> DataFrame:
    """``(level, context, symbol, n)`` of both levels over all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tree.value
        width = model.n_shared + 1

        def counts(level: int, held: list[np.ndarray]) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), level), pa.int64()), pa.array(keys // width, pa.int64()), pa.array(keys % width, pa.int64()), pa.array(n, pa.int64())], names=["level", "context", "symbol", "n"])

        held: list[list[np.ndarray]] = [[], []]
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                ids, sizes = _ids(batch.slice(at, TEXTS))
                symbols = model.symbols(ids)
                for level, code in enumerate(_contexts(model, ids, sizes)[0]):
                    use = code >= 0
                    held[level].append(code[use] * width + symbols[use])
                    if sum(map(len, held[level])) > FLUSH_PAIRS:
                        yield counts(level, held[level])
                        held[level] = []
        for level in range(2):
            if held[level]:
                yield counts(level, held[level])

    counted = coded.filter("train").select(*PLANES).mapInArrow(run, "level long, context long, symbol long, n long")
    return stored(counted.groupBy("level", "context", "symbol").agg(F.sum("n").alias("n")), "contexts")


def head_of(counts: DataFrame) -> Tree:
    """The tree of ``counts(word, n)`` before its contexts are known."""
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = counts.filter(F.col("n") >= max(1.0, HEAD * n)).orderBy(F.desc("n"), "word").collect()  # at most 1 / HEAD
    return Tree([bytes(r["word"]) for r in head], [r["n"] for r in head], n, v)


def grow(coded: DataFrame, tree: Tree) -> Tree:
    """``tree`` with its frequent contexts of both levels and the counts that every task has. ``settle`` decides which are retained."""
    n = tree.total
    counted = _context_counts(coded, coded.sparkSession.sparkContext.broadcast(tree))
    least = max(tree.least, SHARED * n) if tree.apart else tree.least
    for level in range(2):
        pairs = counted.filter(F.col("level") == level)
        totals = pairs.groupBy("context").agg(F.sum("n").alias("total"))
        frequent = pairs.join(totals, "context").filter(F.col("total") >= FREQUENT * n).filter(F.col("n") >= least)
        if tree.apart:  # the last symbol holds words whose counts are not shared
            frequent = frequent.filter(F.col("symbol") < tree.n_shared)
        rows = frequent.orderBy("context", "symbol").toPandas()  # at most 1 / SHARED
        codes, symbols, c = (rows[x].to_numpy(dtype=np.int64) for x in ("context", "symbol", "n"))
        contexts, first = np.unique(codes, return_index=True)
        tree.decided.append(contexts)
        tree.totals.append(rows["total"].to_numpy(dtype=np.float64)[first])
        tree.shared.append((codes * (tree.n_shared + 1) + symbols, c.astype(np.float64)))
    tree.index = None
    return tree


def _sums(part: DataFrame, of, tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``of(model, row)`` gives contexts, gains and counts; their sums by context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                context, gain, n = of(tree.value, row)
                yield pa.RecordBatch.from_arrays([pa.array(context, pa.int64()), pa.array(gain, pa.float64()), pa.array(n, pa.float64())], names=["context", "gain", "n"])

    summed = part.mapInArrow(run, "context long, gain double, n double").groupBy("context").agg(F.sum("gain").alias("gain"), F.sum("n").alias("n"))
    rows = summed.toPandas()  # one row for each frequent context
    return rows["context"].to_numpy(dtype=np.int64), rows["gain"].to_numpy(dtype=np.float64), rows["n"].to_numpy(dtype=np.float64)


def settle(tree: Tree, counted: DataFrame) -> Tree:
    """``tree`` with the frequent contexts that are retained, each by its divergence from the level above.

    ``counted``, of ``rare_counts``, has what next words whose counts are not shared add to that.
    """

    def first(model: Tree, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        context, gain, n = np.frombuffer(row["first"], dtype=np.float64).reshape(3, -1)
        return context.astype(np.int64), gain, n

    def second(model: Tree, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        context, n1, n2, count = np.frombuffer(row["deep"], dtype=np.float64).reshape(4, -1)
        context = context.astype(np.int64)
        beyond = np.full(len(context), model.n_shared)
        keys, counts = model.shared[0]
        model.shared[0] = keys[:0], counts[:0]  # the counts stand in the row
        p = model.refine(0, context % max(model.n_context_2, 1), beyond, n1, (count + ADD) / model.scale)
        model.shared[0] = keys, counts
        return context, n2 * np.log(n2 / p), n2

    spark = counted.sparkSession
    extra = counted.filter("num < 0").select("first", "deep")
    for level, of in enumerate((first, second)):
        contexts, totals, (keys, counts) = tree.decided[level], tree.totals[level], tree.shared[level]
        codes, symbols = keys // (tree.n_shared + 1), keys % (tree.n_shared + 1)
        p = np.append(tree.p0[: tree.n_shared], tree.other)[symbols]
        if level:
            p = tree.refine(0, codes % max(tree.n_context_2, 1), symbols, np.zeros(len(codes)), p)
        found = [(codes, counts * np.log(counts / p), counts)]
        if tree.apart:
            found.append(_sums(extra, of, spark.sparkContext.broadcast(tree)))
        gain, kept = np.zeros(len(contexts)), np.zeros(len(contexts))
        for code, g, n in found:
            at = np.searchsorted(contexts, code)
            np.add.at(gain, at, g)
            np.add.at(kept, at, n)
        gain -= kept * np.log(np.maximum(totals, 1))
        keep = (gain >= MIN_TOTAL) & (gain >= MIN_NATS * totals)
        tree.levels.append((contexts[keep], totals[keep], (totals - kept)[keep]))
    return tree


def _squeezed(x: np.ndarray) -> bytes:
    """Byte by byte planes of ``x``, compressed, after their size."""
    planes = x.view(np.uint8).reshape(len(x), -1).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _spread(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], size, asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed_rows(bucket: np.ndarray, order: np.ndarray, base: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per bucket, of entries in an order by bucket."""
    which, first = np.unique(bucket[order], return_index=True)
    packed = [pa.array([_squeezed(x) for x in np.split(v[order], first[1:])] if len(which) else [], pa.binary()) for v in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(np.full(len(which), base), pa.int64()), *packed], names=["bucket", "base", *columns])


def _unpacked(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([_spread(x, kind) for x in table.column(name).to_pylist()] or [np.zeros(0, dtype=kind)])


def _numbers(table: pa.Table, name: str, shift: int = 0) -> np.ndarray:
    """Text numbers of packed rows: each row's base and what is added to it."""
    parts = [base + (_spread(x, np.uint32).astype(np.int64) >> shift) for base, x in zip(table.column("base").to_pylist(), table.column(name).to_pylist())]
    return np.concatenate(parts or [np.zeros(0, dtype=np.int64)])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Parts of batches to be worked on at once, with what their text numbers begin with: one of these has a base of 32 bits."""
    for batch in batches:
        numbers = batch.column("num").to_numpy()
        cuts = np.unique(np.concatenate([np.arange(0, batch.num_rows, TEXTS), np.flatnonzero(np.diff(numbers >> 30)) + 1, [batch.num_rows]])).tolist()
        for at, to in zip(cuts, cuts[1:]):
            yield batch.slice(at, to - at), int(numbers[at] >> 30)


def _dealt(batches: Iterator[pa.RecordBatch], placed, packed) -> Iterator[pa.RecordBatch]:
    """``packed`` of what ``placed`` makes of texts, whenever a task holds enough of it."""
    held, size, base = [], 0, 0
    for part, now in _slices(batches):
        if held and (size > FLUSH_PLACES or now != base):
            yield packed(held)
            held, size = [], 0
        base = now
        held.append(placed(part))
        size += len(held[-1][0])
    if held:
        yield packed(held)


def rare_counts(coded: DataFrame, counts: DataFrame, buckets: int, tree=None) -> DataFrame:
    """``(num, at, times, n1, n2, first, deep)``: places of each text and what is counted there, packed.

    Those are the words outside the head (``times`` in the corpus; ``counts`` leaves out the head) and, with ``tree``, the next words
    of frequent contexts whose counts it does not share (``n1`` and ``n2`` after contexts of one and two words). Such a
    word goes to the bucket of the context and itself. Rows with a ``num`` below 0 are not texts but have ``first`` and
    ``deep``, which ``settle`` reads: what pairs in a bucket add to the gains of contexts.
    """

    def placed(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        ids, sizes = _ids(part)
        rare = ids < 0
        ask = rare.copy()
        h = np.zeros(len(ids), dtype=np.uint64)
        h[rare] = _joined(part.column("rare"), np.uint64)
        at = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        number, code, n1 = np.zeros(len(ids), dtype=np.uint32), np.zeros(len(ids), dtype=np.uint32), np.zeros(len(ids), dtype=np.uint32)
        if tree is not None and tree.value.apart:
            model = tree.value
            one, two = model.frequent(_contexts(model, ids, sizes)[0])
            inside = np.flatnonzero(one >= 0)
            one, two, symbols, own = one[inside], two[inside], model.symbols(ids[inside]), ids[inside]
            have = model.known(0, one, symbols)
            lacks = (two >= 0) & (model.known(1, two, symbols) == 0)
            ask[inside] |= (have == 0) | lacks
            before = np.where(lacks, two // max(model.n_context_2, 1), -1)
            n1[inside] = have.astype(np.uint32)
            train = np.repeat(part.column("train").to_numpy(zero_copy_only=False), sizes)[inside]
            code[inside] = (((before + 1) * (model.n_context + 1) + one + 1) * 2 + train).astype(np.uint32)
            number[inside] = (own + 1).astype(np.uint32)
            h[inside] = np.where(own < 0, h[inside], mixed(mixed(own.astype(np.uint64) + np.uint64(STEP)) * np.uint64(STEP) + one.astype(np.uint64)))
        use = np.flatnonzero(ask)
        num = np.repeat(part.column("num").to_numpy(), sizes)[use]
        return num, at[use].astype(np.uint32), h[use], code[use], number[use], n1[use]

    def packed(held: list[tuple]) -> pa.RecordBatch:
        num, at, h, code, number, n1 = (np.concatenate(x) for x in zip(*held))
        b = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        base = int(num.min()) if len(num) else 0
        return _packed_rows(b, order_of_parts(b, buckets), base, {"off": (num - base).astype(np.uint32), "at": at, "h": h, "code": code, "number": number, "n1": n1})

    def pairs(left: pa.Table, h: np.ndarray, times: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray, pa.Table]:
        """Counts of the next words in a bucket, and what they add to the gains of contexts."""
        model = tree.value
        code, number, have = (_unpacked(left, name, np.uint32) for name in ("code", "number", "n1"))
        n1, n2 = np.zeros(len(h), dtype=np.uint32), np.zeros(len(h), dtype=np.uint32)
        inside = np.flatnonzero(code > 1)
        code, number, have = code[inside], number[inside].astype(np.int64), have[inside].astype(np.float64)
        train, code = (code & np.uint32(1)).astype(np.float64), code.astype(np.int64) >> 1
        one, before = code % (model.n_context + 1) - 1, code // (model.n_context + 1) - 1
        key = mixed(h[inside] * np.uint64(STEP) + one.astype(np.uint64))
        group = _groups(key)
        own = np.bincount(group, train)[group] if len(key) else train
        n1[inside] = np.where(have > 0, 0, own).astype(np.uint32)
        count = np.where(number > 0, np.append(model.counts, 0.0)[number - 1], times[inside])
        sums = np.flatnonzero((train > 0) & (have == 0) & (own >= model.least))
        gain = np.bincount(one[sums], np.log(own[sums] * model.scale / (count[sums] + ADD)), model.n_context)
        n = np.bincount(one[sums], minlength=model.n_context)
        some = np.flatnonzero(n)
        longer = np.flatnonzero(before >= 0)
        group = _groups(mixed(key[longer] * np.uint64(STEP) + before[longer].astype(np.uint64)))
        twice = np.bincount(group, train[longer])[group] if len(longer) else train[longer]
        n2[inside[longer]] = twice.astype(np.uint32)
        met = np.flatnonzero(twice >= model.least)
        met = met[np.unique(group[met], return_index=True)[1]]
        at = longer[met]
        deep = np.stack([before[at] * model.n_context_2 + one[at], np.where(have > 0, have, own)[at], twice[met], count[at]])
        first = np.stack([some.astype(np.float64), gain[some], n[some].astype(np.float64)])
        row = [pa.array([buckets + bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in (b"", b"", b"", first.tobytes(), deep.astype(np.float64).tobytes()))]
        return n1, n2, pa.table(row, names=["part", "rk", "at", "n", "n1", "n2"])

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        num, at, h = _numbers(left, "off"), _unpacked(left, "at", np.uint32), _unpacked(left, "h", np.uint64)
        rare = _unpacked(left, "number", np.uint32) == 0
        known, n = right.column("h").to_numpy().view(np.uint64), right.column("n").to_numpy()
        order = np.argsort(known)
        known, n = np.append(known[order], 0), np.append(n[order], 0)
        k = np.searchsorted(known[:-1], h)
        times = np.where(rare & (known[k] == h) & (k < len(known) - 1), n[k], 0).astype(np.uint32)
        n1 = n2 = np.zeros(len(h), dtype=np.uint32)
        extra = []
        if tree is not None and tree.value.apart and len(h):
            n1, n2, more = pairs(left, h, times, left.column("bucket")[0].as_py())
            extra.append(more)
        out = dealt_by_text(num, {"at": at, "n": times, "n1": n1, "n2": n2}, buckets)
        release_memory()
        return pa.concat_tables([out, *extra])

    def merge(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() >= buckets:
            none = pa.nulls(1, pa.binary())
            return pa.table({"num": pa.array([-1], pa.int64()), "at": none, "times": none, "n1": none, "n2": none, "first": table.column("n1"), "deep": table.column("n2")})
        num, at, *found = (_joined(table.column(name), kind) for name, kind in (("rk", np.int64), ("at", np.uint32), ("n", np.uint32), ("n1", np.uint32), ("n2", np.uint32)))
        order = order_of_parts(at, int(at.max(initial=0)) + 1)
        order = order[_order(num[order])]
        keys, first = np.unique(num[order], return_index=True)
        cut = lambda x: pa.array([y.tobytes() for y in np.split(x[order], first[1:])] if len(keys) else [], pa.binary())
        none = pa.nulls(len(keys), pa.binary())
        return pa.table({"num": pa.array(keys, pa.int64())} | {name: cut(x) for name, x in zip(("at", "times", "n1", "n2"), (at, *found))} | {"first": none, "deep": none})

    ship(coded.sparkSession)
    columns = "num", "train", *PLANES, "rare"
    dealt = coded.select(*columns).mapInArrow(lambda batches: _dealt(batches, placed, packed), "bucket int, base long, off binary, at binary, h binary, code binary, number binary, n1 binary")
    h = F.xxhash64("word")
    listed = counts.select(F.shiftright(F.shiftrightunsigned(h, 32) * F.lit(buckets).cast("long"), 32).cast("int").alias("bucket"), h.alias("h"), "n").repartition(buckets, "bucket")
    found = dealt.repartition(buckets, "bucket").groupBy("bucket").cogroup(listed.groupBy("bucket")).applyInArrow(match, "part int, rk binary, at binary, n binary, n1 binary, n2 binary").repartition(buckets, "part")
    return stored(found.groupBy("part").applyInArrow(merge, "num long, at binary, times binary, n1 binary, n2 binary, first binary, deep binary"), "rare", compression="zstd")


def _counted(part: pa.RecordBatch, sizes: np.ndarray) -> list[np.ndarray]:
    """Corpus counts of the words outside the head, and those after contexts of one and two words, where ``rare_counts`` has them, beside all words."""
    starts = np.cumsum(sizes) - sizes
    each = np.array([len(x or b"") // 4 for x in part.column("at").to_pylist()], dtype=np.int64)
    at = np.repeat(starts, each) + _joined(part.column("at"), np.uint32)
    out = []
    for name in ("times", "n1", "n2"):
        column = np.zeros(int(sizes.sum()), dtype=np.uint32)
        column[at] = _joined(part.column(name), np.uint32)
        out.append(column)
    return out


def _places(coded: DataFrame, tree, buckets: int, turn: int) -> DataFrame:
    """Every word whose contexts are not all among the frequent ones, packed, in slice ``turn`` of the buckets.

    A row holds words ``s``, the three words before each (``w1`` to ``w3``, ``NO_WORD``: none), the count ``n`` of those outside the head,
    their counts after frequent contexts ``n1`` and ``n2``, and twice the number of the text beyond ``base``, plus one in
    texts that are learned from. The bucket follows the shortest context that is not frequent.
    """

    def placed(model: Tree, part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        ids, sizes = _ids(part)
        codes, at = _contexts(model, ids, sizes)
        h = mixed(ids.astype(np.uint64) + np.uint64(STEP))
        rare = ids < 0
        h[rare] = _joined(part.column("rare"), np.uint64)
        word = ids.astype(np.uint32)
        word[rare] = (h[rare] % np.uint64((1 << 31) - 1)).astype(np.uint32) | np.uint32(1 << 31)
        first = model.passed(codes)
        a = mixed(np.roll(h, 1))  # the end of the last text precedes the first one
        for k in (1, 2):
            longer = np.flatnonzero(first >= k)
            a[longer] = mixed(a[longer] * np.uint64(STEP) + np.take(h, longer - 1 - k, mode="wrap"))
        bucket = ((a >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        use = np.flatnonzero((at >= first) & (bucket % SLICES == turn))
        w = [np.take(word, use - k, mode="wrap") for k in range(1, DEPTH + 1)]
        for k in (1, 2):
            w[k][at[use] < k] = NO_WORD
        num = np.repeat(part.column("num").to_numpy(), sizes)[use]
        train = np.repeat(part.column("train").to_numpy(zero_copy_only=False), sizes)[use]
        return bucket[use], num, train, *w, word[use], *(x[use] for x in _counted(part, sizes))

    def dealt(held: list[tuple]) -> pa.RecordBatch:
        bucket, num, train, w1, w2, w3, s, n, n1, n2 = (np.concatenate(x) for x in zip(*held))
        base = int(num.min()) if len(num) else 0
        if len(bucket) < 1 << 24 and buckets <= 1 << 24:
            keys = bucket.astype(np.uint64) << np.uint64(40) | (w1 & np.uint32(0xFFFF)).astype(np.uint64) << np.uint64(24) | np.arange(len(bucket), dtype=np.uint64)
            keys.sort()
            order = (keys & np.uint64(0xFFFFFF)).astype(np.int64)
        else:
            order = np.argsort(bucket, kind="stable")
        return _packed_rows(bucket, order, base, {"off": ((num - base) * 2 + train).astype(np.uint32), "w1": w1, "w2": w2, "w3": w3, "s": s, "n": n, "n1": n1, "n2": n2})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _dealt(batches, lambda part: placed(tree.value, part), dealt)

    return coded.mapInArrow(run, "bucket int, base long, off binary, w1 binary, w2 binary, w3 binary, s binary, n binary, n1 binary, n2 binary")


def _groups(keys: np.ndarray) -> np.ndarray:
    """Numbers of equal hashes. Places take the lowest bits, as many as they need, so that a plain sort will do."""
    bits = np.uint64(len(keys).bit_length())
    packed = keys >> bits << bits | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    out = np.empty(len(keys), dtype=np.int64)
    out[(packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = np.cumsum(np.diff(packed >> bits, prepend=packed[:1] >> bits) != 0)
    return out


def _order(num: np.ndarray) -> np.ndarray:
    """A stable order of text numbers: where they fit beside their places, a plain sort of both."""
    base = num.min() if len(num) else 0
    if len(num) >= 1 << 24 or len(num) and int(num.max()) - int(base) >= 1 << 40:
        return np.argsort(num, kind="stable")
    keys = (num - base).astype(np.uint64) << np.uint64(24) | np.arange(len(num), dtype=np.uint64)
    keys.sort()
    return (keys & np.uint64(0xFFFFFF)).astype(np.int64)


def _summed(num: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, and the sums of their values."""
    order = _order(num)
    num = num[order]
    first = np.flatnonzero(np.diff(num, prepend=num[:1] - 1))
    return num[first], np.add.reduceat(values[order].astype(np.float64), first) if len(first) else np.zeros(0)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """False only where a key occurs once: counts by some of its bits."""
    size = 1 << (2 * len(keys)).bit_length()
    slot = (keys & np.uint64(size - 1)).astype(np.int64)
    return np.bincount(slot, minlength=1)[slot] > 1


def _among(keys: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """False only where a key is not among ``chosen``: compared by some of its bits."""
    size = 1 << (8 * len(chosen)).bit_length()
    table = np.zeros(size, dtype=bool)
    table[(chosen & np.uint64(size - 1)).astype(np.int64)] = True
    return table[(keys & np.uint64(size - 1)).astype(np.int64)]


def bucket_gains(levels: list[np.ndarray], s: np.ndarray, p: np.ndarray) -> np.ndarray:
    """What the contexts of a bucket add to the log10 probability of each of its words."""
    train, start = p > 0, np.abs(p).astype(np.float64)
    now, key = start.copy(), np.zeros(len(s), dtype=np.uint64)
    twice = np.ones(len(s), dtype=bool)  # words learned twice after the shorter context
    for depth, level in enumerate(levels):
        at = np.flatnonzero(level)
        key = mixed(key * np.uint64(STEP) + level.astype(np.uint64))
        if depth:  # contexts without a next word learned twice change nothing
            taught = at[(train & twice)[at]]
            taught = taught[_repeated(mixed(mixed(key[taught]) + s[taught]))]
            at = at[_among(key[at], key[taught])]
        own = key[at]
        context, pair = _groups(own), _groups(mixed(mixed(own) + s[at]))
        learned = train[at].astype(np.float64)
        total = np.bincount(context, learned)
        n = np.bincount(pair, learned)[pair] if len(at) else learned
        twice = np.zeros(len(s), dtype=bool)
        twice[at] = n >= 2
        counted = np.flatnonzero((n >= 2) & (learned > 0))
        if not len(counted):
            break
        of, m = context[counted], n[counted]
        gain = np.bincount(of, np.log(m / total[of] / now[at[counted]]), len(total))
        left = total - np.bincount(of, minlength=len(total))
        change = np.flatnonzero(((gain >= MIN_TOTAL) & (gain >= MIN_NATS * total))[context])
        of, at, n = context[change], at[change], n[change]
        now[at] = (np.where(n >= 2, n, 0.0) + (PRIOR + left[of]) * now[at]) / (total[of] + PRIOR)
    return np.log10(now / start)


def rare_context_gains(coded: DataFrame, tree, buckets: int) -> DataFrame:
    """``(num, gain)``: the sum over a text of what contexts outside the frequent ones add."""

    def match(table: pa.Table) -> pa.Table:
        model = tree.value
        w1, w2, w3, s, n, n1, n2, off = (_unpacked(table, name, np.uint32) for name in ("w1", "w2", "w3", "s", "n", "n1", "n2", "off"))
        number = lambda w: np.where(w < 1 << 31, w, 0xFFFFFFFF).astype(np.uint32).view(np.int32).astype(np.int64)
        codes = model.context_codes(number(w1), number(w2))
        start = model.start_p(codes, number(s), n, [n1, n2])[1].astype(np.float32)
        first = model.passed(codes)
        keys, key = [], np.zeros(len(s), dtype=np.uint64)
        for w in (w1, w2, w3):
            key = mixed(key * np.uint64(STEP) + w.astype(np.uint64)) | np.uint64(1)
            keys.append(np.where(w == NO_WORD, np.uint64(0), key))
        for _ in range(2):  # levels begin at the shortest context that is not frequent
            for k in range(DEPTH):
                keys[k][first > 0] = keys[k + 1][first > 0] if k + 1 < DEPTH else 0
            first = first - 1
        gain = bucket_gains(keys, s, np.where(off & np.uint32(1), start, -start)).astype(np.float32)
        some = gain != 0
        num, gain = _summed(_numbers(table, "off", 1)[some], gain[some])
        part = (mixed(num.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        out = _packed_rows(part, order_of_parts(part, buckets), 0, {"num": num, "gain": gain.astype(np.float32)}).drop_columns(["base"]).rename_columns(["part", "num", "gain"])
        release_memory()
        return pa.Table.from_batches([out])

    def merge(table: pa.Table) -> pa.Table:
        num, gain = _summed(_unpacked(table, "num", np.int64), _unpacked(table, "gain", np.float32))
        return pa.table({"num": pa.array(num, pa.int64()), "gain": pa.array(gain, pa.float64())})

    parts = []
    for turn in range(SLICES):
        packed = _places(coded, tree, buckets, turn).repartition(buckets, "bucket")
        found = packed.groupBy("bucket").applyInArrow(match, "part int, num binary, gain binary").repartition(buckets, "part")
        parts.append(stored(found.groupBy("part").applyInArrow(merge, "num long, gain double"), "gains"))
    return reduce(DataFrame.union, parts).groupBy("num").agg(F.sum("gain").alias("gain"))


def scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``train`` says which rows the model learns from. Words outside the head are told apart by 64-bit hashes and
    meet their corpus counts in buckets by hash; such a word has less than ``HEAD`` of all tokens.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = word_counts(rows.filter("train").select("text"))
    tree = head_of(counts)
    coded = coded_texts(rows, spark.sparkContext.broadcast(tree))
    buckets = bucket_count(spark, rows, PLACE_BYTES)
    tree = grow(coded, tree)
    times = rare_counts(coded, counts.filter(F.col("n") < max(1.0, HEAD * tree.total)), buckets, spark.sparkContext.broadcast(tree))
    shared = spark.sparkContext.broadcast(settle(tree, times))
    # Numbered anew: a task then holds runs of numbers.
    met = stored(coded.join(times.drop("first", "deep"), "num", "left").withColumn("num", F.monotonically_increasing_id()), "texts", compression="zstd")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids, sizes = _ids(part)
                times, *pairs = _counted(part, sizes)
                p0, p = model.start_p(_contexts(model, ids, sizes)[0], ids, times, pairs)
                starts = np.cumsum(sizes) - sizes
                known = np.add.reduceat(((ids >= 0) | (times > 0)).astype(np.int64), starts)
                sums = [pa.array(np.add.reduceat(np.log10(x), starts)) for x in (p0, p)]
                yield pa.RecordBatch.from_arrays([part.column("num"), part.column("id"), pa.array(sizes, pa.int64()), pa.array(known), *sums], names=["num", "id", "n_tokens", "n_known", "base", "score"])

    local = met.mapInArrow(run, "num long, id long, n_tokens long, n_known long, base double, score double")
    gains = rare_context_gains(met, shared, buckets)
    return local.join(gains, "num", "left").select(
        F.col("id").alias("doc_id"), "n_tokens", "n_known", F.lit(tree.total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("score") + F.coalesce(F.col("gain"), F.lit(0.0))).alias("score"))
