"""N-gram Jaccard join by vertical partitioning.

Shingles have a global order, rare ones first. The order is cut into fragments by pivots, every document's set
is cut at the same pivots, partial overlaps of a pair are counted in each fragment and summed per pair. A pair
that reaches the threshold shares a shingle in the prefixes of both sets (the first ``n - ceil(t n) + 1`` in the
global order), so candidates come from the prefixes alone. Shingles of a single set can overlap with nothing and
take part only through the set sizes.

Most sets link with nothing, and this shows in their heads: by the order of the hashes, two linked sets share at
least ``l`` of their first ``n - ceil(t n) + l`` shingles. Only the heads, some 30 % of all shingles, are dealt out
for every text; a set whose head has fewer shingles in common with other heads is left out of all that follows.

The result is the classes of linked documents, so pairs that cannot change them are not compared: equal sets are
one class from the start; then, for every shingle in some prefix, its sets are compared with one pivot set at a
time, and sets already in the pivot's class are left out. The pivots of a turn differ from shingle to shingle, so
chains of near copies are joined in a few turns; the pairs of a turn are at most the entries of the lists. From the
second turn on they end when the pairs left across classes are few beside these entries, or when a turn found no link (the
sets of the lists then have a shingle in common but are not alike); those pairs are compared one by one. No
link between different classes is lost.

Defined cases: words are runs of characters other than ASCII white space, A-Z in lower case; a text of fewer
than five words has its whole sequence as its one shingle; NULL or empty texts, or texts without words, have
none, link with nothing and are their own class; equal rows repeat their result; rows that share only an id are
documents of their own; a NULL id is never a class's id unless all ids of the class are NULL; other columns are
ignored by ``classes`` and kept by ``keep_one``. Shingles are 64-bit hashes. Equal sets are those with one 64-bit
key; a second key of 64 bits is compared, and two sets that share only the first end the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revstream.llm.common import WordHasher, components, dealt_by_text, gathered_by_text, id_order, mixed, packed_hashes, partitions, rolling, ship, stored, texts, tidied, unpack

WORDS, PER_CENT = 5, 80
HEAD_SHARE = 10  # of a set's shingles, one in so many more than a prefix needs are in its head
BUCKET_ENTRIES = 2_000_000
MOST_BITS = 1 << 24
FRAGMENTS = 8
STAR_ROUNDS = 16
PAIRS_PER_ENTRY = 16  # pairs left across classes that are compared at once, per entry of the lists
EDGES_PER_TASK = 1_000_000
_HASHER: list[WordHasher] = []


def shingles(text: str) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    if not _HASHER:
        _HASHER.append(WordHasher())
    _, _, h = _HASHER[0].words(text.encode().lower())
    if not len(h):
        return h
    k = min(WORDS, len(h))
    return np.unique(rolling(h, k) if k == WORDS else mixed(rolling(h, k) + np.uint64(k)))


def set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def short_key(grams: np.ndarray) -> int:
    return int(np.frombuffer(set_key(grams)[:8], dtype=np.int64)[0])


def check_key(grams: np.ndarray) -> int:
    return int(np.frombuffer(set_key(grams)[8:], dtype=np.int64)[0])


def least_overlap(n):
    """Shingles of a set of ``n`` that a linked set shares at least: ceil(t n)."""
    return -(-PER_CENT * n // 100)


def sizes(source: DataFrame) -> DataFrame:
    """``(id, rk, n, ck, ck2)`` of every row of :func:`texts`: set size and the set's two keys."""
    ship(source.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ck, ck2 = [], [], []
            for text in batch.column("text"):
                grams = shingles(text.as_py())
                n.append(len(grams))
                ck.append(short_key(grams) if len(grams) else None)
                ck2.append(check_key(grams) if len(grams) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("rk"), *(pa.array(c, pa.int64()) for c in (n, ck, ck2))], names=["id", "rk", "n", "ck", "ck2"])

    return stored(source.mapInArrow(tidied(run), "id long, rk long, n long, ck long, ck2 long"), "sizes")


def head_length(n):
    """Shingles of a set of ``n``, smallest hashes first, of which linked sets share :func:`head_overlap` at least."""
    return np.minimum(n, n - least_overlap(n) + np.maximum(n // HEAD_SHARE, 1))


def head_overlap(n):
    """A set linked with one of ``n`` has ``least_overlap(n)`` shingles or more: of its extra ones and those of ``n``, the fewer."""
    return np.maximum(least_overlap(n) // HEAD_SHARE, 1)


def several(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set key, hash and number of sets of every hash of a bucket that more than one set has."""
    ck, h, _ = unpack(table, wide=True)
    order = np.lexsort((ck, h))
    ck, h = ck[order], h[order]
    once = np.ones(len(h), dtype=bool)
    once[1:] = (h[1:] != h[:-1]) | (ck[1:] != ck[:-1])  # copies of a set are one set
    ck, h = ck[once], h[once]
    new = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1)))
    df = np.diff(np.append(new, len(h)))
    df = np.repeat(df, df)
    return ck[df > 1], h[df > 1], df[df > 1]


def buckets_of(spark: SparkSession, entries: int | None) -> int:
    return max(partitions(spark), -(-(entries or 0) // BUCKET_ENTRIES))


def reachable(source: DataFrame, sized: DataFrame, sets: DataFrame) -> DataFrame:
    """``(rk, n)`` of one text of every set that may link, by the smallest hashes of all sets alone."""
    spark = source.sparkSession

    def head_of(text: str) -> tuple:
        grams = shingles(text)
        head = mixed(grams[: head_length(len(grams))])  # the smallest hashes would all go to the first buckets
        return head, np.zeros(len(head), dtype=np.uint32), short_key(grams) if len(grams) else 0

    def match(table: pa.Table) -> pa.Table:
        ck, met = np.unique(several(table)[0], return_counts=True)
        return dealt_by_text(ck, {"met": met.astype(np.int32)}, buckets)

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            met = np.array([np.frombuffer(x, dtype=np.int32).sum() for x in batch.column("met").to_pylist()], dtype=np.int64)
            yield batch.select(["rk", "n"]).filter(pa.array(met >= head_overlap(n)))

    # Never more than 0.3 n and two: that many entries are room for all heads.
    buckets = buckets_of(spark, sized.agg(F.sum(F.floor(F.col("n") * (100 - PER_CENT) / 100 + F.col("n") / HEAD_SHARE) + 2)).first()[0])
    packed = packed_hashes(source, head_of, buckets, wide=True).repartition(buckets, "bucket")
    met = gathered_by_text(packed, match, {"met": np.int32}, buckets).withColumnRenamed("rk", "ck")
    return stored(met.join(sets, "ck").select("rk", "n", "met").mapInArrow(tidied(enough), "rk long, n long"), "reachable")


def only(rows: DataFrame, count: int, most_bits: int = MOST_BITS) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Takes from a batch the texts whose ``rk`` is in ``rows``, and others that share a bit with one of these.

    A bit map of at most ``most_bits`` bits goes to all tasks, so that no text is shuffled. The fuller it is, the
    more other texts stay; none that is in ``rows`` goes.
    """
    bits = min(most_bits, max(1 << 16, 1 << (16 * count).bit_length()))
    at = F.col("rk").bitwiseAND(F.lit(bits - 1))
    words = rows.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set")).toArrow()
    marks = np.zeros(bits // 64, dtype=np.int64)
    marks[found.column("word").to_numpy()] = found.column("set").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(marks.view(np.uint64))

    def taken(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.column("rk").to_numpy() & np.int64(bits - 1)
        return batch.filter(pa.array((shared.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0))

    return taken


def shared_shingles(source: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(ck, h, df)``, one row per set of ``chosen(rk, n)``: the shingles that others of these have too, and how many have them."""

    def grams_of(text: str) -> tuple:
        grams = shingles(text)
        return grams, np.zeros(len(grams), dtype=np.uint32), short_key(grams) if len(grams) else 0

    def match(table: pa.Table) -> pa.Table:
        ck, h, df = several(table)
        return dealt_by_text(ck, {"h": h, "df": df.astype(np.int64)}, buckets)

    count, entries = chosen.agg(F.count("*"), F.sum("n")).first()
    buckets = buckets_of(source.sparkSession, entries)
    packed = packed_hashes(source, grams_of, buckets, wide=True, only=only(chosen, count)).repartition(buckets, "bucket")
    return gathered_by_text(packed, match, {"h": np.uint64, "df": np.int64}, buckets).withColumnRenamed("rk", "ck")


def candidates(source: DataFrame, sized: DataFrame) -> DataFrame:
    """Sets whose shared shingles suffice for a link, in the global order, with the length of their prefix."""
    one = F.when(F.min("ck2") == F.max("ck2"), F.first("n")).otherwise(F.raise_error(F.lit("two sets share a key")).cast("long"))
    n_of = stored(sized.filter("n > 0").groupBy("ck").agg(one.alias("n"), F.min("rk").alias("rk")), "set-sizes")
    shared = shared_shingles(source, reachable(source, sized, n_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for ck, n, h, df in zip(*(batch.column(c).to_pylist() for c in ("ck", "n", "h", "df"))):
                h, df = np.frombuffer(h, dtype=np.uint64), np.frombuffer(df, dtype=np.int64)
                if len(h) < least_overlap(n):
                    continue
                order = np.lexsort((h, df))
                prefix = n - least_overlap(n) + 1 - (n - len(h))
                rows.append((ck, n, h[order].view(np.int64), df[order], prefix))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["ck", "n", "grams", "df", "prefix"])

    rows = shared.join(n_of.select("ck", "n"), "ck").select("ck", "n", "h", "df")
    return stored(rows.mapInArrow(tidied(run), "ck long, n long, grams array<long>, df array<long>, prefix long"), "sets")


def fragments(sets: DataFrame, count: int = FRAGMENTS) -> DataFrame:
    """``(ck, fragment, part)``: every set cut at the pivots of the global order."""
    # A shingle's place in the order, as one number: how many sets have it, then the top bits of its hash.
    place = lambda d, g: F.least(d, F.lit((1 << 22) - 1)) * F.lit(1 << 40) + F.shiftrightunsigned(g, 24)
    each = sets.select("ck", F.explode(F.arrays_zip("df", "grams")).alias("e")).select("ck", F.col("e.grams").alias("g"), place(F.col("e.df"), F.col("e.grams")).alias("place"))
    cuts = each.agg(F.percentile_approx("place", [i / count for i in range(1, count)], 1_000)).first()[0] or []
    fragment = sum((F.when(F.col("place") >= F.lit(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    return stored(each.select("ck", fragment.alias("fragment"), "g").groupBy("ck", "fragment").agg(F.collect_list("g").alias("part")), "fragments")


def linked_pairs(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """``(a, b)`` of ``pairs(a, b, na, nb)`` that link: partial overlaps by fragment, summed per pair."""
    left = cut.select(F.col("ck").alias("a"), "fragment", F.col("part").alias("pa"))
    right = cut.select(F.col("ck").alias("b"), "fragment", F.col("part").alias("pb"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("o"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    return total.filter(100 * F.col("o") >= PER_CENT * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def forest(edges: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, component`` of the edges of one task: every node hangs on the smallest that it reaches among them."""
    batches = list(edges)
    a, b = (np.concatenate([x.column(i).to_numpy() for x in batches]) if batches else np.zeros(0, dtype=np.int64) for i in (0, 1))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])


def merged(links: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """``(ck, class)`` of the sets in ``links(a, b)``: each task hangs its own links on their smallest sets first.

    That is all when the links fit into one task; otherwise star rounds join what the tasks have left.
    """
    links = stored(links, "links")
    tasks = -(-links.count() // edges_per_task)
    trees = stored(links.coalesce(max(tasks, 1)).mapInArrow(tidied(forest), "node long, component long"), "forest")
    if tasks > 1:
        trees = components(trees.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return stored(trees.select(F.col("node").alias("ck"), F.col("component").alias("class")), "classes") if tasks > 1 else trees.toDF("ck", "class")


def set_classes(sets: DataFrame, star_rounds: int = STAR_ROUNDS, pairs_per_entry: float = PAIRS_PER_ENTRY) -> DataFrame:
    """``(ck, class)`` of the sets that link with a different set.

    A shingle is the first that two sets share in the global order for some list that holds both, and from there
    on they can share no more than either has left. Pairs that cannot reach the threshold so are not formed.
    """
    cut = fragments(sets)
    own = F.col("n") - F.size("grams")
    # `at`: place of the shingle in the whole set; a set's own shingles, which no other set has, come first.
    each = sets.select("ck", "n", own.alias("own"), F.posexplode(F.slice("grams", 1, F.col("prefix").cast("int"))).alias("i", "g"))
    lists = stored(each.select("g", "ck", "n", "own", (F.col("own") + F.col("i")).alias("at")), "lists")
    most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    near = 100 * most >= PER_CENT * (F.col("na") + F.col("nb") - most)
    label, fruitful = sets.select("ck", F.col("ck").alias("class")).limit(0), True
    for turn in range(star_rounds + 1):
        with_class = lists.withColumn("c", F.col("ck")) if turn == 0 else lists.join(label, "ck", "left").withColumn("c", F.coalesce("class", "ck"))
        active = with_class.select("g", "ck", "n", "own", "at", "c") if turn == 0 else stored(with_class.select("g", "ck", "n", "own", "at", "c"), "active")
        # The set with the fewest own shingles is the best pivot of a group of near copies; later any other.
        first = F.col("own") if turn == 0 else F.xxhash64("g", "ck", F.lit(turn))
        rank = F.struct(first.alias("first"), "ck", "n", "at", "c")
        by_class = active.groupBy("g", "c").agg(F.min(rank).alias("p"), F.count(F.lit(1)).cast("double").alias("k"))
        by_list = by_class.groupBy("g").agg(F.min("p").alias("p"), F.count(F.lit(1)).alias("held"), F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("k2"))
        heads = stored(by_list.filter("held > 1").select("g", "p", "k", ((F.col("k") * F.col("k") - F.col("k2")) / 2).alias("across")), "heads")
        entries, across = heads.agg(F.sum("k"), F.sum("across")).first()
        if not across:
            break
        last = turn == star_rounds or not fruitful or (turn > 0 and across <= pairs_per_entry * entries)
        met = active.join(heads.select("g", "p"), "g")
        if last:
            left = met.select("g", F.col("ck").alias("a"), F.col("n").alias("na"), F.col("at").alias("ia"), F.col("c").alias("ca"))
            right = met.select("g", F.col("ck").alias("b"), F.col("n").alias("nb"), F.col("at").alias("ib"), F.col("c").alias("cb"))
            pairs = left.join(right, "g").filter("a < b and ca <> cb")
        else:
            met = met.filter("ck <> p.ck")
            pairs = met.filter("c <> p.c").select(F.col("ck").alias("a"), F.col("n").alias("na"), F.col("at").alias("ia"), F.col("p.ck").alias("b"), F.col("p.n").alias("nb"), F.col("p.at").alias("ib"))
            lists = stored(met.select("g", "ck", "n", "own", "at"), "lists")  # the pivot has met its whole list
        swapped = F.col("a") > F.col("b")
        pairs = pairs.filter(near).select(*[F.when(swapped, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("na", "nb"), ("nb", "na"))])
        found = stored(linked_pairs(stored(pairs.distinct(), "pairs"), cut), "links")
        fruitful = not found.isEmpty()
        if fruitful:
            # Classes are roots of stars, so that links among them and the new links are all that is needed.
            label = merged(found.union(label.select(F.col("ck").alias("a"), F.col("class").alias("b"))))
        if last:
            break
    return label


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, rk, n, component_id, keep)`` of every row; ``keep`` marks the one row of its class that stays."""
    source = texts(docs, id_col, text_col)
    sized = sizes(source)
    label = set_classes(candidates(source, sized))
    first = sized.filter("n > 0").groupBy("ck").agg(F.min(F.struct(id_order().alias("o"), F.col("rk").alias("rk"), F.col("id").alias("id"))).alias("low"))
    of_set = stored(first.join(label, "ck", "left").select("ck", "low", F.coalesce("class", "ck").alias("class")), "firsts")
    of_class = stored(of_set.groupBy("class").agg(F.min("low").alias("low")), "class-firsts")
    of_key = stored(of_set.join(of_class.withColumnRenamed("low", "lowest"), "class").select("ck", F.col("lowest").alias("low")), "of-key")
    alone = F.col("low").isNull()
    return sized.join(of_key, "ck", "left").select(
        "id", "rk", "n", F.when(alone, F.col("id")).otherwise(F.col("low.id")).alias("component_id"), (alone | (F.col("low.rk") == F.col("rk"))).alias("keep"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    return classes(docs, id_col, text_col).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: its first by id; of rows equal in id and text any one stays."""
    key = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    found = classes(docs, id_col, text_col).groupBy("rk").agg(F.every("keep").alias("keep"), F.count("*").alias("rows"), F.max("n").alias("n"))
    # Stored without the rows that stay as they are, so that its size on disk tells Spark whether texts must be shuffled to meet it.
    marked = stored(found.filter("not keep or rows > 1 and n > 0").select(F.col("rk").alias("__rk"), "keep"), "marked")
    left = docs.join(marked.select("__rk"), key == F.col("__rk"), "left_anti")
    twice = marked.filter("keep").select("__rk")
    if twice.isEmpty():
        return left
    again = docs.join(twice, key == F.col("__rk"), "left_semi").withColumn("__rk", key).dropDuplicates(["__rk"]).drop("__rk")
    return left.union(again)
