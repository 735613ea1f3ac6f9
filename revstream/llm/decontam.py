"""Benchmark decontamination by spaced seeds; DataFrame functions only.

A seed hashes the words of a window at the positions of a mask and ignores the others. Seeds of the benchmark
items and of all documents meet in a join on the hash; around every hit the item is laid over the document on
that diagonal and its words are compared. A document is contaminated by an item when some ``WINDOW``
consecutive positions of the item (all of it when it is shorter) agree in at least ``SHARE`` of their words.
The two masks together hit every such overlap: no way of changing two words of thirteen escapes both.

The seeds of the benchmark are broadcast only while there are at most ``BROADCAST_SEEDS`` of them; beyond
that the join is a shuffled one.

Defined cases: words are runs of characters other than ASCII white space, A-Z in lower case; NULL or empty
texts, and items without words, contaminate nothing; an item shorter than the window is found when all its
words are there; repeated items and rows repeat their result; a NULL item id is reported as NULL in the
list; a NULL doc_id is a document like others; other columns are kept by ``clean`` and ignored otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstream.llm.common import stored, texts

MASKS = ((0, 1, 2, 3, 4, 6), (0, 1, 3, 8, 9, 10))
WINDOW, SHARE = 13, 0.8
BROADCAST_SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trimmed = F.btrim(low, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _seeds(hashes: str, mask: tuple[int, ...], number: int) -> str:
    """SQL for the hashes of all windows of a mask over an array column of word hashes."""
    span = mask[-1] + 1
    picks = ", ".join(f"{hashes}[i + {p}]" for p in mask)
    return f"IF(size({hashes}) >= {span}, transform(sequence(0, size({hashes}) - {span}), i -> xxhash64({number}, {picks})), array())"


def _exploded(rows: DataFrame, keep: list[str], masks: list[tuple[int, ...]]) -> DataFrame:
    """``keep``, the seed and the window's start, of all windows of all masks; ``words`` is an array column."""
    hashed = rows.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("hs"))
    sizes = [f"greatest(size(hs) - {m[-1]}, 0)" for m in masks]
    parts = hashed.select(*keep, F.size("hs").alias("n_words"), F.posexplode(F.expr("concat(" + ", ".join(_seeds("hs", m, i) for i, m in enumerate(masks)) + ")")).alias("at", "seed"))
    start, before = "at", "0"
    for i in range(1, len(masks)):
        before += " + " + sizes[i - 1].replace("size(hs)", "n_words")
        start = f"IF(at >= {before}, at - ({before}), {start})"
    return parts.select(*keep, "seed", F.expr(start).alias("start"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(rk, items)`` of the contaminated rows of ``docs``; ``rk`` is the key of :func:`texts`."""
    items = stored(
        benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col)).alias("words"))
        .filter(F.size("words") > 0).withColumn("k", F.monotonically_increasing_id()), "items")
    short = [r["n"] for r in items.filter(F.size("words") < WINDOW).select(F.size("words").alias("n")).distinct().collect()]
    masks = [*MASKS, *(tuple(range(n)) for n in sorted(short))]
    item_seeds = _exploded(items, ["k", "words"], masks).select("k", F.size("words").alias("len"), "seed", F.col("start").alias("q"))
    item_seeds = stored(item_seeds, "seeds")
    few = item_seeds.count() <= BROADCAST_SEEDS
    sent = F.broadcast(item_seeds) if few else item_seeds
    source = texts(docs, id_col, text_col)
    found = _exploded(source.select("rk", words_of(F.col("text")).alias("words")), ["rk"], masks).join(sent, "seed")
    hits = found.select("rk", "k", "len", (F.col("start") - F.col("q")).alias("diagonal")).distinct()
    hits = stored(hits.groupBy("rk").agg(F.collect_list(F.struct("k", "len", "diagonal")).alias("hits")), "hits")
    over = F.transform("hits", lambda h: F.struct(h["k"].alias("k"), h["diagonal"].alias("diagonal"), F.slice(
        F.col("words"), F.greatest(h["diagonal"], F.lit(0)) + 1, h["len"] + F.least(h["diagonal"], F.lit(0))).alias("laid")))
    laid = hits.join(source, "rk").select("rk", "hits", words_of(F.col("text")).alias("words"))
    laid = laid.select("rk", F.explode(over).alias("h")).select("rk", "h.k", "h.diagonal", "h.laid")
    joined = laid.join(F.broadcast(items) if few else items, "k")
    same = F.expr("transform(words, (w, j) -> IF(j + least(diagonal, 0) >= 0 AND j + least(diagonal, 0) < size(laid), IF(laid[j + least(diagonal, 0)] = w, 1, 0), 0))")
    need = f"CASE WHEN size(same) >= {WINDOW} THEN {math.ceil(SHARE * WINDOW)} ELSE size(same) END"
    runs = f"exists(sequence(0, greatest(size(same) - {WINDOW}, 0)), s -> aggregate(slice(same, s + 1, {WINDOW}), 0, (a, x) -> a + x) >= {need})"
    verified = joined.select("rk", "item", same.alias("same")).filter(F.expr(runs)).select("rk", "item").distinct()
    return stored(verified.groupBy("rk").agg(F.array_sort(F.collect_list(F.struct("item"))).alias("found")).select("rk", F.col("found.item").alias("items")), "leaks")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, contaminated, n_items, items`` of every row."""
    leaks = contaminated(docs, benchmark, id_col, text_col)
    rows = texts(docs, id_col, text_col).select("id", "rk").join(leaks, "rk", "left")
    items = F.coalesce("items", F.array().cast(leaks.schema["items"].dataType))
    return rows.select(F.col("id").alias("doc_id"), F.col("items").isNotNull().alias("contaminated"), F.size(items).alias("n_items"), items.alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    key = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    leaks = contaminated(docs, benchmark, id_col, text_col).select(F.col("rk").alias("__leaked"))
    return docs.join(leaks, key == F.col("__leaked"), "left_anti")
