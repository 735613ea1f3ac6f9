"""Corpus operators against brute force and on odd input: nulls, empty and repeated rows, ties, long texts."""

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from math import log, log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revstream.llm import bpe, common, decontam, jaccard, langid, linededup, projection, pst, queries, substring, suffixarray, warc
from revstream.session import scratch_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rk long"


@pytest.fixture(scope="module")
def corpus():
    """Rows with shared passages, near and exact copies, a periodic and a long text, nulls and repeats."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(word() for _ in range(r.randint(0, 90))) for _ in range(40)]
    texts += [" ".join(word() for _ in range(r.randint(1, 30))) + "\n" + passage + "\t" + word() for _ in range(8)]
    base = [word() for _ in range(120)]
    for _ in range(8):
        near = list(base)
        near[r.randrange(120)] = word()
        texts.append(" ".join(near))
    texts += [" ".join(base)] * 3 + ["ab " * 70, "x" * 300, "", "  \n ", None, passage + "  " + passage, "\n".join(base[:30]) * 2]
    texts.append(" ".join(word() for _ in range(9_000)))
    rows = [(i, t, "fr" if i % 2 else "de", None, 1, 7) for i, t in enumerate(texts)]
    return rows + [rows[45], (None, passage, None, None, None, None), (3, "another text with the id three", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS)


def by_order(corpus):
    """Distinct rows in the order of their ids; rows that share one come in the order of their keys, left out here."""
    return sorted({(i if i is not None else 1 << 62, t or "") for i, t, *_ in corpus if i != 3})


def brute(corpus, split, width, join):
    seen, out = set(), {}
    for i, t in by_order(corpus):
        units = split(t)
        gone = [False] * len(units)
        for j in range(len(units) - width + 1):
            key = tuple(units[j : j + width])
            if key in seen:
                gone[j : j + width] = [True] * width
            seen.add(key)
        out[i if i < 1 << 62 else None] = (len(units), sum(gone), hashlib.sha256(join(u for u, g in zip(units, gone) if not g)).hexdigest())
    return out


def without_three(corpus):
    return [row for row in corpus if row[0] != 3]


def test_substring_dedup(spark, corpus):
    df = spark.createDataFrame(without_three(corpus), DOCS)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.report(df).collect()}
    assert got == brute(corpus, lambda t: t.encode().split(), 20, lambda u: b" ".join(u))


def test_substring_report_splits_words_in_tasks_without_patterns(spark):
    """Words of a text are counted and joined in one pass over its bytes, whatever stands between them."""
    texts = [None, "", " \n ", "\x0b a\t\tb \r\n é\u00a0c\f", "one", " ".join(map(str, range(50))), "x  \n" + "\n ".join(map(str, range(50)))]
    df = spark.createDataFrame(list(enumerate(texts)) + [(1, ""), (None, "z z")], "doc_id long, text string")
    out = substring.report(df)
    assert "regexp_replace" not in out._jdf.queryExecution().toString().lower()
    sha = lambda w: hashlib.sha256(b" ".join(w)).hexdigest()
    want = [(i, len(w := (t or "").encode().split()), 0, sha(w)) for i, t in [*enumerate(texts[:-1]), (1, ""), (None, "z z")]] + [(6, 51, 50, sha([b"x"]))]
    assert Counter(tuple(r) for r in out.collect()) == Counter(want)


def test_orders_are_stable():
    r = np.random.default_rng(3)
    for x in (r.integers(0, 1 << 32, 5_000, dtype=np.uint32), r.integers(0, 9, 5_000).astype(np.uint32), np.full(3, (1 << 32) - 1, dtype=np.uint32), np.zeros(0, dtype=np.uint32)):
        assert (common.order32(x) == np.argsort(x, kind="stable")).all()
    for parts in (7, 1 << 16, (1 << 16) + 1, 1_000_000):
        x = np.append(r.integers(0, parts, 5_000), [parts - 1, 0]).astype(np.int32)
        assert (common.order_of_parts(x, parts) == np.argsort(x, kind="stable")).all()


@pytest.mark.parametrize("group", [2, 64])
def test_suffix_array_dedup(spark, corpus, group):
    df = spark.createDataFrame(without_three(corpus), DOCS)
    source, changed = suffixarray.kept_bytes(df, group=group)
    rows = source.join(changed, "rk", "left").collect()
    got = {r["id"]: (len(r["text"].encode()), r["n_removed"] or 0, hashlib.sha256(r["text"].encode() if r["kept"] is None else r["kept"]).hexdigest()) for r in rows}
    assert got == brute(corpus, lambda t: list(t.encode()), 100, bytes)


def test_suffix_array_spans(spark, corpus):
    """Runs of removed bytes, with every byte's fate from a plain search."""
    rows = without_three(corpus)
    got = {r["doc_id"]: r["n_spans"] for r in suffixarray.report(spark.createDataFrame(rows, DOCS)).collect()}
    seen, want = set(), {}
    for i, text in by_order(rows):
        body = text.encode()
        gone = [False] * len(body)
        for k in range(len(body) - 99):
            if body[k : k + 100] in seen:
                gone[k : k + 100] = [True] * 100
            seen.add(body[k : k + 100])
        want[i if i < 1 << 62 else None] = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
    assert got == want and sum(want.values()) > 0


@pytest.mark.parametrize("step", [1, 10])
def test_hot_hashes_are_reduced_in_each_task(spark, step, monkeypatch):
    """A hash of a third of all texts: few of it are dealt out, and every place of it is found."""
    r = random.Random(6)
    rows = [(i, r.randrange(1 << 60), f"{r.random()} " + ("common" if i % 3 == 0 else f"x{i if i % 5 else i // 10}")) for i in range(3_000)]
    rows += rows[:40]
    source = spark.createDataFrame(rows, "id long, rk long, text string").repartition(4)

    def hashes(text):
        words = text.split(" ")
        h = np.array([zlib.crc32(w.encode()) * 0x9E3779B97F4A7C15 % (1 << 64) for w in words], dtype=np.uint64)
        return h, np.arange(len(h), dtype=np.uint32) * 7 + zlib.crc32(words[0].encode()) % 10

    count = Counter()
    for bucket in common.packed_hashes(source, hashes, 5, step=step).filter("bucket < 5").toArrow().to_batches():
        for k in range(bucket.num_rows):
            count.update(common.unpack(pa.Table.from_batches([bucket.slice(k, 1)]), False)[1].tolist())
    assert max(count.values()) <= 3 * 4
    places = defaultdict(set)
    for _, rk, text in rows:
        for h, p in zip(*hashes(text)):
            places[h].add((rk, int(p)))
    hit = set().union(*(x for x in places.values() if len(x) > 1 and any(p % step == 0 for _, p in x)))
    found = common.repeated_places(source, hashes, 10, step).collect()
    assert {(x["rk"], int(p)) for x in found for p in np.frombuffer(x["place"], np.uint32)} == hit and len(hit) > 900


def test_suffix_array_order():
    r = random.Random(2)
    for _ in range(3_000):
        text = [r.randint(1, r.randint(1, 4)) for _ in range(r.randint(0, 25))] + [0]
        assert suffixarray.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("rounds,at_once,edges", [(0, 0, 10**6), (1, 0, 3), (16, 0, 10**6), (16, jaccard.PAIRS_PER_ENTRY, 5)])
def test_jaccard_classes(spark, corpus, rounds, at_once, edges, monkeypatch):
    monkeypatch.setattr(jaccard, "set_classes", lambda sets, f=jaccard.set_classes: f(sets, rounds, at_once))
    monkeypatch.setattr(jaccard, "merged", lambda links, f=jaccard.merged: f(links, edges))
    rows = without_three(corpus)
    sets, parent = {}, {}
    for i, t, *_ in rows:
        w = (t or "").lower().encode().split()
        k = min(5, len(w))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets, key=lambda i: 1 << 62 if i is None else i)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)), key=lambda i: 1 << 62 if i is None else i)
                parent[y] = x
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("copies", [500, 2_000])
def test_near_copies_form_few_pairs(spark, copies, monkeypatch):
    """Copies of one text with a changed word link along its words only; pairs grow with the copies, not their square."""
    r = random.Random(copies)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(copies):
        words = list(base)
        words[r.randrange(60)] = f"x{i}"
        texts.append(" ".join(words))
    pairs = []

    def counted(df, purpose, f=jaccard.stored):
        out = f(df, purpose)
        pairs.append(out.count() if purpose == "pairs" else 0)
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in jaccard.report(docs).collect()}
    sets = [frozenset(tuple(t.split()[j : j + 5]) for j in range(56)) for t in texts]
    parent = list(range(copies))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_gram = defaultdict(set)
    for i, grams in enumerate(sets):
        for g in frozenset(map(tuple, (base[j : j + 5] for j in range(56)))) - grams:
            by_gram[g].add(i)  # linked copies lack a shingle of the base together
    for ids in by_gram.values():
        ids = sorted(ids)
        for k, a in enumerate(ids):
            for b in ids[:k]:
                if root(a) != root(b) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    assert got == {i: root(i) for i in range(copies)}
    assert sum(pairs) < 300 * copies


def test_heads_of_linked_sets_meet():
    r = random.Random(11)
    for _ in range(3_000):
        n, shared = r.randint(1, 120), []
        grams = np.unique(np.array([r.getrandbits(64) for _ in range(2 * n)], dtype=np.uint64))
        cut = r.randint(0, n)
        a, b = grams[:n], np.unique(np.concatenate([grams[cut // 4 : n], grams[n : n + r.randint(0, cut)]]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= jaccard.PER_CENT * len(np.union1d(a, b)):
            met = len(np.intersect1d(a[: jaccard.head_length(len(a))], b[: jaccard.head_length(len(b))]))
            assert met >= jaccard.head_overlap(len(a)) and met >= jaccard.head_overlap(len(b))


def test_bit_map_takes_the_texts_asked_for(spark):
    keys = np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, 2_000)
    asked = spark.createDataFrame([(int(k),) for k in keys[:100]], "rk long")
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(["x"] * 2_000)], names=["rk", "text"])
    for most_bits, others in ((jaccard.MOST_BITS, 20), (128, 1_900)):
        got = set(jaccard.only(asked, 100, most_bits)(batch).column("rk").to_pylist())
        assert set(keys[:100].tolist()) <= got and len(got) <= 100 + others
    none = asked.limit(0)
    assert jaccard.only(none, 0)(batch).num_rows == 0


def test_texts_without_near_copies_deal_out_heads_only(spark, monkeypatch):
    """A third of the shingles travels for texts that link with nothing, and rows that stay are not stored again."""
    r = random.Random(8)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(300)) for _ in range(200)]
    texts += [" ".join(texts[0].split()[:-1]), texts[1]]
    dealt, rows = [], {}

    def counted(*args, f=jaccard.packed_hashes, **kw):
        out = f(*args, **kw)
        dealt.append(out.agg(F.sum(F.octet_length("hash"))).first()[0] / 8)
        return out

    def noted(df, purpose, f=jaccard.stored):
        out = f(df, purpose)
        rows[purpose] = out.count()
        return out

    monkeypatch.setattr(jaccard, "packed_hashes", counted)
    monkeypatch.setattr(jaccard, "stored", noted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x["doc_id"] for x in jaccard.keep_one(docs).collect()} == set(range(200))
    assert sum(dealt) < 0.35 * 202 * 296
    assert rows["reachable"] == 2 and rows["marked"] == 2


def test_keep_one_leaves_one_row_of_each_class(docs):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    rows = jaccard.report(docs.filter("doc_id is null or doc_id <> 3")).collect()
    want = {r["component_id"] for r in rows if r["n_shingles"]} | {r["doc_id"] for r in rows if not r["n_shingles"]}
    assert Counter(r["doc_id"] for r in kept.collect() if r["doc_id"] != 3) == Counter(want)


def test_bpe_matches_the_library(docs, corpus):
    path = public_tokenizers.path(queries.TOKENIZER)
    lib = Tokenizer.from_file(path)
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, path).collect()}
    for i, t, *_ in corpus:
        if i != 3:
            assert ids[i] == lib.encode(t or "", add_special_tokens=False).ids
    codec, r = bpe.Codec(open(path, encoding="utf-8").read()), random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "the", "Ünï", "日本", "12", "'s", "!", "<|endoftext|>", "\x1c", "\x85", "\xa0", "𝔘", "\r\n", "é", "²"]
    for _ in range(3_000):
        s = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        want = lib.encode(s, add_special_tokens=False).ids
        assert codec.encode(s) == want and codec.decode(want) == lib.decode(want, skip_special_tokens=False)
    long = "ab" * 4_000 + "xyz" * 2_000
    assert codec.encode(long) == lib.encode(long, add_special_tokens=False).ids
    out = bpe.decode(bpe.encode(docs, path), path).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((i, t or "") for i, t, *_ in corpus)


def test_line_dedup_removes_repeated_chunks_only(spark, docs):
    body = "\n".join(f"line {i} of the shared part" for i in range(40))
    rows = [(1, "own start\n" + body + "\nown end", None, None, 0, 0), (2, "b\nc\nd\n" + body, None, None, 0, 0), (3, "plain\ntext\nhere", None, None, 0, 0), (4, None, None, None, None, None), (5, "", None, None, 0, 0)]
    out = {r["doc_id"]: r for r in linededup.deduplicate(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[1]["text"] == rows[0][1] and out[3]["text"] == rows[2][1] and out[4]["text"] is None and out[5]["text"] == ""
    assert out[2]["text"].startswith("b\nc\nd") and len(out[2]["text"]) < len(body) / 2 and out[2]["n_chars"] == len(out[2]["text"])
    assert linededup.deduplicate(docs).columns == docs.columns and linededup.report(docs).count() == docs.count()


def test_line_dedup_removes_every_repeated_run(spark):
    r = random.Random(8)
    line = lambda: " ".join(r.choice("abcdefgh") * 3 + str(r.randrange(99)) for _ in range(6))
    runs = [[line() for _ in range(n)] for n in (2, 2, 3, 4, 7, 20) for _ in range(4)] + [["same"] * 2, ["equal"] * 3]
    rows, want = [], {}
    for copy in range(3):
        for run in runs:
            head, tail = [line() for _ in range(r.randint(1, 4))], [line() for _ in range(r.randint(1, 4))]
            rows.append((len(rows), "\n".join(head + run + tail), None, None, 0, 0))
            want[rows[-1][0]] = "\n".join(head + tail) if copy else rows[-1][1]
    one = line()
    for text in (one + "\nx1", one + "\nx2", "\n".join(["own"] * 3)):  # a single line, and equal lines of one text
        want[len(rows)] = text
        rows.append((len(rows), text, None, None, 0, 0))
    df = spark.createDataFrame(rows, DOCS)
    assert {x["doc_id"]: x["text"] for x in linededup.deduplicate(df).collect()} == want
    n = {x["doc_id"]: (x["n_removed"], x["n_chunks"]) for x in linededup.report(df).collect()}
    assert n == {i: (len(t.split("\n")) - len(want[i].split("\n")), int(t != want[i])) for i, t, *_ in rows}


def first_of_each_run(rows):
    """Texts of ``(id, text)`` without the runs of two or more lines that came before, by plain search."""
    pairs = lambda x: [(k, (x[k], x[k + 1])) for k in range(len(x) - 1) if x[k] != x[k + 1] and (x[k] + x[k + 1]).strip()]
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for k, pair in pairs(lines):
            if pair in seen:
                gone |= {k, k + 1}
            seen.add(pair)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_line_dedup_matches_a_plain_search(spark, sf_dir):
    """Real documents, each given again with lines of others around it; no equal lines side by side."""
    given = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if x["text"]]
    lines = [x for _, t in given for x in t.split("\n")]
    r = random.Random(3)
    rows = {i: t for i, t in given if all(a != b for a, b in zip(t.split("\n"), t.split("\n")[1:]))}
    for k in range(60):
        at = r.randrange(len(lines) - 30)
        body = [r.choice(lines), *lines[at : at + r.randint(2, 30)], r.choice(lines)]
        body = [x for a, x in enumerate(body) if not a or x != body[a - 1]]
        rows[10_000_000 + k] = "\n".join(body)
    want = first_of_each_run(rows.items())
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {x["doc_id"]: x["text"] for x in linededup.deduplicate(df).collect()} == want
    assert sum(want[i] != t for i, t in rows.items()) > 50


def test_line_chunks_have_content_defined_cuts():
    r = random.Random(4)
    body = [f"{r.random()} {r.random()}" for _ in range(400)]
    coarse = lambda x: {b"\n".join(x[a : a + n]) for a, n, c in zip(*[y.tolist() for y in linededup.spans(x)[:3]]) if c}
    one, two = [x.encode() for x in body], [x.encode() for x in ["new", "lines", *body[:200], "inserted", *body[200:]]]
    assert 20 < len(coarse(one)) < 100
    assert len(coarse(one) - coarse(two)) <= 1 and len(coarse(two) - coarse(one)) <= 3


def test_line_dedup_of_a_long_text_is_linear(spark):
    r = random.Random(5)
    half = "\n".join(" ".join(str(r.randrange(10**6)) for _ in range(8)) for _ in range(100_000))  # 5 MB
    rows = [(1, half + "\nbetween\n" + half, 7, "a", 1), (2, "---\n---\nx", 8, "b", 2), (3, "own\n---\n---", 9, "c", 3), (4, "\n\n\n", 1, "d", 4), (5, "\n\n\n", 1, "d", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rk long, `first` string, __rk int")
    begun = time.time()
    out = {x["doc_id"]: x for x in linededup.deduplicate(df).collect()}
    assert time.time() - begun < 60
    assert out[1]["text"] == half + "\nbetween" and out[2]["text"] == rows[1][1] and out[3]["text"] == "own"
    assert out[4]["text"] == out[5]["text"] == "\n\n\n"
    assert all((x["rk"], x["first"], x["__rk"]) == rows[i - 1][2:] for i, x in out.items())


def test_decontamination_tolerates_substitutions(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((13, 20, 50, 4, 8))] + [(9, None), (10, "")]
    rows, want = [], {}
    for i, text in items[:5]:
        for k in range(6):
            w = text.split()
            if len(w) >= 13:
                for at in r.sample(range(13), 2):
                    w[at] = word()
            rows.append((len(rows), " ".join([word() for _ in range(r.randint(0, 30))] + w + [word() for _ in range(5)]), None, None, 1, 1))
            want[rows[-1][0]] = [i]
    for _ in range(20):
        rows.append((len(rows), " ".join(word() for _ in range(60)), None, None, 1, 1))
        want[rows[-1][0]] = []
    rows += [(100, None, None, None, None, None), (101, "", None, None, None, None)]
    want |= {100: [], 101: []}
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert {x["doc_id"]: x["items"] for x in decontam.report(docs, bench).collect()} == want
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} == {i for i, found in want.items() if not found}


def test_masks_hit_every_window_with_two_changed_words():
    for a in range(13):
        for b in range(13):
            assert any(not {a, b} & {o + p for p in m} for m in decontam.MASKS for o in range(13 - m[-1]))


@pytest.mark.parametrize("group", [8, 1_024])
def test_vectors_match_brute_force(spark, group):
    g = np.random.default_rng(4)
    x = g.standard_normal((300, 16))
    for i in range(0, 150, 3):
        x[i + 1] = x[i] + 0.08 * g.standard_normal(16)
    x[200:240] = x[200] + 0.1 * g.standard_normal((40, 16))
    x[250] = x[251]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] + [1.0] * 15, 0), (303, [None] + [1.0] * 15, 0), (304, [1.0, 0.0], 0), (305, [2.0, 0.0], 0), (306, [], 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in projection.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, c int"), group=group).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(300)
    while True:
        low = np.minimum(label, np.where(near, label[None, :], 300).min(axis=1))
        if (low == label).all():
            break
        label = low
    want = {i: (int(near[i].sum()), int(label[i]), bool(label[i] == i)) for i in range(300)}
    want |= {i: (0, i, True) for i in (300, 301, 302, 303, 306)} | {304: (1, 304, True), 305: (1, 304, False)}
    assert got == want


def test_vectors_of_a_dense_group_meet(spark):
    g = np.random.default_rng(12)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(g.standard_normal((6_000, 64)))
    x[:2_000] = unit(np.sqrt(0.8) * x[0] + np.sqrt(0.2) * unit(g.standard_normal((2_000, 64))))
    side = g.standard_normal((300, 64))
    side = unit(side - (side * x[:300]).sum(axis=1, keepdims=True) * x[:300])
    x[2_000:2_300] = 0.905 * x[:300] + np.sqrt(1 - 0.905**2) * side
    x[3_000:3_700] = unit(x[3_000] + 1e-7 * g.standard_normal((700, 64)))  # no plane splits these
    near = x @ x.T >= 0.9
    a, b = np.nonzero(np.triu(near, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["component_id"] for r in projection.near_duplicates(df, block=32).collect()}
    planted = [i for i in range(300) if near[i, 2_000 + i]]
    assert len(planted) > 290 and sum(got[i] == got[2_000 + i] for i in planted) >= 0.97 * len(planted)
    assert np.mean([got[i] == got[j] for i, j in zip(a.tolist(), b.tolist())]) >= 0.98


def test_archive_gives_records_back(spark):
    big, small = "<p>" + "é" * 80, "<p>"
    rows = [(5, "u5", big), (2, "u2\r\nX: y", big), (9, None, big), (1, "u1", small), (3, "u3", small), (4, "u4", None), (2, "u2", big), (None, "n", big)]
    path = scratch_dir(spark, "archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = warc.record_bytes(warc.read_archive(spark, path)).collect()
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    assert Counter((r["record_id"], r["record_type"], r["refers_to"]) for r in got) == Counter(
        [(5, "revisit", 2), (2, "response", None), (9, "revisit", 2), (1, "response", None), (3, "response", None), (4, "response", None), (2, "response", None), (None, "response", None)])
    for r in got:
        assert r["payload_digest"] == hashlib.sha256(r["payload"]).hexdigest() and bytes(r["record"]).endswith(r["payload"] + b"\r\n\r\n")


def test_language_spans_and_prediction(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = pst.crc_part(F.col("doc_id"), 3) == 1
    model = langid.learn(docs.filter(~held))
    rows = langid.predict(docs, model, ["doc_id", "lang", held.alias("held")]).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows if r["held"]]) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (4, "日本語"), (5, "a" * 5_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, model, ["doc_id"]).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and got[4] in model.langs and got[5] in model.langs
    assert {r["doc_id"]: r["score"] for r in langid.predict(odd, model, ["doc_id"]).collect()}[4] == 0
    german, english = (next(r["text"] for r in docs.filter(F.col("lang") == x).take(1)) for x in ("de", "en"))
    assert {s[0] for s in langid.spans(model, german + " " + english)} >= {"de", "en"}
    nothing = langid.learn(docs.filter("false"))
    assert {r["lang_pred"] for r in langid.predict(odd, nothing, ["doc_id"]).collect()} == {"und"}
    kept = langid.keep_determined(odd.withColumn("lang_pred", F.lit("x")), model)
    assert kept.columns == ["doc_id", "text", "lang_pred"] and {r["doc_id"] for r in kept.collect()} == {4, 5}
    assert {r["doc_id"] for r in langid.keep_determined(odd, nothing).collect()} == {4, 5}


def test_workers_keep_no_words_after_a_task(spark, sf_dir):
    """Idle Python workers stay beside other work: what a task has cached goes when it ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn(docs)
    assert langid.keep_determined(docs, model).count() and langid.predict(docs, model, ["doc_id"]).agg(F.max("score")).first()[0] > 0
    model.predict(["some words"])
    assert len(model.index) == 2
    model.forget()
    assert not model.index and model.predict(["some words"]) == model.predict(["some words"])
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = bpe.round_trip(docs.repartition(8), path)

    def cached(batches):
        for batch in batches:
            found = [len(c.cache) + len(c.older) for c in bpe._CODECS.values()]
            yield pa.RecordBatch.from_arrays([pa.array([len(found)]), pa.array([sum(found)])], names=["codecs", "chunks"])

    assert tokens.agg(F.sum("n_tokens")).first()[0] > 1_000
    rows = spark.range(0, 64, 1, 8).mapInArrow(cached, "codecs long, chunks long").collect()
    assert max(r["codecs"] for r in rows) == 1 and {r["chunks"] for r in rows} == {0}


def language_model(r, n, words=6):
    """``n`` invented languages with a vocabulary each, and that vocabulary."""
    vocabulary = {f"l{k:03}": ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5))) for _ in range(words)] for k in range(n)}
    grams = {lang: dict(Counter(g for w in ws for g in langid.trigrams(w))) for lang, ws in vocabulary.items()}
    return langid.Model(grams, {lang: {"latin": 100} for lang in vocabulary}), vocabulary


def test_viterbi_finds_the_best_of_all_labellings():
    r = random.Random(4)
    for n in (2, 3):
        model, vocabulary = language_model(r, n)
        for _ in range(60):
            words = [r.choice(r.choice(list(vocabulary.values()))) for _ in range(r.randint(1, 7))]
            [labels], _ = model.label([" ".join(words)])
            scores = model.scores[model.rows(words)]
            value = lambda path: sum(scores[i, k] for i, k in enumerate(path)) - langid.SWITCH * sum(a != b for a, b in zip(path, path[1:]))
            best = max(value(path) for path in itertools.product(range(n), repeat=len(words)))
            assert value(labels.tolist()) == pytest.approx(best, abs=1e-9)


def test_languages_beyond_a_byte():
    model, vocabulary = language_model(random.Random(9), 300, 40)
    for lang in ("l000", "l126", "l127", "l128", "l150", "l255", "l256", "l299"):
        [name], [share] = model.predict([" ".join(vocabulary[lang])])
        assert name == lang and share > 0.9


def test_vectors_of_any_scale(spark):
    rows = [(1, [1e200, 2e200]), (2, [1e-200, 2e-200]), (3, [3.0, 6.0]), (4, [-1e300, 1e300]), (5, [0.0, 0.0])]
    got = projection.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {x["vec_id"]: (x["n_links"], x["component_id"]) for x in got} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}


def test_scores(spark, corpus, docs):
    got = pst.scores(docs, pst.crc_part(F.col("doc_id"), 10) != 0).collect()
    count = Counter()
    for i, t, *_ in corpus:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            count.update((t or "").lower().encode().split() + [b"\n"])
    n, v = sum(count.values()), len(count)
    want = defaultdict(list)
    for i, t, *_ in corpus:
        w = (t or "").lower().encode().split() + [b"\n"]
        want[i].append((len(w), sum(count[x] > 0 for x in w), n, round(sum(log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)))
    have = defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)))
        assert r["score"] <= 0
    assert {k: sorted(x) for k, x in have.items()} == {k: sorted(x) for k, x in want.items()}
    alone = pst.scores(docs, F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and abs(r["score"] - r["base_score"]) < 1e-9 for r in alone)


def tree_scores(rows):
    """Log10 probabilities of ``rows`` of (text, learned from) by the suffix tree, from plain counts of word tuples."""
    texts = [(t or "").encode().lower().split() + [pst.END] for t, _ in rows]
    count = Counter(w for t, (_, train) in zip(texts, rows) if train for w in t)
    n, scale = sum(count.values()), sum(count.values()) + pst.ADD * (len(count) + 1)
    p0 = lambda w: (count[w] + pst.ADD) / scale
    often = lambda w, share: count[w] >= max(1, share * n)
    other = 1 - sum(p0(w) for w in count if often(w, pst.SYMBOL))
    places = []  # word, the words before it from the nearest on, learned from
    for t, (_, train) in zip(texts, rows):
        for i, w in enumerate(t):
            places.append((w, tuple(reversed(([pst.END] + t[:i])[-pst.DEPTH :])), train, w if often(w, pst.SYMBOL) else None))
    p = {sym: p0(sym) if sym else other for *_, sym in places}
    now = [p[sym] for *_, sym in places]
    shorter = [0] * len(places)
    for depth, share in ((1, pst.CONTEXT), (2, pst.CONTEXT_2)):
        context = [b[:depth] if len(b) >= depth and all(often(w, share) for w in b[:depth]) else None for _, b, _, _ in places]
        pairs = Counter((c, sym) for c, (_, _, train, sym) in zip(context, places) if c and train)
        total = Counter(c for c, x in zip(context, places) if c and x[2])
        kept = {x: m for x, m in pairs.items() if total[x[0]] >= 1e-4 * n and m >= max(2, pst.ENTRY * n)}
        before = {(c, sym): q for c, (_, _, _, sym), q in zip(context, places, now)}
        gain, inside = Counter(), Counter()
        for (c, sym), m in kept.items():
            gain[c] += m * log(m / total[c] / before[c, sym])
            inside[c] += m
        for k, (c, x) in enumerate(zip(context, places)):
            if c in inside and shorter[k] == depth - 1:
                shorter[k] = depth
            if c in inside and gain[c] >= max(pst.MIN_TOTAL, pst.MIN_NATS * total[c]):
                now[k] = (kept.get((c, x[3]), 0) + (pst.PRIOR + total[c] - inside[c]) * now[k]) / (total[c] + pst.PRIOR)
    now = [q if sym else q * p0(w) / other for q, (w, _, _, sym) in zip(now, places)]
    for longer in range(1, pst.DEPTH + 1):
        context = [b[: s + longer] if min(len(b), pst.DEPTH) >= s + longer else None for s, (_, b, _, _) in zip(shorter, places)]
        pairs = Counter((c, x[0]) for c, x in zip(context, places) if c and x[2])
        total = Counter(c for c, x in zip(context, places) if c and x[2])
        gain, inside = Counter(), Counter()
        for c, q, (w, _, train, _) in zip(context, now, places):
            if c and train and pairs[c, w] >= 2:
                gain[c] += log(pairs[c, w] / total[c] / q)
                inside[c] += 1
        for k, (c, x) in enumerate(zip(context, places)):
            if c in inside and gain[c] >= max(pst.MIN_TOTAL, pst.MIN_NATS * total[c]):
                m = pairs[c, x[0]]
                now[k] = ((m if m >= 2 else 0) + (pst.PRIOR + total[c] - inside[c]) * now[k]) / (total[c] + pst.PRIOR)
    out, at = [], 0
    for t in texts:
        out.append(sum(log10(q) for q in now[at : at + len(t)]))
        at += len(t)
    return out


@pytest.mark.parametrize("head", [None, 1e-3])
def test_scores_equal_plain_counts(spark, corpus, monkeypatch, head):
    """Also where words outside the head, hashes in the texts, are learned."""
    for name in ("HEAD", "SYMBOL", "CONTEXT") if head else ():
        monkeypatch.setattr(pst, name, head)
    r = random.Random(8)
    weights = [1 / (k + 1) for k in range(400)]
    some = [" ".join("W" * (k % 7 == 0) + f"w{k}" for k in r.choices(range(400), weights, k=r.randint(0, 160))) for _ in range(150)]
    texts = [(i, t) for i, (_, t, *_) in enumerate(corpus)] + [(200 + i, t) for i, t in enumerate(some + some[:5])] + [(None, some[7]), (None, some[7])]
    out = pst.scores(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), F.col("doc_id") % 5 != 1)
    want = zip(texts, tree_scores([(t, i is not None and i % 5 != 1) for i, t in texts]))
    have, expected = (sorted((-1 if i is None else i, x) for i, x in rows) for rows in ([(x["doc_id"], x["score"]) for x in out.collect()], [(i, x) for (i, _), x in want]))
    assert [i for i, _ in have] == [i for i, _ in expected]
    assert [x for _, x in have] == pytest.approx([x for _, x in expected], abs=2e-3, rel=1e-6)


def test_scores_deal_out_words_in_few_bytes(spark, sf_dir):
    """A word goes to its bucket in fewer bytes than the keys of its text and contexts took (23)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(F.col("doc_id").alias("id"), F.lit(True).alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    counts = pst.word_counts(rows.select("text"))
    tree = pst.head_of(counts)
    share = spark.sparkContext.broadcast
    coded = pst.coded_texts(rows, share(tree))
    model = share(pst.grow(coded, tree))
    met = coded.join(pst.rare_counts(coded, counts.filter("false"), 4), "num", "left")
    size = sum(F.octet_length(c) for c in ("off", "w1", "w2", "w3", "s", "n"))
    dealt = sum(pst._places(met, model, 4, turn).agg(F.sum(size)).first()[0] for turn in range(pst.SLICES))
    words = counts.agg(F.sum("n")).first()[0]
    assert 0 < dealt < 16 * words


def test_scores_learn_rare_and_long_contexts(spark):
    """A word known by the one, or the three, words before it, whose share of the corpus is below any fixed one."""
    r = random.Random(6)
    word = lambda: f"w{r.randrange(3_000)}"
    some = lambda n: [word() for _ in range(n)]
    texts = [some(100) for _ in range(1_200)]
    for i in range(40):
        texts[i][50:52] = ["rare", "next"]
        texts[100 + i][50:54] = ["u", "v", "w", "goal"]
        texts[200 + i][50:54] = [word(), "v", "w", word()]
    asked = ["rare next", "u v w goal", "w1 rare w2", "rare u"]
    rows = [(i, " ".join(t), None, None, 0, 0) for i, t in enumerate(texts)] + [(5_000 + i, t, None, None, 0, 0) for i, t in enumerate(asked)]
    got = {x["doc_id"]: x["score"] - x["base_score"] for x in pst.scores(spark.createDataFrame(rows, DOCS), F.col("doc_id") < 5_000).filter("doc_id >= 5000").collect()}
    assert got[5_000] > 2 and got[5_001] > 2 and got[5_002] < 0.5
    levels = [np.array([1] * 30 + [2] * 30 + [1], dtype=np.uint32), np.array([5] * 30 + [0] * 31, dtype=np.uint32), np.zeros(61, dtype=np.uint32)]
    p = np.full(61, 1e-4, dtype=np.float32)
    p[-1] *= -1  # not learned
    s = np.array([9] * 30 + list(range(30)) + [9], dtype=np.uint32)
    gains = pst.bucket_gains(levels, s, p)
    one = (30 + 20e-4) / 50
    assert np.allclose(gains[-1], log10(one / 1e-4), atol=1e-4) and not gains[30:60].any()  # single next words teach nothing


def test_empty_tables(spark, docs):
    none, path = docs.filter("false"), public_tokenizers.path(queries.TOKENIZER)
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (bpe.round_trip(none, path), linededup.report(none), substring.report(none), jaccard.report(none), suffixarray.report(none), decontam.report(none, bench),
                pst.scores(none, F.lit(True)), projection.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")), jaccard.keep_one(none), linededup.deduplicate(none)):
        assert out.count() == 0
    assert decontam.report(docs, bench).filter("contaminated").count() == 0


def test_registered_archive_matches_sql(spark, con, sf_dir):
    from check import compare

    ok, text = compare(spark, con, sf_dir, "op1_warc", queries.QUERIES["op1_warc"], queries.ORACLES["op1_warc"])
    assert ok, text


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
    last = corpus_pipeline.run(spark, sf_dir)
    assert last.filter("size(ids) <> n_tokens").count() == 0


def test_pipeline_against_brute_force(spark, sf_dir):
    """Every decision of the stages after language ID, from the rows the stage before kept."""
    import corpus_pipeline

    r = random.Random(11)
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("size(split(text, ' ')) >= 15").first()["text"]
    words = [w for row in given.filter("lang = 'en'").select("text").limit(50).collect() for w in (row[0] or "").split()]
    some = lambda n: " ".join(r.choice(words) for _ in range(n))
    boiler = "\n".join(some(12) for _ in range(12))
    near = some(200).split()
    planted = [some(30) + "\n" + boiler + "\n" + some(30) for _ in range(3)]
    planted += [" ".join([*near[:i], "changed", *near[i + 1 :]]) for i in (20, 90, 150)] + [" ".join(near)] * 2
    planted += [some(40) + " " + item + " " + some(40), None, "", "123 456 -- 789"]
    first = 10_000_000
    dtypes = dict(given.dtypes)
    extra = spark.createDataFrame([(first + i, t) for i, t in enumerate(planted)], "doc_id long, text string")
    docs = given.unionByName(extra.withColumn("doc_id", F.col("doc_id").cast(dtypes["doc_id"])), allowMissingColumns=True)
    folder = scratch_dir(spark, "pipeline-test")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now = {row["doc_id"]: row["text"] for row in corpus_pipeline.language_id(spark, docs, folder).collect()}
    gone = {row["doc_id"]: row["text"] for row in docs.collect() if row["doc_id"] not in now}
    assert {first + len(planted) - i for i in (1, 2, 3)} <= set(gone)
    assert all(not t or not any(c.isalpha() for c in t) for t in gone.values())

    seen, after = set(), {}
    for i in sorted(now):
        lines, drop = now[i].split("\n"), set()
        for at, n, body in linededup.chunks(now[i]):
            if body in seen:
                drop |= set(range(at, at + n))
            seen.add(body)
        after[i] = "\n".join(x for k, x in enumerate(lines) if k not in drop)
    assert sum(after[i] != now[i] for i in range(first, first + 3)) >= 2

    low = lambda t: [w for w in re.split("[\\x20\\x09-\\x0D]+", t.translate(LOWER)) if w]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if (w := low(t)) else set() for i, t in after.items()}
    holders = defaultdict(set)
    for i, own in sets.items():
        for g in own:
            holders[g].add(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in sets.items():
        common = Counter(j for g in own for j in holders[g] if j < i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    kept = {i: t for i, t in after.items() if find(i) == i}
    assert first + 3 in kept and not {first + i for i in range(4, 8)} & set(kept)

    got = {row["doc_id"]: row for row in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) <= set(kept) and first + 8 not in got and first + 3 in got
    items = [low(row["text"] or "") for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    exact = {tuple(w[k : k + 13]) for w in items for k in range(len(w) - 12)}
    holds = lambda w: any(tuple(w[k : k + 13]) in exact for k in range(len(w) - 12))
    assert not any(holds(low(kept[i])) for i in got)
    assert all(any(overlaps(low(kept[i]), w) for w in items) for i in set(kept) - set(got))
    tok = Tokenizer.from_file(str(public_tokenizers.path(queries.TOKENIZER)))
    for i, row in got.items():
        ids = tok.encode(kept[i], add_special_tokens=False).ids
        assert list(row["ids"]) == ids and row["n_tokens"] == len(ids)


LOWER = {c: c + 32 for c in range(65, 91)}



def overlaps(words, item):
    """Whether thirteen consecutive words of ``item`` (all, when fewer) stand in ``words``, up to a fifth of them changed."""
    width = min(13, len(item))
    need = 11 if width == 13 else width
    places = defaultdict(list)
    for j, w in enumerate(item):
        places[w].append(j)
    lines = defaultdict(set)
    for k, w in enumerate(words):
        for j in places.get(w, ()):
            lines[k - j].add(j)
    return width > 0 and any(sum(j + d in on for d in range(width)) >= need for on in lines.values() if len(on) >= need for j in range(len(item) - width + 1))


@pytest.mark.parametrize("head, word, pair", [(None, None, None), (2e-4, 1e-2, 1e-3), (2e-4, 1e-3, 1e-4)])
def test_scores_count_every_next_word_of_frequent_contexts(spark, monkeypatch, head, word, pair):
    """After frequent contexts too next words count from two occurrences on, each for itself, whoever holds the counts."""
    for name, value in (("HEAD", head), ("SHARED_WORD", word), ("SHARED", pair)):
        if value:
            monkeypatch.setattr(pst, name, value)
    r = random.Random(12)
    weights = [1 / (k + 1) for k in range(300)]
    texts = [" ".join(f"w{k}" for k in r.choices(range(300), weights, k=60)) for _ in range(700)]
    texts += [f"w0 only{k % 90} w1 w0 once{k} w1 w0 both{k % 40}" for k in range(200)]
    asked = ["w0 only7", "w1 w0 both3", "w0 once9", "w0 never", "w1 w0 w250", ""]
    rows = [(t, True) for t in texts] + [(t, False) for t in asked]
    docs = spark.createDataFrame([(i, t, train) for i, (t, train) in enumerate(rows)], "doc_id long, text string, train boolean")
    have = [x["score"] for x in sorted(pst.scores(docs.repartition(3), F.col("train")).collect(), key=lambda x: x["doc_id"])]
    monkeypatch.setattr(pst, "SYMBOL", 0.0)  # of the plain counts: nothing is cut
    monkeypatch.setattr(pst, "ENTRY", 0.0)
    assert have == pytest.approx(tree_scores(rows), abs=2e-3, rel=1e-6)
