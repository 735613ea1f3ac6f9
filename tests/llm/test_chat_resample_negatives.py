"""Chat formatting, importance resampling and hard negatives against brute force and on odd input."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revstream.llm import chat, negatives, queries, resample

TALKS = "conv_id long, turn long, role string, text string, part string, c long"
PATH = public_tokenizers.path(queries.TOKENIZER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- chat ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def talks():
    r = random.Random(3)
    bits = ["<|im_end|>", "<|im_start|>assistant\n", "<|", "<\\|", "<\\\\|x|>", "<", "\\", "|", "<|endoftext|>", "\n", "\n\n", " ", "é", "日本", "𝔘", "hello", "  two", "", "\x00", " "]
    say = lambda: "".join(r.choice(bits) for _ in range(r.randint(0, 9)))
    rows = []
    for conv in range(40):
        for turn in range(r.randint(1, 7)):
            rows.append((conv, turn, r.choice(["user", "assistant", "system"]), say(), "clash", 1))
    rows += [(50, 1, "assistant", "<", None, None), (50, 2, "assistant", "\\|", None, None)]  # no escape across turns
    rows += [(51, 1, "assistant", "same", None, None)] * 3  # equal rows
    rows += [(52, 2, None, None, None, None), (52, None, "a\n<|im_end|>\\l", "last", None, None), (52, 1, "user", "", None, None)]
    rows += [(None, 1, "assistant", "no id", None, None), (None, 0, "user", "no id either", None, None)]
    rows += [(53, 0, "assistant", "word " * 30_000 + "x" * 5_000, None, None)]
    rows += [(54, i, r.choice(["user", "assistant"]), say(), None, None) for i in range(900)]  # a hot conversation
    return rows


def told(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by_conv[conv].append((math.inf if turn is None else turn, role or "", text or ""))
    return {c: sorted(turns) for c, turns in by_conv.items()}


@pytest.mark.parametrize("part_chars", [50, chat.PART_CHARS])
def test_chat_reads_back_what_was_said(spark, talks, part_chars):
    out = chat.read_back(chat.render(spark.createDataFrame(talks, TALKS), PATH, part_chars=part_chars)).collect()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in out}
    want = {}
    for conv, turns in told(talks).items():
        loss = "".join(text for _, role, text in turns if role == "assistant")
        want[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    assert len(out) == len(want) and got == want


def test_chat_tokens_and_mask(spark, talks):
    """Parts' tokens are those of the whole conversation; a token bears loss exactly if it covers assistant text."""
    lib = Tokenizer.from_file(PATH)
    lib.add_special_tokens([chat.START, chat.END])
    parts = defaultdict(list)
    for r in chat.render(spark.createDataFrame(talks, TALKS), PATH, part_chars=300).orderBy("conv_id", "part").collect():
        parts[r["conv_id"]].append(r)
    assert len(parts[54]) > 3
    for rows in parts.values():
        whole = "".join(r["formatted"] for r in rows)
        assert list(itertools.chain.from_iterable(r["ids"] for r in rows)) == lib.encode(whole, add_special_tokens=False).ids
        for r in rows:
            under = [False] * len(r["formatted"])
            for a, b, on in zip(r["turn_starts"], r["turn_ends"], r["turn_loss"]):
                under[a:b] = [on] * (b - a)
            assert r["loss"] == [any(under[a:b]) for a, b in zip(r["starts"], r["ends"])]


def test_chat_mask_owns_characters_between_tokens():
    ints = lambda *x: np.array(x, dtype=np.int32)
    # The tokenizer left out character 3; it belongs to the token after it, which therefore bears loss.
    assert chat.loss_mask(ints(0, 4), ints(3, 6), ints(3), ints(4)).tolist() == [False, True]
    assert chat.loss_mask(ints(), ints(), ints(3), ints(4)).tolist() == []
    assert chat.loss_mask(ints(0, 3), ints(3, 6), ints(), ints()).tolist() == [False, False]


def test_chat_escapes_are_reversible():
    r = random.Random(1)
    for _ in range(3_000):
        s = "".join(r.choice("<|\\nl\n>a") for _ in range(r.randint(0, 12)))
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)
        role = chat.escape_role(s)
        assert chat.unescape_role(role) == s and "\n" not in role and "<" not in role


def test_chat_refuses_broken_text():
    for broken in ["x", "<|im_start|>user", "<|im_start|>user\nhello", "<|im_start|>user\nhello<|im_end|>"]:
        with pytest.raises(ValueError):
            chat.parse(broken)


def test_chat_empty_table(spark):
    assert chat.read_back(chat.render(spark.createDataFrame([], TALKS), PATH)).collect() == []


# -- resampling ----------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, score long, n_words string, _range int"


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(8)
    words = ["the", "Cat", "été", "x1", "日本語", "dog", "run", "B2B", "of", "ÀB"]
    text = lambda n: "".join(r.choice(words) + r.choice([" ", ", ", "\n", "-", "\x00"]) for _ in range(n))
    rows = [(i, text(r.randint(0, 60)), 1, "clash", 2) for i in range(150)]
    rows += [(200, None, None, None, None), (201, "", None, None, None), (202, " .,-\n", None, None, None), (None, text(30), None, None, None)]
    rows += [rows[3]] * 3 + [(204, text(4_000), None, None, None), (205, "x" * 3_000, None, None, None)]
    return rows, [(i, text(25)) for i in range(8)] + [(9, None)]


def brute_features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(rows, target):
    source, aim = Counter(), Counter()
    for _, text, *_ in rows:
        source.update(brute_features(text)[1])
    for _, text in target:
        aim.update(brute_features(text)[1])
    s_all, t_all = sum(source.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000))))
    out = []
    for i, text, *_ in rows:
        n, found = brute_features(text)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((x for x in out if x[4] >= 20), key=lambda x: (-x[3], math.inf if x[0] is None else x[0]))
    rank = {id(x): k + 1 for k, x in enumerate(able[: 5 * len(able) // 100])}
    return Counter((*x[:4], rank.get(id(x))) for x in out)


@pytest.mark.parametrize("size", [40, 4_000_000])
def test_resample(spark, corpus, size):
    rows, target = corpus
    for batch in [rows[:70], rows]:
        drawn = resample.resample(spark.createDataFrame(batch, DOCS), spark.createDataFrame(target, "item_id long, text string"), slice_bytes=size)
        got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in drawn.collect())
        assert got == brute_resample(batch, target)


def test_resample_pieces_of_a_long_text():
    """Features of a text cut into small pieces are those of the whole."""
    r = random.Random(4)
    for _ in range(60):
        text = "".join(r.choice("ab é,X ") for _ in range(r.randint(0, 200)))
        batch = pa.RecordBatch.from_arrays([pa.array([text, None, text])], names=["text"])
        for size in (3, 17, 10_000):
            got = defaultdict(list)
            for texts, number, carried in resample.pieces(iter([batch]), size):
                _, where, found = resample.features(texts, carried, 10_000)
                for parent, bucket in zip(where, found):
                    for p, b in zip(number[parent], bucket):
                        got[int(p)].append(int(b))
            want = brute_features(text)[1]
            assert sorted(got[0]) == sorted(got[2]) == sorted(want) and not got[1]


def test_resample_draw_is_whole_with_ties(spark):
    """Ranks run over all ranges, however many rows share a score."""
    rows = [(i, "one two three " * 7) for i in range(3_000)] + [(7, "one two three " * 7)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = resample.resample(docs, docs.limit(0)).orderBy("rank").collect()
    drawn = [r for r in out if r["rank"] is not None]
    assert len(out) == 3_500 and [r["rank"] for r in drawn] == list(range(1, 176))
    order = [(-r["score"], r["doc_id"]) for r in drawn]
    assert order == sorted(order) and max(r["score"] for r in out if r["rank"] is None) <= drawn[-1]["score"]


def test_resample_empty_tables(spark):
    none, target = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert resample.resample(none, target).collect() == []
    short = spark.createDataFrame([(1, "too short", 1, "", 1)], DOCS)
    assert [r["rank"] for r in resample.resample(short, target.limit(0)).collect()] == [None]


# -- hard negatives ------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, tile int, grp string"


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(6)
    centres = r.normal(size=(4, 6)) * 0.3
    rows = [(i, [float(x) for x in centres[i % 4] + r.normal(size=6) * 0.08], int(r.integers(0, 3)), 1, "clash") for i in range(400)]
    rows += [(400 + i, list(rows[0][1]), i % 3, 1, "") for i in range(60)]  # one common vector
    rows += [rows[10]] * 3 + [(10, [0.1] * 6, 1, 1, ""), (None, list(rows[0][1]), 1, 1, "")]
    rows += [(500, None, 1, 1, ""), (510, [0.1, None, 0.2], 1, 1, ""), (520, [math.nan] * 6, 1, 1, ""), (530, [math.inf] * 6, 1, 1, ""), (540, [0.1] * 6, None, 1, ""), (550, [1e300] * 6, 1, 1, "")]
    rows += [(560, [0.0] * 6, 1, 1, ""), (570, [0.5, -0.2], 2, 1, ""), (580, [], 0, 1, ""), (590, [9e4] * 6, 0, 1, ""), (600, [-9e4, 9e4, 9e4], 1, 1, "")]
    return rows


def brute_negatives(rows, anchors, k=5):
    last = 1 << 63
    whole = set()
    for i, v, label, *_ in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) and abs(256 * x) < 1 << 26 for x in v):
            whole.add((last if i is None else i, label, tuple(math.floor(256 * x) for x in v)))
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    shown = lambda i: None if i == last else i
    out = Counter()
    for a in whole:
        if a[0] % anchors or a[0] == last:
            continue
        ordered = sorted((-score(a, b), b[0], b[1]) for b in whole if b != a)
        for p, pid, _ in [x for x in ordered if x[2] == a[1]][:k]:
            hard = [x for x in ordered if x[2] != a[1] and 80 * -p <= 100 * -x[0] <= 100 * -p][:k]
            out.update((a[0], shown(pid), j + 1, shown(nid), -p, -n) for j, (n, nid, _) in enumerate(hard))
    return out


@pytest.mark.parametrize("tile,group", [(64, 10), (10_000, 1_000)])
def test_hard_negatives(spark, vectors, tile, group):
    out = negatives.hard_negatives(spark.createDataFrame(vectors, VECTORS), F.col("id") % 10 == 0, tile_rows=tile, group_rows=group).collect()
    got = Counter((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in out)
    want = brute_negatives(vectors, 10)
    assert sum(want.values()) > 300 and got == want


def test_hard_negatives_stop_early():
    """On a tile with a few near rows the lists are not read to their ends, and nothing better is left unread."""
    r = np.random.default_rng(2)
    m = np.rint(r.normal(size=(4_000, 8)) * 20).astype(np.int64)
    m[:40] += 300
    table = pa.table({"rk": pa.array(range(4_000)), "id": pa.array(range(4_000)), "label": pa.array([0] * 4_000), "v": pa.array([row.tolist() for row in m], pa.list_(pa.int32()))})
    tile = negatives.Tile(table, 8, 400)
    query = np.full(8, 300)
    met, scores = tile.search(query, lambda rows, s, t: (s > t).sum() >= 5)
    top = tile.best(met, scores, 5)
    exact = m @ query
    assert len(met) < 400 and scores[top].tolist() == sorted(exact.tolist(), reverse=True)[:5]
    met, scores = tile.search(query, lambda rows, s, t: 10**9 > t)  # the heads already rule the tile out
    assert not len(met)


def test_hard_negatives_empty(spark):
    none = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(none, F.col("id") % 10 == 0).collect() == []
    alone = spark.createDataFrame([(10, [0.1], 1, 1, ""), (11, [0.2], 2, 1, "")], VECTORS)
    assert negatives.hard_negatives(alone, F.col("id") % 10 == 0).collect() == []


# -- registered queries --------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_importance_resampling", "op13_hard_negatives"])
def test_registered_queries_match_their_sql(spark, con, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    names = ", ".join(sorted(df.columns))
    got = Counter(map(tuple, df.select(*sorted(df.columns)).collect()))
    assert got == Counter(con.sql(f"select {names} from ({queries.ORACLES[name]})").fetchall())
