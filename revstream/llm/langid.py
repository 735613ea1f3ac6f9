"""Language identification of mixed-language texts.

The script of a word (by Unicode range of its first letter) narrows the candidate languages. Every word gets a
score per candidate: the log likelihood of its letter trigrams under a model learned from labelled rows. Viterbi
over the words of a text, with a penalty for switching, labels spans; the prediction is the language whose
spans hold the most letters and the score is its share of the letters of labelled words.

Learning uses a bounded sample: about ``MAX_TRAIN`` rows of each language, drawn by a hash of id and text, and
the ``MAX_TRIGRAMS`` most frequent trigrams of each language. Everything else covers all rows and whole texts.

Defined cases: NULL text, or text without a letter, is ``und`` with score 0. In a text with no word in a script
that a learned language uses, all learned languages compete on all its words, with score 0. Without
labelled rows there is no language to choose, and every text is ``und``. Ties go to the first language by name;
rows are independent, so repeated rows repeat their result; other columns are ignored. ``keep_determined`` drops
texts without a letter and mixtures; it keeps texts that no learned language could be told of.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstream.llm.common import release_memory, ship, tidied

MAX_TRAIN = 2_000
MAX_TRIGRAMS = 20_000
SWITCH = 8.0  # nats a change of language costs
SMOOTH = 0.5
KEEP_SHARE = 0.4  # below it a text is a mixture that no language carries
CACHE_WORDS = 300_000  # while a task runs
TEXTS = 500  # labelled side by side
WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
# First code points of the ranges of scripts, in order; a range ends where the next begins.
SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])


def script(word: str) -> str:
    """Script of the first letter of a word."""
    at = int(np.searchsorted(_STARTS, ord(word[0]), side="right")) - 1
    return SCRIPTS[at][1] if at >= 0 else "other"


def trigrams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


class Model:
    """Trigram log probabilities and scripts of the learned languages; scores words and labels texts."""

    def __init__(self, grams: dict[str, dict[str, int]], scripts: dict[str, dict[str, int]]):
        self.langs = sorted(scripts)
        n = len(self.langs)
        known = {g for c in grams.values() for g in c}
        table = np.full((len(known), n), SMOOTH)
        self.row = {g: i for i, g in enumerate(sorted(known))}
        for k, lang in enumerate(self.langs):
            for g, c in grams.get(lang, {}).items():
                table[self.row[g], k] += c
        total = table.sum(axis=0) + SMOOTH if n else np.zeros(0)
        self.table = np.log(table / total) if n else table
        self.padded = np.vstack([self.table, np.log(SMOOTH / total) if n else np.zeros(0)])  # last: unseen
        self.uses = {}
        for k, lang in enumerate(self.langs):
            words = sum(scripts[lang].values())
            for s, c in scripts[lang].items():
                if c >= 0.01 * words:
                    self.uses.setdefault(s, np.zeros(n, dtype=bool))[k] = True
        self.forget()

    def forget(self) -> None:
        """Drop the scored words. A task does so at its end: its Python worker keeps the model."""
        self.index: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.langs)))
        self.weight = np.zeros(1024, dtype=np.int64)

    def add(self, words: list[str]) -> None:
        """Score new words; weight 0 marks a word in a script no language uses."""
        row, unknown, first, k = self.row, len(self.row), len(self.index), len(self.langs)
        at, cuts, none = [], [], np.zeros(k, dtype=bool)
        may = np.empty((len(words), k), dtype=bool)
        for i, word in enumerate(words):
            low = word.lower()
            may[i] = self.uses.get(script(low), none)
            cuts.append(len(at))
            w = f"^{low}$"
            at += [row.get(w[j : j + 3], unknown) for j in range(len(w) - 2)]
            self.index[word] = first + i
        s = np.add.reduceat(self.padded[at], cuts, axis=0)
        s = np.where(may, s, -np.inf)
        used = may.any(axis=1)
        s[~used] = 0.0
        s = np.maximum(s - s.max(axis=1, keepdims=True), -1e3)
        need = first + len(words)
        if need > len(self.scores):
            grown = np.zeros((2 * need, k))
            grown[:first] = self.scores[:first]
            weights = np.zeros(2 * need, dtype=np.int64)
            weights[:first] = self.weight[:first]
            self.scores, self.weight = grown, weights
        self.scores[first:need], self.weight[first:need] = s, np.where(used, [len(w) for w in words], 0)

    def rows(self, words: list[str]) -> np.ndarray:
        """Rows of the words' scores."""
        index = self.index
        found = list(map(index.get, words))
        if None in found:
            self.add(list(dict.fromkeys(w for w, i in zip(words, found) if i is None)))
            found = list(map(index.__getitem__, words))
        return np.array(found, dtype=np.int64)

    def label(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For every text, the language number and the letters of each of its words (-1: no language uses its script).

        Texts go side by side through the recursion, longest first: one vector step per word position.
        """
        if len(self.index) > CACHE_WORDS:
            self.index.clear()
        words = [WORD.findall(t) if t else [] for t in texts]
        size = np.array([len(x) for x in words], dtype=np.int64)
        order = np.argsort(-size, kind="stable")
        n, k = len(texts), len(self.langs)
        if not k or not size.sum():
            return [np.full(x, -1) for x in size], [np.zeros(x, dtype=np.int64) for x in size]
        flat = self.rows([w for i in order for w in words[i]])
        start = np.concatenate([[0], np.cumsum(size[order])])[:n]
        sizes = size[order]
        kind = np.int8 if k <= 127 else np.int32
        back = np.zeros((len(flat), k), dtype=kind)
        labels = np.full(len(flat), -1, dtype=np.int64)
        v = np.zeros((n, k))
        live = np.searchsorted(-sizes, -np.arange(1, (int(sizes[0]) if n else 0) + 1), side="right")
        own = np.arange(k, dtype=kind)
        for t, m in enumerate(live):
            at = start[:m] + t
            here = v[:m]
            if t:
                best = here.argmax(axis=1)
                change = here[np.arange(m), best] - SWITCH
                stay = here >= change[:, None]
                back[at] = np.where(stay, own, best[:, None])
                here = np.where(stay, here, change[:, None])
            v[:m] = here + self.scores[flat[at]]
        state = v.argmax(axis=1) if n else np.zeros(0, dtype=np.int64)
        for t in range(len(live) - 1, -1, -1):
            m = live[t]
            at = start[:m] + t
            labels[at] = state[:m]
            state[:m] = back[at, state[:m]]
        letters = self.weight[flat]
        labels[letters == 0] = -1
        out_l, out_w = [None] * n, [None] * n
        for j, i in enumerate(order):
            out_l[i], out_w[i] = labels[start[j] : start[j] + sizes[j]], letters[start[j] : start[j] + sizes[j]]
        return out_l, out_w

    def guess(self, words: list[str]) -> str:
        """The likeliest of all learned languages for words in scripts that none of them uses."""
        if not words or not self.langs:
            return UNDETERMINED
        unknown = len(self.row)
        found = Counter(self.row.get(g, unknown) for word in words for g in trigrams(word.lower()))
        at, n = np.array(list(found)), np.array(list(found.values()))
        return self.langs[int((self.padded[at] * n[:, None]).sum(axis=0).argmax())]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, shares = [], []
        for text, lab, letters in zip(texts, *self.label(texts)):
            total = int(letters.sum())
            if not total:
                names.append(self.guess(WORD.findall(text) if text else []))
                shares.append(0.0)
                continue
            by = np.bincount(lab[lab >= 0], weights=letters[lab >= 0], minlength=len(self.langs))
            names.append(self.langs[int(by.argmax())])
            shares.append(float(by.max() / total))
        return names, shares


def spans(model: Model, text: str) -> list[tuple[str, int, int]]:
    """``(language, first word, one past the last word)`` of the labelled spans of one text."""
    lab = model.label([text])[0][0]
    edges = [0, *(np.flatnonzero(np.diff(lab)) + 1).tolist(), len(lab)] if len(lab) else []
    return [(model.langs[lab[a]] if lab[a] >= 0 else UNDETERMINED, a, b) for a, b in zip(edges, edges[1:])]


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_train: int = MAX_TRAIN) -> Model:
    """Fit on about ``max_train`` rows of each language; the counts that reach the driver are bounded."""
    ship(labelled.sparkSession)
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1_000_000)).alias("draw"),
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Model({}, {})
    share = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, max_train / n) * 1_000_000)).otherwise(share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                words.setdefault(lang, Counter()).update(WORD.findall(text.as_py().lower()))
        for lang, counted in words.items():
            for word, c in counted.items():
                found[lang, True, script(word)] += c
                for g in trigrams(word):
                    found[lang, False, g] += c
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([k[2] for k in keys], pa.string()),
             pa.array([found[k] for k in keys], pa.int64())], names=["lang", "script", "what", "n"])

    counts = rows.filter(F.col("draw") < share).select("lang", "text").mapInArrow(tidied(count), "lang string, script boolean, what string, n long")
    counts = counts.groupBy("lang", "script", "what").agg(F.sum("n").alias("n"))
    grams: dict[str, dict[str, int]] = {}
    scripts: dict[str, dict[str, int]] = {lang: {} for lang in sizes}
    nth = F.row_number().over(Window.partitionBy("lang", "script").orderBy(F.desc("n"), "what"))
    for r in counts.withColumn("nth", nth).filter(F.col("script") | (F.col("nth") <= MAX_TRIGRAMS)).collect():
        (scripts if r["script"] else grams).setdefault(r["lang"], {})[r["what"]] = r["n"]
    return Model(grams, scripts)


def predict(docs: DataFrame, model: Model, keep: list[str | Column], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_TRIGRAMS a language at most
    names = [f"k{i}" for i in range(len(keep))]
    plain = docs.select(*[c if isinstance(c, Column) else F.col(c) for c in keep]).schema
    rows = docs.select(*[(c if isinstance(c, Column) else F.col(c)).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("predicted_text"))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, plain)) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                langs, shares = model.predict(part.column("predicted_text").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(langs, pa.string()), pa.array(shares, pa.float64())], names=[*names, "lang_pred", "score"])
        model.forget()

    out = rows.mapInArrow(tidied(run), schema)
    return out.select(*[F.col(n).alias(f.name) for n, f in zip(names, plain)], "lang_pred", "score")


def keep_determined(docs: DataFrame, model: Model, text_col: str = "text", least: float = KEEP_SHARE) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which one language has at least ``least`` of the letters.

    Texts with letters but none in a script that a learned language uses stay as well.
    """
    model.forget()
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def determined(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for text in columns:
            kept = []
            for at in range(0, len(text), TEXTS):
                part = text.iloc[at : at + TEXTS].tolist()
                _, shares = model.predict(part)
                # A share of 0 means that no word could be labelled: such a text stays if it has a letter.
                kept += [share >= least or (share == 0 and bool(x) and WORD.search(x) is not None) for x, share in zip(part, shares)]
            yield pd.Series(kept, dtype=bool)
        model.forget()
        release_memory()

    return docs.filter(F.pandas_udf(determined, "boolean")(F.col(text_col)))
