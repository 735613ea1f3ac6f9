"""Chat formatting with token masks: conversations rendered whole, encoded once with offsets, loss by spans.

``render`` writes every turn as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end, and
encodes the rendered conversation once. The two markers are single tokens beside the vocabulary, so no other
token crosses them. Turn spans and token spans are both sorted; a binary search of the token starts among the
ends of the spans under the loss says which tokens carry loss. A token that only reaches into a span (a line
end before the text that merges with one in it) carries loss too; its part outside the span does not count
when the text under the loss is read.

Escapes: ``<``, any number of backslashes and ``|`` get one backslash more, so no text can hold a marker or any
other control string of that form, and taking one backslash away gives the text back. Roles also escape line
ends and ``<``.

A conversation that holds a large share of all rows is spread: rows are dealt by ranges of (conversation,
turn), and a conversation is cut at turns where a range ends or its text exceeds ``PART_CHARS``. Since the
markers separate tokens, the parts' tokens are those of the whole. ``read_back`` joins parts again; only
the digests of such a conversation (each one sequence of bytes) are taken by one task, which streams over them.

Defined cases: NULL text and NULL role are empty; a NULL turn comes last, ties go by role and text; rows without
a conversation id are one conversation without an id; equal rows are turns of their own; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from revstream.llm.bpe import _file
from revstream.llm.common import partitions

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)
PART_CHARS = 2_000_000

RENDERED = (
    "conv_id long, part long, whole boolean, formatted string, ids array<int>, starts array<int>, ends array<int>, "
    "loss array<boolean>, turn_starts array<int>, turn_ends array<int>, turn_loss array<boolean>"
)
_READ = "conv_id long, part long, n_turns long, turns binary, loss binary, loss_chars long, formatted_chars long, whole boolean"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_TOKENIZERS: dict[str, Tokenizer] = {}


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "l": "<"}.get(m[1], m[1]), role)


def _tokenizer(source: tuple) -> Tokenizer:
    """The tokenizer with the two markers added, built once in each Python worker."""
    digest, file = source
    if digest not in _TOKENIZERS:
        _TOKENIZERS.clear()
        tokenizer = Tokenizer.from_str(file.value)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (START, END)])
        _TOKENIZERS[digest] = tokenizer
    return _TOKENIZERS[digest]


def owned_starts(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the characters of each token begin, with those that the tokenizer left out between it and the last."""
    before = np.concatenate([np.zeros(1, dtype=ends.dtype), np.maximum.accumulate(ends)[:-1]])
    return np.minimum(starts, before)


def loss_mask(starts: np.ndarray, ends: np.ndarray, span_starts: np.ndarray, span_ends: np.ndarray) -> np.ndarray:
    """Tokens that share a character with one of the sorted, disjoint, non-empty spans."""
    if not len(span_starts) or not len(starts):
        return np.zeros(len(starts), dtype=bool)
    first = owned_starts(starts, ends)
    at = np.searchsorted(span_ends, first, side="right")  # the first span that ends after the token's start
    return (at < len(span_starts)) & (span_starts[np.minimum(at, len(span_starts) - 1)] < ends) & (first < ends)


class _Rendering:
    """Turns of one conversation, rendered one after the other."""

    def __init__(self, conv_id: int | None, opened: bool):
        self.conv_id, self.opened = conv_id, opened  # opened: the conversation may have begun before
        self.pieces: list[str] = []
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.roles: list[str] = []
        self.size = 0

    def add(self, role: str, text: str) -> None:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        self.starts.append(self.size + len(head))
        self.ends.append(self.size + len(head) + len(body))
        self.roles.append(role)
        self.pieces += [head, body, END, "\n"]
        self.size = self.ends[-1] + len(END) + 1


def _encoded(conv: _Rendering, tokenizer: Tokenizer, loss_roles: tuple[str, ...]) -> dict:
    formatted = "".join(conv.pieces)
    encoding = tokenizer.encode(formatted, add_special_tokens=False)
    ids = np.array(encoding.ids, dtype=np.int32)
    spans = np.fromiter(chain.from_iterable(encoding.offsets), dtype=np.int32, count=2 * len(ids)).reshape(-1, 2)
    turn_starts, turn_ends = np.array(conv.starts, dtype=np.int32), np.array(conv.ends, dtype=np.int32)
    turn_loss = np.array([role in loss_roles for role in conv.roles], dtype=bool)
    under = turn_loss & (turn_starts < turn_ends)
    return {
        "formatted": formatted,
        "ids": ids,
        "starts": spans[:, 0],
        "ends": spans[:, 1],
        "loss": loss_mask(spans[:, 0], spans[:, 1], turn_starts[under], turn_ends[under]),
        "turn_starts": turn_starts,
        "turn_ends": turn_ends,
        "turn_loss": turn_loss,
    }


def _rows(rows: list[dict]) -> pa.RecordBatch:
    columns = [
        pa.array([r["conv_id"] for r in rows], pa.int64()),
        pa.array([r["part"] for r in rows], pa.int64()),
        pa.array([r["whole"] for r in rows], pa.bool_()),
        pa.array([r["formatted"] for r in rows], pa.string()),
    ]
    names = ["ids", "starts", "ends", "loss", "turn_starts", "turn_ends", "turn_loss"]
    for name in names:
        offsets = np.concatenate([[0], np.cumsum([len(r[name]) for r in rows])]).astype(np.int32)
        columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([r[name] for r in rows]))))
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "whole", "formatted", *names])


def render(conversations: DataFrame, path: str, loss_roles: tuple[str, ...] = LOSS_ROLES, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per conversation (``RENDERED``): its text, token ids, token spans, loss mask and turn spans.

    ``path`` names a file of the tokenizers library. ``part`` orders the parts of a conversation; ``whole`` says
    that a row surely holds all of it.
    """
    source = _file(conversations, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = _tokenizer(source), TaskContext.get().partitionId()
        out: list[dict] = []
        held, serial = 0, 0
        conv = None

        def close(ended: bool) -> None:
            nonlocal held, serial
            held += conv.size
            serial += 1
            whole = ended and not conv.opened
            out.append({"conv_id": conv.conv_id, "part": task << 32 | serial, "whole": whole} | _encoded(conv, tokenizer, loss_roles))

        for batch in batches:
            for conv_id, role, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if conv is None:
                    conv = _Rendering(conv_id, opened=True)  # the range before may hold its first turns
                elif conv.conv_id != conv_id:
                    close(ended=True)
                    conv = _Rendering(conv_id, opened=False)
                elif conv.size >= part_chars:
                    close(ended=False)
                    conv = _Rendering(conv_id, opened=True)
                conv.add(role.as_py(), text.as_py())
                if held >= part_chars or len(out) >= 1000:
                    yield _rows(out)
                    out, held = [], 0
        if conv is not None:
            close(ended=False)  # the next range may hold its last turns
            yield _rows(out)

    turns = conversations.select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("t"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("r"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("x")
    )
    order = [F.col("c").asc(), F.col("t").asc_nulls_last()]
    dealt = turns.repartitionByRange(partitions(conversations.sparkSession), *order).sortWithinPartitions(*order, "r", "x")
    return dealt.select("c", "r", "x").mapInArrow(run, RENDERED)


_TURN = re.compile(re.escape(START) + r"([^\n<]*)\n((?:(?!<\|).)*)" + re.escape(END) + r"\n", re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a rendered conversation, unescaped."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        end = formatted.find(END, line + 1)
        if not formatted.startswith(START, at) or line < 0 or end < 0 or formatted[end + len(END) : end + len(END) + 1] != "\n":
            raise ValueError(f"not a rendered conversation at character {at}")
        turns.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def text_under_loss(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray, turn_starts: np.ndarray, turn_ends: np.ndarray, turn_loss: np.ndarray) -> str:
    """What the masked tokens cover of the turns under the loss, every character once, unescaped turn by turn."""
    first, last = owned_starts(starts, ends)[loss], ends[loss]
    delta = np.zeros(len(formatted) + 1, dtype=np.int32)
    np.add.at(delta, first, 1)
    np.add.at(delta, last, -1)
    covered = np.cumsum(delta[:-1]) > 0
    points = np.frombuffer(formatted.encode("utf-32-le"), dtype="<u4")
    read = []
    for a, b in zip(turn_starts[turn_loss], turn_ends[turn_loss]):
        read.append(unescape(points[a:b][covered[a:b]].tobytes().decode("utf-32-le")))
    return "".join(read)


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation (``DIGESTS``), from the rendered rows alone: digests of all turns and of the text under the loss.

    Whole conversations are reduced to digests where they are; only parts travel.
    """
    names = ["formatted", "starts", "ends", "loss", "turn_starts", "turn_ends", "turn_loss"]
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fixed = {c: batch.column(c).to_pylist() for c in ("conv_id", "part", "whole")}
            rows = []
            for i, (conv_id, part, whole) in enumerate(zip(*fixed.values())):
                text, *arrays = (batch.column(c)[i] for c in names)
                text, arrays = text.as_py(), [a.values.to_numpy(zero_copy_only=False) for a in arrays]
                turns = parse(text)
                canonical = "".join(f"{role}\n{said}\n" for role, said in turns).encode()
                loss = text_under_loss(text, *arrays)
                data = [canonical, loss.encode()]
                if whole:
                    data = [sha(d).encode() for d in data]
                rows.append((conv_id, part, len(turns), *data, len(loss), len(text), whole))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)],
                names=[c.split()[0] for c in _READ.split(", ")],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [c.split() for c in DIGESTS.split(", ")]
        kinds = [pa.int64() if k == "long" else pa.string() for _, k in fields]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names=[c for c, _ in fields])

        running, rows = None, []  # of a conversation in parts: id, turns, digest, characters, digest, characters
        for batch in batches:
            for conv_id, _, n, turns, loss, loss_chars, chars, whole in zip(*(batch.column(i) for i in range(8))):
                conv_id, n, turns, loss, loss_chars, chars = (x.as_py() for x in (conv_id, n, turns, loss, loss_chars, chars))
                if running is not None and (whole.as_py() or running[0] != conv_id):
                    rows.append((running[0], running[1], running[2].hexdigest(), running[3], running[4].hexdigest(), running[5]))
                    running = None
                if whole.as_py():
                    rows.append((conv_id, n, turns.decode(), loss_chars, loss.decode(), chars))
                    continue
                if running is None:
                    running = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                running[1] += n
                running[2].update(turns)
                running[3] += loss_chars
                running[4].update(loss)
                running[5] += chars
            yield out(rows)
            rows = []
        if running is not None:
            yield out([(running[0], running[1], running[2].hexdigest(), running[3], running[4].hexdigest(), running[5])])

    parts = rendered.select("conv_id", "part", "whole", *names).mapInArrow(read, _READ)
    n = partitions(rendered.sparkSession)
    return parts.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(merge, DIGESTS)
