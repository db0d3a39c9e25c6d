"""Chat formatting with a token loss mask.

A conversation is rendered whole, turn after turn:

    <|im_start|>role<|im_sep|>text<|im_end|>

Inside a role or text every ``<|`` is written ``<|~``, so neither can imitate
a mark; taking that tilde away again gives the text back.

The rendering is encoded once, with offsets; the three marks are tokens of
their own, so no other token reaches across the end of a text. Turn spans, in
code points and sorted, are intersected with the sorted token spans by
binary search: a token is under the loss mask when it lies in the text of an
assistant turn. The masked tokens cover exactly these texts.

Defined results: rows with a null conv_id are one conversation; null turns
come first; rows with the same turn stand by role and text, and repeated
rows are repeated turns; a null role is ``user``, a null text empty; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END, LOSS_ROLE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "assistant"
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.DOTALL)
#: Conversations encoded at a time.
_STEP = 256
_TOKENIZERS: dict[str, object] = {}


def escape(text: str) -> str:
    return text.replace("<|", "<|~")


def unescape(text: str) -> str:
    return text.replace("<|~", "<|")


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The rendering; the (start, end) span of each turn's text in it, ascending; whether it counts for the loss."""
    parts, spans, loss, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        parts += [head, body, END]
        spans.append((at + len(head), at + len(head) + len(body)))
        loss.append(role == LOSS_ROLE)
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, dtype=np.int64).reshape(-1, 2), np.array(loss, dtype=bool)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendering."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(rendered)]


def tokenizer(path: str | None = None):
    """The byte-level tokenizer with the three marks as special tokens, once per worker."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    if path not in _TOKENIZERS:
        from tokenizers import AddedToken, Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        t = Tokenizer.from_file(path)
        t.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (START, SEP, END)])
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def loss_mask(offsets: np.ndarray, spans: np.ndarray, loss: np.ndarray) -> np.ndarray:
    """Whether each token (start, end) lies inside a span that counts: for a token
    the last span that starts at or before it is found by binary search."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), dtype=bool)
    at = np.searchsorted(spans[:, 0], offsets[:, 0], side="right") - 1
    inside = (at >= 0) & (offsets[:, 1] <= spans[at, 1]) & (offsets[:, 1] > offsets[:, 0])
    return inside & loss[at]


def masked_texts(rendered: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The stretches of the rendering that masked tokens cover, unescaped. Several tokens may share a character."""
    if not loss.any():
        return []
    s, e = starts[loss], np.maximum.accumulate(ends[loss])
    cut = np.flatnonzero(s[1:] > e[:-1]) + 1
    return [unescape(rendered[a:z]) for a, z in zip(s[np.r_[0, cut]], e[np.r_[cut - 1, len(e) - 1]], strict=True)]


def format_conversations(rows: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(conv_id, formatted, ids, starts, ends, loss): the rendering of every
    conversation of ``rows(conv_id, turn, role, text)``, its tokens, their
    places in code points, and the loss mask."""
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select("conv_id", "t.role", "t.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(tokenizer_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, _STEP):
                part = batch.slice(lo, _STEP)
                made = [render(list(zip(r, x, strict=True))) for r, x in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                ids, starts, ends, loss = [], [], [], []
                for (_, spans, counts), e in zip(made, t.encode_batch([m[0] for m in made], add_special_tokens=False), strict=True):
                    places = np.array(e.offsets, dtype=np.int32).reshape(-1, 2)
                    ids.append(np.array(e.ids, dtype=np.int32))
                    starts.append(places[:, 0])
                    ends.append(places[:, 1])
                    loss.append(loss_mask(places, spans, counts))
                numbers = lambda x: pa.array(x, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([m[0] for m in made], pa.string()), numbers(ids), numbers(starts), numbers(ends),
                     pa.array(loss, pa.list_(pa.bool_()))], ["conv_id", "formatted", "ids", "starts", "ends", "loss"])

    return whole.mapInArrow(run, "conv_id long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>")


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from format_conversations' output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                starts, ends, loss = (batch.column(j)[i].values.to_numpy(zero_copy_only=False) for j in (2, 3, 4))
                turns = parse(text)
                told = "".join(f"{r}\n{t}\n" for r, t in turns)
                counted = "".join(masked_texts(text, starts, ends, loss.astype(bool)))
                out.append((len(turns), hashlib.sha256(told.encode()).hexdigest(), len(counted), hashlib.sha256(counted.encode()).hexdigest(), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[j] for r in out], k) for j, k in enumerate(kinds))],
                                             ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "starts", "ends", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
