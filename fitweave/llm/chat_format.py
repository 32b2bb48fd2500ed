"""Chat formatting with a loss mask aligned by offsets.

A conversation is rendered as one string, turn after turn:

    <|im_start|>role<|im_sep|>text<|im_end|>

It is encoded once, with the character span of every token.  The three marks
are special tokens, so no token reaches across a border of a text.  The sorted
spans of the turns that carry loss are intersected with the sorted token spans
by binary search; the tokens found are the loss mask.

Roles and texts cannot hold a mark: between ``<`` and ``|`` one backslash more
is written than was there (``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|``), and
reading takes it off again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.DOTALL)


def escaped(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


class Rendered(NamedTuple):
    text: str
    roles: list[str]
    spans: np.ndarray  # (turns, 2): characters of each escaped text


def rendered(turns: list[tuple[str | None, str | None]]) -> Rendered:
    """The conversation as one string, with the span of every text; nulls are empty."""
    parts, roles, spans, at = [], [], [], 0
    for role, text in turns:
        role, text = role or "", text or ""
        head, body = f"{START}{escaped(role)}{SEP}", escaped(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
        roles.append(role)
    return Rendered("".join(parts), roles, np.array(spans, np.int64).reshape(-1, 2))


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation, read back."""
    return [(unescaped(role), unescaped(text)) for role, text in _TURN.findall(formatted)]


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    found = Tokenizer.from_file(path)
    found.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (START, SEP, END)])
    return found


def loss_tokens(spans: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ranges [from, to) that each span covers.

    ``first`` and ``last`` are the sorted starts and ends of the tokens.  The
    marks cut the string, so a token lies inside one span or outside of all.
    """
    begin = np.searchsorted(first, spans[:, 0], "left")
    end = np.searchsorted(last, spans[:, 1], "right")
    return begin, np.maximum(begin, end)


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``: the rows of each conversation by turn.

    Equal turns stand by role and text, a missing turn first.  Rows without a
    conv_id are one conversation.
    """
    row = F.struct("turn", "role", "text")
    return conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))


FORMATTED = "conv_id long, formatted string, token_ids array<int>, starts array<int>, ends array<int>, loss array<struct<begin:int,end:int>>"
_FORMATTED_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("formatted", pa.string()), ("token_ids", pa.list_(pa.int32())),
     ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
     ("loss", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))]
)
#: Conversations that are encoded before rows go out.
STEP = 64


def chat_formatted(conversations: DataFrame, path: str = TOKENIZER, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """One row per conversation: the string, its tokens and the loss mask.

    ``starts`` and ``ends`` are character offsets of the tokens; ``loss`` holds
    one token range [begin, end) for each turn whose role carries loss.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        for batch in batches:
            for at in range(0, len(batch), STEP):
                part = batch.slice(at, STEP)
                shown = [rendered([(t["role"], t["text"]) for t in turns]) for turns in part.column(1).to_pylist()]
                found: dict[str, list] = {k: [] for k in ("token_ids", "starts", "ends", "loss")}
                for r in shown:
                    code = encoder.encode(r.text, add_special_tokens=False)
                    offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
                    wanted = r.spans[[role in loss_roles for role in r.roles]] if r.roles else r.spans
                    begin, end = loss_tokens(wanted, offsets[:, 0], offsets[:, 1])
                    found["token_ids"].append(np.array(code.ids, np.int32))
                    found["starts"].append(offsets[:, 0].astype(np.int32))
                    found["ends"].append(offsets[:, 1].astype(np.int32))
                    found["loss"].append([{"begin": b, "end": e} for b, e in zip(begin.tolist(), end.tolist())])
                yield pa.RecordBatch.from_pydict(
                    {"conv_id": part.column(0), "formatted": [r.text for r in shown], **found}, schema=_FORMATTED_ARROW
                )

    return turns_of(conversations).select(F.col("conv_id").cast("long"), "turns").mapInArrow(scan, FORMATTED)


def decoded_loss(formatted: str, token_ids: list[int], loss: list[tuple[int, int]], path: str = TOKENIZER) -> str:
    """Text under the loss mask, decoded from the masked tokens of each range."""
    encoder = tokenizer(path)
    return "".join(unescaped(encoder.decode(token_ids[b:e], skip_special_tokens=False)) for b, e in loss)


def read_back(formatted: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """Adds ``turns`` (role, text) read from the string and ``loss_text`` read from the masked tokens."""
    added = "conv_id long, formatted string, turns array<struct<role:string,text:string>>, loss_text string, n_tokens long, n_loss_tokens long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            turns, texts, tokens, masked = [], [], [], []
            for shown, ids, loss in zip(*(batch.column(k).to_pylist() for k in ("formatted", "token_ids", "loss"))):
                ranges = [(x["begin"], x["end"]) for x in loss]
                turns.append([{"role": a, "text": b} for a, b in parsed(shown)])
                texts.append(decoded_loss(shown, ids, ranges, path))
                tokens.append(len(ids))
                masked.append(sum(e - b for b, e in ranges))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("formatted"), pa.array(turns, kind), pa.array(texts, pa.string()),
                 pa.array(tokens, pa.int64()), pa.array(masked, pa.int64())],
                ["conv_id", "formatted", "turns", "loss_text", "n_tokens", "n_loss_tokens"],
            )

    return formatted.select("conv_id", "formatted", "token_ids", "loss").mapInArrow(scan, added)


def digest(turns: Column) -> Column:
    """Hex digest of role, line end, text, line end of every turn."""
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
