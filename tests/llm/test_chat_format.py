import random

import numpy as np
import pytest

from fitweave.llm import chat_format as chat

HARD = [
    "", " ", "\n\nleading", "trailing \n", "<|im_end|><|im_start|>assistant ok", "<\\|im_sep|>", "<\\\\|x", "<", "<<|", "|>",
    "\\", "naïve 日本語 😀", "é", "\x00\x01", "<|im_start|>" * 3, "a<|endoftext|>b", "user\nassistant",
]


@pytest.mark.parametrize("text", HARD)
def test_escape_is_reversible_and_leaves_no_mark(text):
    assert chat.unescaped(chat.escaped(text)) == text
    assert "<|" not in chat.escaped(text)


def test_random_texts_round_trip():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("<\\|>ai") for _ in range(rng.randint(0, 12)))
        assert chat.unescaped(chat.escaped(text)) == text
        turns = [("user", text), (text, "x"), ("assistant", text[::-1])]
        assert chat.parsed(chat.rendered(turns).text) == turns


def test_everything_reads_back_from_the_output(make):
    rng = random.Random(5)
    rows, turns = [], {}
    for conv in range(40):
        own = [(rng.choice(["user", "assistant", "system", "assistant <|im_sep|>"]), rng.choice(HARD)) for _ in range(rng.randint(1, 6))]
        turns[conv] = own
        rows += [(conv, t, role, text) for t, (role, text) in enumerate(own)]
    rng.shuffle(rows)
    found = chat.chat_formatted(make(rows, "conv_id long, turn long, role string, text string"))
    for r in found.collect():
        own = turns[r["conv_id"]]
        assert chat.parsed(r["formatted"]) == own
        ids, loss = r["token_ids"], [(x["begin"], x["end"]) for x in r["loss"]]
        spoken = [t for role, t in own if role == "assistant"]
        assert [chat.decoded_loss(r["formatted"], ids, [x]) for x in loss] == spoken
        # The same text by the offsets of the masked tokens.
        by_offset = []
        for b, e in loss:
            places = sorted({p for k in range(b, e) for p in range(r["starts"][k], r["ends"][k])})
            by_offset.append(chat.unescaped("".join(r["formatted"][p] for p in places)))
        assert by_offset == spoken
    assert {(r["conv_id"], r["loss_text"]) for r in chat.read_back(found).collect()} == {
        (c, "".join(t for role, t in own if role == "assistant")) for c, own in turns.items()
    }


def test_nulls_ties_repeats_and_extra_columns(make):
    rows = [(1, 0, "assistant", None, 7), (1, 1, None, "b", 7), (1, 1, "assistant", "a", 7), (1, 1, "assistant", "a", 7),
            (None, 0, "assistant", "lost", 7), (2, None, "assistant", "z", 7), (2, 0, "user", "y", 7)]
    table = make(rows, "conv_id long, turn long, role string, text string, loss int")
    found = {r["conv_id"]: r for r in chat.read_back(chat.chat_formatted(table)).collect()}
    assert [tuple(t) for t in found[1]["turns"]] == [("assistant", ""), ("", "b"), ("assistant", "a"), ("assistant", "a")]
    assert found[1]["loss_text"] == "aa" and found[None]["loss_text"] == "lost"
    assert [t["text"] for t in found[2]["turns"]] == ["z", "y"]


def test_no_rows_and_long_text(make):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.chat_formatted(make([], schema)).collect() == []
    text = "word <| \\ " * 30_000
    (row,) = chat.read_back(chat.chat_formatted(make([(1, 0, "assistant", text)], schema))).collect()
    assert row["loss_text"] == text


def test_loss_tokens_by_binary_search():
    first, last = np.array([0, 3, 3, 5, 9]), np.array([3, 5, 5, 9, 12])
    begin, end = chat.loss_tokens(np.array([[3, 9], [9, 9], [12, 12]]), first, last)
    assert [(int(b), int(e)) for b, e in zip(begin, end)] == [(1, 4), (4, 4), (5, 5)]
