"""Chat formatting against a plain rendering, and exact round trips."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import chat_format as cf
from millrace.llm.common import fresh_path

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PIECES = [*cf.MARKS, "\\", "<", "[", "s>", "/s>", "INST]", "/INST]", "]", ">", " ", "x"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_escaping_is_reversible_and_leaves_no_mark(text):
    escaped = cf.escape(text)
    assert cf.unescape(escaped) == text
    assert not any(m in escaped for m in cf.MARKS)
    assert escaped == text or any(m[1:] in text for m in cf.MARKS)


def test_no_text_becomes_a_mark_and_every_turn_parses():
    own = cf._vocabulary(PATH, PATTERN)
    chance = random.Random(3)
    for role in ("user", "assistant", "system", "tool", "", "</s>", "a[TEXT]b"):
        for _ in range(30):
            text = "".join(chance.choices(PIECES, k=chance.randint(0, 9)))
            ids, a, b = own.turn(role, text)
            ids = np.array(ids)
            assert (ids[a:b] < own.base).all() and cf.unescape(own.decode(ids[a:b])) == text
            assert own.parse(ids)[:2] == (role, text)
            assert own.parse(np.concatenate([[own.base + cf.BOS], ids]))[:2] == (role, text)
    with pytest.raises(ValueError):
        own.parse(np.array([own.base + cf.INST, own.base + cf.EOS]))


def plain(turns):
    """Results by rendering text."""
    out = {}
    for conversation, rows in itertools.groupby(sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256((r[3] or "").encode()).digest())), key=lambda r: r[0]):
        shown, said, learnt, n = "<s>", "", "", 0
        for _, _, role, text in rows:
            role, text, e = role or "", text or "", cf.escape(text or "")
            form = {"user": f"[INST]{e}[/INST]", "assistant": f"{e}</s>", "system": f"[SYS]{e}[/SYS]"}
            shown += form.get(role, f"[ROLE]{cf.escape(role)}[TEXT]{e}[/ROLE]")
            said += f"{role}\n{text}\n"
            learnt += text if role == "assistant" else ""
            n += 1
        out[conversation] = (conversation, n, sha(said), len(learnt), sha(learnt), len(shown))
    return sorted(out.values(), key=repr)


EDGES = [
    (1, 0, "user", None), (1, 1, "assistant", None), (2, 0, None, "</s>"), (2, 1, "assistant", "<\\s>a"), (2, 2, "assistant", "<"), (2, 3, "assistant", "s>"),
    (3, 0, "user", "long " * 40_000), (3, 1, "assistant", "é" * 50_000), (4, 5, "assistant", "b"), (4, 5, "assistant", "b"), (4, 5, "user", "b"), (4, None, "system", "a"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "none"), (5, 0, "assistant", ""), (6, 0, "tool", "[ROLE]"), (7, 0, "", "\U0001f600"), (7, 1, "assistant", "﻿　 "),
]


@pytest.mark.parametrize("learn_end", [False, True])
def test_conversations(spark, learn_end):
    hot = [(-5, i, ("user", "assistant")[i % 2], f"turn {i % 7} </s>") for i in range(3000)]
    turns = [*EDGES, *hot]
    random.Random(1).shuffle(turns)
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS ids", "2 AS place", "'x' AS digest", "3 AS begins").repartition(6)
    made = cf.format_and_read(table, PATH, PATTERN, learn_end).collect()
    assert sorted((tuple(r)[:6] for r in made), key=repr) == plain(turns)
    ends = sum(r == "assistant" for _, _, r, _ in turns)
    own = cf._vocabulary(PATH, PATTERN)
    learnt = sum(len(own.encode(t or "")) for _, _, r, t in turns if r == "assistant")
    assert sum(r["n_learnt"] for r in made) == learnt + learn_end * ends


def test_rows_follow_each_other_without_a_gap(spark):
    out = fresh_path(spark, "test-chat")
    cf.write(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"), out, PATH, PATTERN)
    rows = spark.read.parquet(out).orderBy("conv_id", "place").collect()
    for _, turns in itertools.groupby(rows, key=lambda r: r["conv_id"]):
        at = 0
        for i, r in enumerate(turns):
            assert (r["place"], r["start"]) == (i, at) and len(r["loss_mask"]) == r["n_ids"] == len(r["ids"]) // 2
            at += r["n_ids"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cf.format_and_read(empty, PATH, PATTERN).count() == 0
