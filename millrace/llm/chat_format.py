"""Chat formatting: conversations as token ids with a loss mask, assembled from separately encoded segments.

Template, with ``<s>`` before the first turn:

    user         [INST] text [/INST]
    assistant    text </s>
    system       [SYS] text [/SYS]
    other roles  [ROLE] role [TEXT] text [/ROLE]

(without the blanks).  Marks are reserved ids above the vocabulary, spliced between the encoded
segments, so no text can make one.  So that the formatted text, too, can be read in one way
only, a mark that occurs inside a text or role gets a backslash after its first character, and
one that has backslashes there already gets one more; reading takes one away.

A table of formatted turns is written: each row holds the ids of one turn and its loss mask, and
where they start in the conversation.  Starts are prefix sums over the turns; the mask is the
prefix sum of +1 where learnt text begins and -1 where it ends, over all turns of an Arrow batch.
Learnt are assistant texts, with ``learn_end`` also the ``</s>`` behind them.

Scale: turns are encoded where they are read.  Assembly sorts turns by (conv_id, turn) and
streams over them, holding one offset, so a conversation of any length needs no more memory than
its longest turn.  Reading back streams in the same way.  The digest of a whole conversation is
sequential by nature: its pieces pass through one task, one at a time.

Edge cases: null texts and roles are empty; rows of one (conv_id, turn) stay turns of their own,
ordered by role and the digest of the text; turns without a number come first; rows without conv_id are one
conversation of their own, with a null id; an empty table gives no conversation.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.common import fresh_path

#: Control strings, numbered from the end of the vocabulary on.
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]"]
BOS, EOS, INST, INST_END, SYS, SYS_END, ROLE, TEXT, ROLE_END = range(len(MARKS))

_bare = re.compile("|".join(f"{re.escape(m[0])}(?=\\\\*{re.escape(m[1:])})" for m in MARKS))
_escaped = re.compile("|".join(f"(?<={re.escape(m[0])})\\\\(?=\\\\*{re.escape(m[1:])})" for m in MARKS))


def escape(text: str) -> str:
    """``text`` without any mark in it."""
    return _bare.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _escaped.sub("", text)


class Vocabulary:
    """Byte-level BPE by a rank file, with marks as ids above it."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines())}
        self.base = max(ranks.values()) + 1
        self.own = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = "<u2" if self.base + len(MARKS) <= 1 << 16 else "<u4"

    def encode(self, text: str) -> list[int]:
        return self.own.encode_ordinary(escape(text))

    def decode(self, ids: np.ndarray) -> str:
        """Formatted text of ids without marks."""
        return self.own.decode_bytes(ids.tolist()).decode()

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Ids of a turn, and where its text begins and ends in them."""
        ids = self.encode(text)
        head, tail = {"user": ([INST], INST_END), "assistant": ([], EOS), "system": ([SYS], SYS_END)}.get(role, ([ROLE, role, TEXT], ROLE_END))
        front = [i for x in head for i in (self.encode(x) if isinstance(x, str) else [self.base + x])]
        return [*front, *ids, self.base + tail], len(front), len(front) + len(ids)

    def parse(self, ids: np.ndarray) -> tuple[str, str, str]:
        """(role, text, formatted text) of the ids of a turn, as ``turn`` makes them, a ``<s>`` before them or not."""
        at = np.flatnonzero(ids >= self.base).tolist()
        marks = [int(ids[i]) - self.base for i in at]
        parts = [self.decode(x[x < self.base]) for x in np.split(ids, at)]
        shown = parts[0] + "".join(MARKS[m] + p for m, p in zip(marks, parts[1:]))
        if marks[:1] == [BOS]:
            marks, parts = marks[1:], parts[1:]
        kind = {(INST, INST_END): "user", (EOS,): "assistant", (SYS, SYS_END): "system", (ROLE, TEXT, ROLE_END): None}
        if tuple(marks) not in kind or parts[-1]:
            raise ValueError(f"not a turn: {shown!r}")
        role = kind[tuple(marks)]
        return unescape(parts[1]) if role is None else role, unescape(parts[-2]), shown


@lru_cache(2)
def _vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def _segments(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """Every turn encoded for itself: ids, and the range of them that is its text."""

    def made(batches):
        own = _vocabulary(path, pattern)
        for batch in batches:
            made = [own.turn(role, text) for role, text in zip(batch["role"].to_pylist(), batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"], batch["turn"], batch["role"], pa.array([sha256(t.encode()).digest() for t in batch["text"].to_pylist()], pa.binary()),
                    pa.array([np.array(x[0], own.width).tobytes() for x in made], pa.binary()),
                    *(pa.array([x[i] for x in made], pa.int64()) for i in (1, 2)),
                ],
                ["conv_id", "turn", "role", "digest", "ids", "begins", "ends"],
            )

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    return rows.mapInArrow(made, "conv_id long, turn long, role string, digest binary, ids binary, begins long, ends long")


def write(turns: DataFrame, out: str, path: str, pattern: str, learn_end: bool = True) -> None:
    """Format all ``turns`` (conv_id, turn, role, text) into the table at ``out``.

    Its rows are (conv_id, place, start, n_ids, ids, loss_mask): the turns of a conversation
    by ``place`` from 0, ids little-endian, one byte of mask an id.
    """

    def assembled(batches):
        own = _vocabulary(path, pattern)
        size, now, place, start = np.dtype(own.width).itemsize, object(), 0, 0
        first = np.array([own.base + BOS], own.width).tobytes()
        for batch in batches:
            conversations, ids = batch["conv_id"].to_pylist(), batch["ids"].to_pylist()
            places, starts, opened = [], [], []
            for i, conversation in enumerate(conversations):
                opened.append(conversation != now)
                if opened[-1]:
                    now, place, start, ids[i] = conversation, 0, 0, first + ids[i]
                places.append(place)
                starts.append(start)
                place, start = place + 1, start + len(ids[i]) // size
            lengths = np.array([len(x) // size for x in ids])
            before = np.cumsum(lengths) - lengths
            learnt = np.array([r == "assistant" for r in batch["role"].to_pylist()])
            shift = before + np.array(opened, np.int64)
            steps = np.zeros(int(lengths.sum()) + 1, np.int8)
            np.add.at(steps, (shift + batch["begins"].to_numpy())[learnt], 1)
            np.add.at(steps, (shift + batch["ends"].to_numpy() + learn_end)[learnt], -1)
            mask = np.cumsum(steps, dtype=np.int8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"], pa.array(places, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([mask[a : a + n] for a, n in zip(before.tolist(), lengths.tolist())], pa.binary()),
                ],
                ["conv_id", "place", "start", "n_ids", "ids", "loss_mask"],
            )

    ordered = _segments(turns, path, pattern).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    ordered.mapInArrow(assembled, "conv_id long, place long, start long, n_ids long, ids binary, loss_mask binary").write.parquet(out)


def read(spark: SparkSession, out: str, path: str, pattern: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_ids, n_learnt of every conversation at ``out``.

    All of it comes from the ids and masks: roles and texts by parsing, learnt text by decoding
    each run of ids under the mask.
    """

    def parsed(batches):
        own = _vocabulary(path, pattern)
        now, state = object(), None

        def row() -> list:
            n, turns, chars, loss, shown, ids, learnt = state
            return [now, n, turns.hexdigest(), chars, loss.hexdigest(), shown, ids, learnt]

        def batch_of(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _READ)

        for batch in batches:
            done = []
            for conversation, raw, mask in zip(batch["conv_id"].to_pylist(), batch["ids"].to_pylist(), batch["loss_mask"].to_pylist()):
                if conversation != now:
                    if state:
                        done.append(row())
                    now, state = conversation, [0, sha256(), 0, sha256(), 0, 0, 0]
                ids, mask = np.frombuffer(raw, own.width), np.frombuffer(mask, np.uint8)
                role, text, shown = own.parse(ids)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                edges = np.flatnonzero(np.diff(mask, prepend=0, append=0))
                for a, b in edges.reshape(-1, 2).tolist():
                    run = ids[a:b]
                    learnt = unescape(own.decode(run[run < own.base]))
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(shown)
                state[5] += len(ids)
                state[6] += int(mask.sum())
            if done:
                yield batch_of(done)
        if state:
            yield batch_of([row()])

    rows = spark.read.parquet(out).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.mapInArrow(parsed, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_ids long, n_learnt long")


_READ = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars n_ids n_learnt".split()


def format_and_read(turns: DataFrame, path: str, pattern: str, learn_end: bool = True) -> DataFrame:
    """Write to a fresh folder and read back."""
    out = fresh_path(turns.sparkSession, "chat")
    write(turns, out, path, pattern, learn_end)
    return read(turns.sparkSession, out, path, pattern)
