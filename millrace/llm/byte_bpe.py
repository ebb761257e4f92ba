"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut by a pattern; each match is one of the vocabulary's byte strings or is merged:
the neighbouring pair whose joint bytes have the lowest rank first, the leftmost of equals
first.  Matches wait in one linked list of parts.  The queue has a bucket of positions for
each rank that occurs, and a hierarchical bitmap tells the lowest filled rank by
find-first-set.  A merge changes the two pairs beside it: their new ranks are queued, their
old entries stay and are skipped when they surface (the pair at that place has another rank
by then).  Work is proportional to the merges, not to the square of a match's length.

``RankQueue`` takes one entry at a time.  ``Codec.merge_all`` lays all new matches of a batch
into one list and takes a whole bucket at a time: merges in different matches do not touch,
and within one the order by rank and place is the same.  Where a merge makes a pair of lower
rank than its own (so that order inside the bucket would matter), that match is merged again
entry by entry.

A text is looked up by chunks that begin at a space after a visible character: no match of
the pattern spans such a place, so chunks can be encoded apart and remembered.  The memory
of a worker is emptied when the objects it holds take ``MEMORY`` bytes; results do not depend
on it.  Texts are taken in slices of ``SLICE`` bytes, so what a slice adds before the next look
at the memory, and its lists of chunks, stay small for any size of an Arrow batch.

Edge cases: null counts as empty and has no token; any Unicode text and any length work;
ids outside the vocabulary are an error in decoding; repeated rows are treated alike.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heappop, heappush
from pathlib import Path
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import terms
from millrace.llm.common import small_batches, written

MEMORY, ENTRY = 64 << 20, 72  # bytes of remembered chunks and matches in a worker, and of an entry beside its two objects
SLICE = 2 << 20
_WORD = 8  # log2 of the bits in one word of the bitmap
_NONE = np.int32(2**31 - 1)
_run = re.compile(r"\s |^ ").search


class Bitmap:
    """A set of small numbers: a word for every 256 of them, words over the words that are filled, up to one."""

    def __init__(self, size: int):
        self.levels = []
        while True:
            size = (size + (1 << _WORD) - 1) >> _WORD
            self.levels.append([0] * max(1, size))
            if size <= 1:
                break

    def add(self, number: int) -> None:
        for level in self.levels:
            word = number >> _WORD
            filled = level[word]
            level[word] = filled | 1 << (number & 255)
            if filled:
                return
            number = word

    def remove(self, number: int) -> None:
        for level in self.levels:
            word = number >> _WORD
            level[word] &= ~(1 << (number & 255))
            if level[word]:
                return
            number = word

    def first(self) -> int:
        """The lowest number; -1 of an empty set."""
        if not self.levels[-1][0]:
            return -1
        number = 0
        for level in reversed(self.levels):
            bits = level[number]
            number = (number << _WORD) | ((bits & -bits).bit_length() - 1)
        return number


class RankQueue:
    """Positions by rank; the lowest rank first, the lowest position of a rank first."""

    def __init__(self, ranks: int):
        self.filled = Bitmap(ranks)
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [at]
            self.filled.add(rank)
        else:
            heappush(bucket, at)

    def pop(self) -> tuple[int, int]:
        """(rank, position); rank -1 where nothing is left."""
        rank = self.filled.first()
        if rank < 0:
            return -1, -1
        bucket = self.buckets[rank]
        at = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.filled.remove(rank)
        return rank, at


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.size = max(ranks.values(), default=0) + 1
        self.bytes_of = np.full(self.size, None, object)
        self.text_of = np.array([str(i) for i in range(self.size)] or [""], object)
        for piece, i in ranks.items():
            self.bytes_of[i] = piece
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self._pair_table()
        self.forget()

    def _pair_table(self) -> None:
        """All pairs of tokens whose joint bytes are a token, in an open-addressing table."""
        keys, values = [], []
        for piece, rank in self.ranks.items():
            for i in range(1, len(piece)):
                left, right = self.ranks.get(piece[:i]), self.ranks.get(piece[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
        todo, ranks = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(todo)
        while len(todo):
            free = self.keys[slot] < 0
            placed = np.zeros(len(todo), bool)
            at, who = np.unique(slot[free], return_index=True)
            who = np.flatnonzero(free)[who]
            self.keys[at], self.values[at], placed[who] = todo[who], ranks[who], True
            todo, ranks, slot = todo[~placed], ranks[~placed], (slot[~placed] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def joint(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens; ``_NONE`` where the joint bytes are no token."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], _NONE)
        more = np.flatnonzero((found != keys) & (found >= 0))
        while len(more):
            slot = (slot[more] if len(slot) == len(keys) else slot) + 1 & (len(self.keys) - 1)
            found = self.keys[slot]
            out[more] = np.where(found == keys[more], self.values[slot], _NONE)
            go = (found != keys[more]) & (found >= 0)
            more, slot = more[go], slot[go]
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match, entry by entry."""
        ranks, queue, n = self.ranks, RankQueue(self.size), len(piece)
        ends = list(range(1, n + 1))  # of the part that begins at a position
        before = list(range(-1, n - 1))
        pair = [-1] * n  # rank of the part at a position with the next one

        def pair_up(at: int) -> None:
            middle = ends[at]
            pair[at] = rank = ranks.get(piece[at : ends[middle]], -1) if middle < n else -1
            if rank >= 0:
                queue.push(rank, at)

        for i in range(n - 1):
            pair_up(i)
        while True:
            rank, at = queue.pop()
            if rank < 0:
                break
            if pair[at] != rank:
                continue  # stale: merged away, or a neighbour grew
            middle = ends[at]
            ends[at], pair[middle] = ends[middle], -1
            if ends[at] < n:
                before[ends[at]] = at
            pair_up(at)
            if before[at] >= 0:
                pair_up(before[at])
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : ends[at]]])
            at = ends[at]
        return ids

    def merge_all(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of many matches, a bucket at a time."""
        if not pieces:
            return []
        edges = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        n = int(edges[-1])
        token = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.arange(1, n + 1)
        after[edges[1:] - 1] = -1
        before = np.arange(-1, n - 1)
        before[edges[:-1]] = -1
        pair = np.full(n, _NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        pair[inner] = self.joint(token[inner], token[inner + 1])
        filled, buckets = Bitmap(self.size), {}

        def push(ranks: np.ndarray, at: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
                bucket = buckets.get(rank)
                if bucket is None:
                    buckets[rank] = [at[a:b]]
                    filled.add(rank)
                else:
                    bucket.append(at[a:b])

        ranked = inner[pair[inner] != _NONE]
        if len(ranked):
            push(pair[ranked], ranked)
        odd: list[np.ndarray] = []
        while (rank := filled.first()) >= 0:
            filled.remove(rank)
            bucket = buckets.pop(rank)
            at = bucket[0] if len(bucket) == 1 else _distinct(np.concatenate(bucket))
            at = at[pair[at] == rank]  # the others are stale
            if len(at) > 1:  # of neighbours that overlap, every second one
                touch = after[at[:-1]] == at[1:]
                if touch.any():
                    run = np.arange(len(at))
                    head = np.concatenate([[True], ~touch])
                    at = at[(run - run[head][np.cumsum(head) - 1]) % 2 == 0]
            if not len(at):
                continue
            middle = after[at]
            right = after[middle]
            some = right >= 0
            if len(at) > 1:
                beside = some[:-1] & (right[:-1] == at[1:])
                if beside.any():  # two merges in a row: is there a lower pair after the first?
                    between = at[:-1][beside]
                    lower = self.joint(np.full(len(between), rank), token[right[:-1][beside]]) < rank
                    if lower.any():
                        odd.append(between[lower])
            token[at] = rank
            after[at] = right
            before[right[some]] = at[some]
            pair[middle] = _NONE
            left = before[at]
            fresh = np.concatenate([at[some], left[left >= 0]])
            pair[at] = _NONE
            if not len(fresh):
                continue
            if len(at) > 1:
                fresh = _distinct(fresh)
            pair[fresh] = ranks = self.joint(token[fresh], token[after[fresh]])
            if (lower := ranks < rank).any():
                odd.append(fresh[lower])
            known = ranks != _NONE
            if known.any():
                push(ranks[known], fresh[known])
        heads = np.zeros(n, bool)
        heads[edges[:-1]] = True
        kept = np.flatnonzero((before >= 0) | heads)
        kept = kept[_reached(kept, before, after, heads)]
        cut = np.searchsorted(kept, edges)
        out = [token[kept[a:b]] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for i in np.unique(np.searchsorted(edges, np.concatenate(odd), side="right") - 1).tolist() if odd else ():
            out[i] = np.array(self.merge(pieces[i]), np.int32)
        return out

    def learn(self, memory: dict[str, bytes], chunks: Iterable[str], lead: str) -> None:
        """Remember the ids of chunks, each after ``lead``."""
        known = self.known
        chunks = list(chunks)
        matches = [[m.encode() for m in self.split(lead + c)] for c in chunks]
        todo = list({m for ms in matches for m in ms if m not in known})
        merged = [ids.tobytes() for ids in self.merge_all(todo)]
        known.update(zip(todo, merged))
        joined = [b"".join([known[m] for m in ms]) for ms in matches]
        memory.update(zip(chunks, joined))
        self.held += ENTRY * (len(todo) + len(chunks)) + sum(sum(map(getsizeof, x)) for x in (todo, merged, chunks, joined))

    def forget(self) -> None:
        self.held = 0
        self.first: dict[str, bytes] = {}  # ids of chunks at a text's begin
        self.spaced: dict[str, bytes] = {}  # and of chunks after a space, which is left out here
        self.known = {piece: i.to_bytes(4, "little") for piece, i in self.ranks.items()}

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, special tokens being ordinary text."""
        if self.held > MEMORY:
            self.forget()
        out: list[bytes] = []
        open_, heads, tails = [], set(), set()
        for text in texts:
            chunks = _chunks(text)
            found = list(map(self.spaced.get, chunks))
            found[0] = self.first.get(chunks[0])
            try:
                out.append(b"".join(found))
            except TypeError:  # some are new
                open_.append((len(out), chunks, found))
                out.append(b"")
                if found[0] is None:
                    heads.add(chunks[0])
                tails.update([c for c, ids in zip(chunks[1:], found[1:]) if ids is None])
        self.learn(self.first, heads, "")
        self.learn(self.spaced, tails, " ")
        for i, chunks, found in open_:
            found[0] = self.first[chunks[0]]
            out[i] = b"".join([self.spaced[c] if ids is None else ids for c, ids in zip(chunks, found)])
        return [np.frombuffer(ids, "<i4") for ids in out]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids) -> bytes:
        return b"".join(self.bytes_of[np.asarray(ids, np.int64)].tolist())

    def decimal(self, ids: np.ndarray) -> str:
        """Decimal ids joined by one space."""
        return " ".join(self.text_of[ids].tolist())


def _distinct(at: np.ndarray) -> np.ndarray:
    """Ascending, each once."""
    at = np.sort(at)
    first = np.ones(len(at), bool)
    np.not_equal(at[1:], at[:-1], out=first[1:])
    return at[first]


def _reached(kept, before, after, heads) -> np.ndarray:
    """Which of the positions are still parts: a head, or the successor of its predecessor."""
    return heads[kept] | (after[before[kept]] == kept)


def _chunks(text: str) -> list[str]:
    """The text's chunks; all but the first stand for themselves after a space."""
    parts = text.split(" ")
    if not _run(text):
        return parts
    chunks, held = [], parts[0]
    for part in parts[1:]:
        if held and not held[-1].isspace():
            chunks.append(held)
            held = part
        else:  # a run of spaces belongs to what follows it
            held += " " + part
    return [*chunks, held]


@lru_cache(4)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file: one base64 byte string and its rank a line."""
    lines = Path(path).read_bytes().splitlines()
    return Codec({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}, pattern)


def _encoded(own: Codec, texts: pa.Array) -> Iterator[np.ndarray]:
    _, offsets = terms.buffer_of(texts)
    for a, b in terms.slices(offsets, SLICE):
        yield from own.encode_all([t or "" for t in texts.slice(a, b - a).to_pylist()])


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Struct of n_tokens, ids_sha256 (decimal ids joined by spaces) and decoded_sha256 (bytes decoded from the ids)."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def coded(texts: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        counts, digests, decoded = [], [], []
        for ids in _encoded(own, texts):
            counts.append(len(ids))
            digests.append(sha256(own.decimal(ids).encode()).hexdigest())
            decoded.append(sha256(own.decode(ids)).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
            names=["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return coded(text)


def encode(text: Column, path: str, pattern: str) -> Column:
    """The ids themselves, as an array."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return pa.array(list(_encoded(codec(path, pattern), texts)), pa.list_(pa.int32()))

    return encoded(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of arrays of ids; null has none."""

    @F.arrow_udf("binary")
    def decoded(rows: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        return pa.array([own.decode(x.as_py() or []) for x in rows], pa.binary())

    return decoded(ids)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; written, so that the batches of texts are small."""
    with small_batches(docs.sparkSession):
        coded = docs.select("doc_id", round_trip(F.col("text"), path, pattern).alias("coded"))
        return written(coded.select("doc_id", "coded.*"), "byte-bpe")
