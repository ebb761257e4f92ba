"""Target-distribution importance resampling: draw the documents that look most like the target texts.

Features of a text are its runs of 1 to ``RUNS`` words (bytes other than ASCII marks, white space
and controls, A-Z lower-cased, one blank between), repeats counted, each put into one of
``BUCKETS`` by the crc32 of its bytes.  The gain of a bucket is the scaled logarithm of how much
more often it occurs in the target than in the corpus, with one added to each count; the weight
of a document is the sum over its features, taken from the array of gains.  A Gumbel number made
from the digest of the doc_id is added, so the documents of highest score are a sample drawn
without replacement in proportion to exp(weight).

Of a run's crc32 only the words' own are computed from bytes: the checksum of a concatenation is
the first part's, moved by the second's length, xor the second's, and the move is linear, so it
is four table look-ups for each length.

The cut is found by a weighted median of medians.  Each partition of the written keys names the
median of the keys that remain in it and their number; the driver takes the median of these
medians, weighted by the numbers.  At least about a quarter of all remaining keys lies on either
side of it, so whichever side cannot hold the cut goes, a guaranteed fraction a round, until
``LAST`` keys are left or the median is the cut itself.  One job a round counts the keys
above the last median and finds the medians of both sides.  Only winners are sorted.

Keys are (score descending, doc_id ascending, digest of the text); rows that agree in all three
are alike in every column and share the places in any order.

Scale: two passes over the texts and no shuffle of them; the driver gets ``BUCKETS`` counts, then
one key and two numbers a partition and round.  Winners get places within ranges, after
one number a range.

Edge cases: null texts have no word, weight 0; null doc_ids are hashed as the empty string and
come after all others of their score; documents of fewer than ``least_words`` words are scored
and never drawn; an empty target or corpus has counts 0; an empty table gives no row.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import terms
from millrace.llm.common import written

BUCKETS, RUNS, SEED = 10_000, 3, 42
LEAST_WORDS, PERCENT = 20, 5
LAST = 4096
_SHORT = 32
_U4 = np.uint32
_POLYNOMIAL = 0xEDB88320  # of crc32, fixed value


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=_U4)
    for _ in range(8):
        table = np.where(table & 1, (table >> _U4(1)) ^ _U4(_POLYNOMIAL), table >> _U4(1))
    return table


_table = _byte_table()


@lru_cache(4096)
def _move(n: int) -> np.ndarray:
    """Four tables of 256: what each byte of a checksum becomes when ``n`` more bytes follow."""
    if n == 0:
        return np.arange(256, dtype=_U4) << (_U4(8) * np.arange(4, dtype=_U4)[:, None])
    if n == 1:
        x = _move(0)
        return (x >> _U4(8)) ^ _table[x & _U4(255)]
    half = _move(n // 2)
    moved = _moved(half, _moved(half, _move(0)))
    return _moved(_move(1), moved) if n % 2 else moved


def _moved(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][(crc >> _U4(8)) & 255] ^ tables[2][(crc >> _U4(16)) & 255] ^ tables[3][crc >> _U4(24)]


def joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksums of left + right, where right is ``size`` bytes."""
    sizes, which = np.unique(size, return_inverse=True)
    if len(sizes) <= _SHORT * 4:
        tables = np.stack([_move(int(n)) for n in sizes]) if len(sizes) else np.zeros((1, 4, 256), _U4)
        moved = tables[which, 0, left & 255] ^ tables[which, 1, (left >> _U4(8)) & 255]
        return moved ^ tables[which, 2, (left >> _U4(16)) & 255] ^ tables[which, 3, left >> _U4(24)] ^ right
    out = np.empty(len(left), _U4)
    for i, n in enumerate(sizes.tolist()):
        at = np.flatnonzero(which == i)
        out[at] = _moved(_move(n), left[at]) ^ right[at]
    return out


_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_word = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, crc32, bytes) of every word of the rows, in text order."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _word[data]
    edge = inside[1:] != inside[:-1]
    cuts = np.concatenate([[0], np.flatnonzero(edge) + 1, offsets[1:-1], [len(data)]])
    cuts = np.unique(cuts)
    begin, end = cuts[:-1], cuts[1:]
    keep = inside[begin]
    begin, end = begin[keep], end[keep]
    size, low = end - begin, _lower[data]
    crc = np.full(len(begin), 0xFFFFFFFF, _U4)
    left = np.flatnonzero(size <= _SHORT)
    for i in range(_SHORT):
        left = left[size[left] > i]
        if not len(left):
            break
        now = crc[left]
        crc[left] = (now >> _U4(8)) ^ _table[(now ^ low[begin[left] + i]) & _U4(255)]
    crc ^= _U4(0xFFFFFFFF)
    for i in np.flatnonzero(size > _SHORT).tolist():
        crc[i] = crc32(low[begin[i] : end[i]])
    return np.searchsorted(offsets, begin, side="right") - 1, crc, size


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every feature of the rows, and the number of words of each row."""
    row, crc, size = words(data, offsets)
    rows, found, run = [row], [crc], crc
    spaced = joined(np.full(len(crc), crc32(b" "), _U4), crc, size)  # of a blank and the word
    for k in range(1, RUNS):
        if len(row) <= k:
            break
        run = joined(run[:-1], spaced[k:], size[k:] + 1)
        whole = row[k:] == row[:-k]
        rows.append(row[k:][whole])
        found.append(run[whole])
    return np.concatenate(rows), np.concatenate(found) % _U4(BUCKETS), np.bincount(row, minlength=len(offsets) - 1)


def _parts(texts: pa.Array):
    """(first row, row behind the last, features) of slices of a batch."""
    data, offsets = terms.buffer_of(texts)
    for a, b in terms.slices(offsets):
        yield a, b, buckets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def counts(docs: DataFrame) -> np.ndarray:
    """Features of all ``docs`` (text) in each bucket."""

    def made(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, (_, bucket, _) in _parts(batch["text"]):
                total += np.bincount(bucket, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total)], ["bucket", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(made, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the logarithm by which the target prefers each bucket."""
    s, t = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(((y + 1) * s) / ((x + 1) * t))) for x, y in zip(corpus.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Whole thousandths of a Gumbel number that follows from ``doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.ln(-F.ln(share)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and tie (a digest of the text) of every row of ``docs`` (doc_id, text)."""

    def made(batches):
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for a, b, (row, bucket, size) in _parts(batch["text"]):
                n_words[a:b], n_features[a:b] = size, np.bincount(row, minlength=b - a)
                total = np.concatenate([[0], np.cumsum(gain[bucket][np.argsort(row, kind="stable")])])
                weight[a:b] = np.diff(total[np.concatenate([[0], np.cumsum(n_features[a:b])])])
            arrays = [batch["doc_id"], batch["tie"], batch["noise"], *(pa.array(x) for x in (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "tie", "noise", "n_words", "n_features", "weight"])

    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(text).alias("tie"), gumbel(doc_id, seed).cast("long").alias("noise"), text.alias("text"))
    rows = rows.mapInArrow(made, "doc_id long, tie long, noise long, n_words long, n_features long, weight long")
    return rows.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + F.col("noise")).alias("score"), "tie")


#: A key by which smaller means drawn earlier.
_KEY = ("low", "gone", "id", "tie")


def _keys(rows: DataFrame) -> DataFrame:
    """The key of each row, as numbers that sort as the rows rank."""
    return rows.select((-F.col("score")).alias("low"), F.col("doc_id").isNull().cast("long").alias("gone"), F.coalesce("doc_id", F.lit(0)).alias("id"), "tie")


def _order(bound: tuple, op: str) -> Column:
    """Whether the key of a row is ``op`` (< or >) ``bound``."""
    out = F.lit(False)
    for name, value in reversed(list(zip(_KEY, bound))):
        beyond = F.col(name) < value if op == "<" else F.col(name) > value
        out = beyond | ((F.col(name) == value) & out)
    return out


def _medians(keys: DataFrame, pivot: tuple | None) -> list:
    """(side, n, median) of each partition: of its keys before ``pivot``, of those behind it, and how many equal it."""

    def made(batches):
        held = [np.stack([batch[c].to_numpy() for c in _KEY]) for batch in batches if batch.num_rows]
        if not held:
            return
        own = np.concatenate(held, axis=1)
        own = own[:, np.lexsort(own[::-1])]
        side = np.ones(own.shape[1], np.int64)
        if pivot is not None:
            side, open_ = np.zeros(own.shape[1], np.int64), np.ones(own.shape[1], bool)
            for values, value in zip(own, pivot):
                side[open_ & (values < value)], side[open_ & (values > value)] = -1, 1
                open_ &= values == value
        out = []
        for s in (-1, 0, 1):
            at = np.flatnonzero(side == s)
            if len(at):
                out.append((s, len(at), *own[:, at[(len(at) - 1) // 2]].tolist()))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["side", "n", *_KEY])

    return keys.mapInArrow(made, "side long, n long, " + ", ".join(f"{c} long" for c in _KEY)).collect()


def _weighted_median(found: list) -> tuple:
    """The median of the partitions' medians, each counted as often as its partition has keys."""
    ranked = sorted((tuple(r[2:]), r["n"]) for r in found)
    half = (sum(n for _, n in ranked) + 1) // 2
    for (key, _), upto in zip(ranked, accumulate(n for _, n in ranked)):
        if upto >= half:
            return key
    raise ValueError("no key")


def _between(keys: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
    """Keys strictly between two; the bounds of the first number alone reach the scan."""
    if low is not None:
        keys = keys.where(F.col(_KEY[0]) >= low[0]).where(_order(low, ">"))
    if high is not None:
        keys = keys.where(F.col(_KEY[0]) <= high[0]).where(_order(high, "<"))
    return keys


def cutoff(keys: DataFrame, rank: int) -> tuple | None:
    """The ``rank``-th key (from 1) of a written table of keys; None where there are fewer or ``rank`` is 0."""
    found, low, high = _medians(keys, None), None, None
    remaining = sum(r["n"] for r in found)
    if not 0 < rank <= remaining:
        return None
    while remaining > LAST:
        pivot = _weighted_median(found)
        sides = {s: [] for s in (-1, 0, 1)}
        for r in _medians(_between(keys, low, high), pivot):
            sides[r["side"]].append(r)
        before, same = (sum(r["n"] for r in sides[s]) for s in (-1, 0))
        if rank <= before:  # nothing from the median on can be the cut
            high, found, remaining = pivot, sides[-1], before
        elif rank <= before + same:
            return pivot
        else:  # nothing up to the median can
            low, found, remaining, rank = pivot, sides[1], remaining - before - same, rank - before - same
    return sorted(tuple(r) for r in _between(keys, low, high).collect())[rank - 1]


def draw(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` (as written from ``scored``) with their rank: 1, 2, 3 ... for the drawn, null for the others."""
    spark = rows.sparkSession
    able = rows.where(F.col("n_words") >= least_words)
    size = able.count() * percent // 100
    keys = written(_keys(able), "keys")
    cut = cutoff(keys, size)
    plain = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return rows.select(*plain, F.lit(None).cast("long").alias("rank"))
    keyed = rows.withColumns({"low": -F.col("score"), "gone": F.col("doc_id").isNull().cast("long"), "id": F.coalesce("doc_id", F.lit(0))})
    winner = (F.col("n_words") >= least_words) & ~_order(cut, ">")
    ordered = keyed.where(winner).orderBy(*_KEY)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    winners = written(ordered.select(*plain, F.spark_partition_id().alias("part"), place.alias("place")), "winners")
    sizes = sorted(winners.groupBy("part").agg(F.max("place") + 1).collect())  # one number a range
    before = spark.createDataFrame(list(zip([p for p, _ in sizes], accumulate([n for _, n in sizes], initial=0))), "part int, before long")
    rank = F.col("before") + F.col("place") + 1  # beyond the size stand rows equal to the last one drawn
    drawn = winners.join(before, "part").select(*plain, F.when(rank <= size, rank).alias("rank"))
    return drawn.unionByName(keyed.where(~winner).select(*plain, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs`` (doc_id, text), drawn towards the texts of ``target``."""
    gain = gains(counts(docs), counts(target))
    return draw(written(scored(docs, gain, seed), "scored"), percent, least_words)
