"""Sparse document-term matrix: words dictionary-encoded over the whole table, rows kept in CSR shards.

A word is a longest run of characters other than ASCII white space (``[^\\x20\\x09-\\x0D]+``),
case-sensitive.  The matrix is built in three steps.  Each task cuts its texts into shards of
about ``SHARD`` bytes and writes each with columns numbered by a dictionary of its own, whose
words are dealt into ``BUCKETS`` by their crc32.  The shards' words, not the texts, are then
brought together by bucket, where every word gets its number; a bucket's numbers follow those of
the buckets before it, so ids run from 0 without gaps.  Last, every shard meets the ids of its
words and is renumbered.

A shard holds ``docs`` (what the caller keeps of each row, in order), ``indptr`` (n + 1 numbers),
``indices`` (global word ids, ascending in each row) and ``counts``; the three are little-endian
64-bit arrays in zstandard frames, see ``unpack``.

Scale: what is shuffled by bucket is each shard's distinct words, many to a row, so a word that
stands in every text counts once a shard; what is shuffled by shard is bounded by its size.  The
numbering streams over sorted rows and holds the distinct words of one bucket.  ``buckets`` is
also the number of tasks that can share it; the driver gets one number for each.

Edge cases: null and empty texts, and texts of white space alone, are rows without a word; a
text longer than a shard is a shard of its own; repeated rows stay rows of their own; an empty
table gives no shard and no word.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from millrace.llm import terms
from millrace.llm.common import fresh_path

SHARD, BUCKETS = 4 << 20, 1024
Measure = Callable[[pa.Array], list[pa.Array]]
_ARRAYS = "indptr binary, indices binary, counts binary"


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<i8").tobytes())


def unpack(frame: bytes) -> np.ndarray:
    """One array of a shard."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), "<i8")


def encode(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, indptr, indices, counts) of some texts; indices are places in ``words``, ascending in each row."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    offsets = split.offsets.to_numpy()
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    shown = split.flatten()
    real = pc.not_equal(pc.binary_length(shown), 0)
    coded = shown.filter(real).dictionary_encode()
    width = max(1, len(coded.dictionary))
    cells, counts = np.unique(row[real.to_numpy(zero_copy_only=False)] * width + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    indptr = np.searchsorted(cells, np.arange(len(texts) + 1) * width)
    return coded.dictionary, indptr, cells % width, counts


def _local(docs: DataFrame, keep: list[Column], measure: Measure | None, fields: str, buckets: int) -> DataFrame:
    """Shards with columns numbered by their own ``words``: for each bucket in turn, its words with a blank between."""
    rows = docs.select(F.struct(*keep).alias("doc"), F.col("text").cast("string").alias("text"))
    kind = StructType([*rows.schema["doc"].dataType, *StructType.fromDDL(fields)] if fields else rows.schema["doc"].dataType.fields)

    def made(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, kept = batch["text"], batch["doc"]
            _, offsets = terms.buffer_of(texts)
            for a, b in terms.slices(offsets, SHARD):
                own = pa.StructArray.from_arrays([*kept.slice(a, b - a).flatten(), *(measure(texts.slice(a, b - a)) if measure else [])], kind.names)
                words, indptr, indices, counts = encode(texts.slice(a, b - a))
                words, indices, counts = _dealt(words.to_pylist(), indptr, indices, counts, buckets)
                gaps = np.diff(indices, prepend=0)  # small numbers take less room; whole again by a running sum
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), own), pa.array([words], pa.list_(pa.string())),
                        *(pa.array([pack(x)], pa.binary()) for x in (indptr, gaps, counts)),
                    ],
                    ["shard", "docs", "words", "indptr", "indices", "counts"],
                )
                number += 1

    return rows.mapInArrow(made, _schema(kind, "words array<string>"))


def _dealt(words: list[str], indptr: np.ndarray, indices: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of each bucket in turn, and the columns numbered in that order."""
    bucket = np.fromiter((crc32(w.encode()) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
    places = order.tolist()
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return [" ".join([words[i] for i in places[a:b]]) for a, b in zip(cuts, cuts[1:])], *_in_order(indptr, place[indices], counts)


def _in_order(indptr: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each row by ascending column."""
    width = int(columns.max(initial=0)) + 1
    order = np.argsort(np.repeat(np.arange(len(indptr) - 1) * width, np.diff(indptr)) + columns)
    return columns[order], counts[order]


def _schema(doc: StructType, more: str = "") -> StructType:
    rest = StructType.fromDDL(", ".join(filter(None, [more, _ARRAYS])))
    return StructType([StructField("shard", LongType()), StructField("docs", ArrayType(doc)), *rest])


def _numbered(local: DataFrame) -> DataFrame:
    """(of, bucket, numbers, first, fresh): the numbers of a shard's words in their bucket, and the words met for the first time, from number ``first`` on."""

    def made(batches):
        now, known = -1, {}
        for batch in batches:
            numbers, first, fresh = [], [], []
            for bucket, words in zip(batch["bucket"].to_pylist(), batch["words"].to_pylist()):
                if bucket != now:
                    now, known = bucket, {}
                n = len(known)
                numbers.append(np.array([known.setdefault(w, len(known)) for w in words.split(" ")], "<u4").tobytes())
                first.append(n)
                fresh.append(list(islice(known, n, None)))
            yield pa.RecordBatch.from_arrays(
                [batch["of"], batch["bucket"], pa.array(numbers, pa.binary()), pa.array(first, pa.int64()), pa.array(fresh, pa.list_(pa.string()))],
                ["of", "bucket", "numbers", "first", "fresh"],
            )

    rows = local.select(F.col("shard").alias("of"), F.posexplode("words").alias("bucket", "words")).where("words <> ''")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "of")
    return rows.mapInArrow(made, "of long, bucket int, numbers binary, first long, fresh array<string>")


def matrix(
    docs: DataFrame, *keep: Column, measure: Measure | None = None, fields: str = "", buckets: int = BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """(shards, dictionary) of the rows of ``docs`` (text); the dictionary is (word, word_id).

    ``keep`` names what a shard holds of each row besides its words; ``measure`` may add to
    that the columns ``fields``, one array each, from the texts at hand.
    """
    local = _compact(_local(docs, list(keep), measure, fields, buckets), "local-shards")
    numbered = _compact(_numbered(local), "numbered")
    sizes = dict(numbered.groupBy("bucket").agg(F.max(F.col("first") + F.size("fresh"))).collect())  # a number for each bucket
    before = list(accumulate((sizes.get(i, 0) for i in range(buckets)), initial=0))
    kind = local.schema["docs"].dataType.elementType

    def renumbered(shard: pa.Table, words: pa.Table) -> pa.Table:
        """One shard and the numbers of its words."""
        words = words.sort_by("bucket")
        ids = [np.frombuffer(x, "<u4").astype(np.int64) + before[i] for i, x in zip(words["bucket"].to_pylist(), words["numbers"].to_pylist())]
        indptr, gaps, counts = (unpack(shard[c][0].as_py()) for c in ("indptr", "indices", "counts"))
        columns = np.concatenate(ids)[np.cumsum(gaps)] if len(gaps) else gaps
        arrays = [shard["shard"], shard["docs"], shard["indptr"], *(pa.array([pack(x)], pa.binary()) for x in _in_order(indptr, columns, counts))]
        return pa.table(arrays, ["shard", "docs", "indptr", "indices", "counts"])

    met = numbered.select("of", "bucket", "numbers").groupBy("of")
    shards = local.drop("words").groupBy("shard").cogroup(met).applyInArrow(renumbered, _schema(kind))
    start = F.element_at(F.split(F.lit(",".join(map(str, before))), ","), F.col("bucket") + 1).cast("long")
    known = numbered.select("bucket", "first", F.posexplode("fresh").alias("at", "word"))
    return shards, known.select("word", (start + F.col("first") + F.col("at")).alias("word_id"))


def _compact(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_measures(shards: DataFrame) -> DataFrame:
    """What the shards hold of each row, with ``n_words`` (sum of the row) and ``n_distinct`` (its nonzero cells)."""
    kind = shards.schema["docs"].dataType.elementType

    def made(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                indptr, counts = unpack(batch["indptr"][i].as_py()), unpack(batch["counts"][i].as_py())
                total = np.concatenate([[0], np.cumsum(counts)])
                docs = batch["docs"].slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [*docs.flatten(), pa.array(total[indptr[1:]] - total[indptr[:-1]], pa.int64()), pa.array(np.diff(indptr), pa.int64())],
                    [*kind.names, "n_words", "n_distinct"],
                )

    return shards.mapInArrow(made, StructType([*kind.fields, *StructType.fromDDL("n_words long, n_distinct long")]))
