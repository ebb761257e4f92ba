"""SimHash fingerprints, and a search of all fingerprints within a Hamming radius.

The terms of a text are its words and its runs of two and three words; longer runs weigh
more (``WEIGHTS``), as they say more about a text than words every text has.  Each term's
hash votes on ``BITS`` signed bits with its weight; the sign of the sum is the bit.  A text
with fewer words has the shorter terms only; one without words has no vote: all bits 0.

Search: the bits are cut into ``BLOCKS`` blocks, with a table for each in which its bits come
first (a permutation).  With ``RADIUS`` = s * ``BLOCKS`` + a, fingerprints that differ in
``RADIUS`` bits at most differ in s bits at most in one of the first a + 1 blocks, or in s - 1
at most in one of the others: else they would differ in more than ``RADIUS``.  So a query asks
each table for its own prefix and for those with so many bits changed.  All within the radius
are found, and each pair counts in the first table it meets in.  Equal fingerprints are one
row of the index, with their number.  With the default a fingerprint is in four tables of
32-bit prefixes, and a query, one row in twenty, asks for 33 prefixes in three of them and one
in the last.

Edited texts: documents in descending order of doc_id (no id last; ties by the text's hash,
then the text) lie in ranges; each range is one task that goes through its documents once.
A range's last document needs the first of the next range: both ends are written with the
ranges' results and meet in a second, small step, two documents per range.

Edge cases: null counts as the empty text; an empty table gives no row; the only document is
its own next one; repeated rows have equal fingerprints.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import terms
from millrace.llm.common import written

BITS = 128
WEIGHTS = (0.25, 1.0, 1.0)
RADIUS, BLOCKS = 6, 4
_FOUND = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def simhash(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, BITS / 8) bytes: the fingerprints of the rows of a buffer."""
    n = len(offsets) - 1
    row, h, _ = terms.words(data, offsets)
    votes = np.zeros((n, BITS), np.float32)
    step = 1 << 15
    for k, weight in enumerate(WEIGHTS, 1):
        at, gram = (row, h) if k == 1 else terms.grams(row, h, k)
        if k > 1:  # texts of fewer words have no such term
            enough = np.bincount(row, minlength=n) >= k
            gram, at = gram[enough[at]], at[enough[at]]
        both = np.stack([gram, terms.mix(gram + np.uint64(0xA11CE))], 1)
        for a in range(0, len(at), step):
            bits = np.unpackbits(both[a : a + step].view(np.uint8), axis=1)
            own = at[a : a + step]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            count = np.diff(np.concatenate([first, [len(own)]]))
            ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
            votes[own[first]] += np.float32(weight) * (2 * ones - count[:, None]).astype(np.float32)
    return np.packbits(votes > 0, axis=1)


def fingerprint_texts(texts: list[str]) -> np.ndarray:
    data, offsets = terms.buffer_of(pa.array(texts, pa.large_string()))
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    for a, b in terms.slices(offsets):
        out[a:b] = simhash(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
    return out


def fingerprint(text: Column) -> Column:
    """Fingerprint of a whole text in lowercase hex."""

    @F.arrow_udf("string")
    def printed(texts: pa.Array) -> pa.Array:
        data, offsets = terms.buffer_of(texts)
        out: list[str] = []
        for a, b in terms.slices(offsets):
            out += [p.tobytes().hex() for p in simhash(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])]
        return pa.array(out, pa.string())

    return printed(text)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1 - np.unpackbits(a ^ b, axis=1).sum(1) / BITS


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the beginning of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compared(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    changed = [edited(a, b) for a, b in zip(texts, following)]
    own, new, after = fingerprint_texts(texts), fingerprint_texts(changed), fingerprint_texts(following[-1:])
    after = np.concatenate([own[1:], after]) if len(own) else own
    return [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([p.tobytes().hex() for p in own], pa.string()), pa.array([p.tobytes().hex() for p in new], pa.string()),
        pa.array(likeness(own, new)), pa.array(likeness(own, after)),
    ]


def edit_and_compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text), of its edited text, and their likeness to it and to the next row."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc(), F.col("text").desc()]
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("doc_id", "text")
    names = [x.split()[0] for x in _FOUND.split(", ")] + ["part", "head", "tail"]

    def pairs(batches):
        part, held, head, last = TaskContext.get().partitionId(), ([], []), None, None

        def flush(ids, texts, following):
            n = len(ids)
            return pa.RecordBatch.from_arrays([*_compared(ids, texts, following), pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names)

        for batch in batches:
            _, offsets = terms.buffer_of(batch["text"])
            for a, b in terms.slices(offsets, 4 << 20):
                piece = batch.slice(a, b - a)
                ids, texts = held[0] + piece["doc_id"].to_pylist(), held[1] + piece["text"].to_pylist()
                if head is None and texts:
                    head = texts[0]
                held = (ids[-1:], texts[-1:])
                if len(ids) > 1:
                    yield flush(ids[:-1], texts[:-1], texts[1:])
        if head is not None:  # both ends of the range; the last row's own result follows later
            ids, last = held
            none = [pa.nulls(1, pa.field(x, pa.int64() if x == "n_chars" else pa.float64() if x.startswith("near") else pa.string()).type) for x in names[1:7]]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *none, pa.array([part], pa.int32()), pa.array([head]), pa.array(last)], names)

    made = written(rows.mapInArrow(pairs, f"{_FOUND}, part int, head string, tail string"), "edited")
    ends = made.where(F.col("tail").isNotNull())
    parts = sorted(r["part"] for r in ends.select("part").collect())  # one number per range
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    heads = ends.select(F.col("part").alias("next"), F.col("head").alias("following"))
    met = ends.select("doc_id", "part", "tail").join(following, "part").join(heads, "next").select("doc_id", "tail", "following")

    def close(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(_compared(*(one[c].to_pylist() for c in ("doc_id", "tail", "following"))), names[:7])

    return made.where(F.col("tail").isNull()).select(*names[:7]).unionByName(met.mapInArrow(close, _FOUND))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fingerprint, distance) of all fingerprints within ``radius`` of each query's one.

    ``prints`` and ``queries`` have a column ``fingerprint`` (hex); each distinct value is one
    row here, so copies cost nothing.
    """
    width = BITS // blocks
    if width * blocks != BITS or 64 % width or width > 32:
        raise ValueError("blocks must cut the bits into equal parts of 32 bits at most")
    deep, more = divmod(radius, blocks)
    changes = [deep if b <= more else deep - 1 for b in range(blocks)]  # bits that may differ in a block; -1: its table is not needed

    def block(words: list[Column], b: int) -> Column:
        at = b * width
        return F.shiftrightunsigned(words[at // 64], 64 - width - at % 64).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    def halves(name: str) -> list[Column]:
        return [(F.shiftleft(F.conv(F.substring(name, i, 8), 16, 10).cast("long"), 32).bitwiseOR(F.conv(F.substring(name, i + 8, 8), 16, 10).cast("long"))) for i in (1, 17)]

    def split(df: DataFrame, name: str) -> DataFrame:
        high, low = halves("fingerprint")
        return df.select("fingerprint").distinct().select(high.alias(f"{name}_high"), low.alias(f"{name}_low"))

    def own(name: str) -> list[Column]:
        return [F.col(f"{name}_high"), F.col(f"{name}_low")]

    def table(b: int, value: Column) -> Column:
        return value.bitwiseOR(F.lit(b << width).cast("long"))

    used = [b for b in range(blocks) if changes[b] >= 0]
    masks = [sum(1 << i for i in bits) for n in range(deep + 1) for bits in combinations(range(width), n)]
    shallow = sum(comb(width, n) for n in range(deep))

    def near(b: int) -> Column:
        some = masks[:shallow] if changes[b] < deep else masks
        return F.transform(F.array(*[F.lit(m).cast("long") for m in some]), lambda m: table(b, block(own("query"), b).bitwiseXOR(m)))

    asked = F.concat(*[near(b) for b in used])
    left = split(queries, "query").select("*", F.explode(asked).alias("prefix"))
    right = split(prints, "print").select("*", F.explode(F.array(*[table(b, block(own("print"), b)) for b in used])).alias("prefix"))
    differ = [q.bitwiseXOR(p) for q, p in zip(own("query"), own("print"))]
    distance = F.bit_count(differ[0]) + F.bit_count(differ[1])
    first = F.lit(-1)
    for b in reversed(used):
        first = F.when(F.bit_count(block(differ, b)) <= changes[b], b).otherwise(first)
    once = F.shiftright("prefix", width) == first
    met = left.hint("merge").join(right, "prefix").where((distance <= radius) & once)  # queries grow with the corpus: never broadcast

    def hexed(name: str) -> Column:
        return F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in own(name)]))

    return met.select(hexed("query").alias("query"), hexed("print").alias("fingerprint"), distance.alias("distance"))


def search(found: DataFrame) -> DataFrame:
    """``found`` with ``n_near``: for every row whose doc_id 20 divides, the rows within the radius of it, itself included."""
    asked = F.col("doc_id") % 20 == 0
    near = within_radius(found, found.where(asked))
    sizes = found.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    counts = written(near.join(sizes, "fingerprint").groupBy("query").agg(F.sum("copies").alias("n_near")), "near")
    counts = counts.withColumnRenamed("query", "fingerprint").withColumn("asked", F.lit(True))
    return found.withColumn("asked", F.coalesce(asked, F.lit(False))).join(counts, ["fingerprint", "asked"], "left").select(*found.columns, "n_near")
