"""Near-duplicates by Order MinHash, verified by banded alignment of words.

Two texts are linked if an alignment keeps at least ``SIMILARITY`` of the words of the longer
one, in order: one minus the share of edits.  Candidates come from ``SHINGLE``-word shingles (a
text with fewer words is one shingle), each labelled with how often it occurred before, so all
of a text are different.  A sketch is the ``PICKED`` labelled shingles with the smallest hashes,
in text order; there are ``SKETCHES`` of them, from independent hashes.  Texts with an equal
sketch share a bucket.  A changed word costs three shingles of three words; scattered changes of
one word in fifteen, and passages put in or left out up to the limit of ``SIMILARITY``, leave at
least ``OVERLAP`` of the longer text's shingles.

Short texts (at most ``SHORT`` shingles) that share so many are found exactly: of two such texts
of n and m shingles each shows one of the common ones among its first n - ceil(``OVERLAP`` * n) + 1
in any one order of all shingles.  Those are the buckets of every text that can be like one of at
most ``SHORT`` shingles.  The order puts shingles last that a bounded sample of texts shows often;
it decides the cost alone, not what is found.

Texts of more shingles meet by sketches.  With c shingles common of u in all, one agrees with a
chance of about (c / u) ** ``PICKED``: of 48, all miss a pair that keeps 95 % of its words under
scattered changes with 0.00001, 92 % with 0.5 %, 90 % with 5 %, 85 % with 44 %; a pair with 20 %
of the words put in or left out in one passage with less than 0.00001.

Classes are the connected groups of links.  Members of a bucket are compared with one of them,
the smallest: each text first with the smallest it meets in all its buckets, which leaves thousands
of similar texts with one class, and after these links are contracted with the others that are
still in another class.  Texts of buckets that still hold several classes then meet again, each once and not
once a bucket, by the prefixes of the exact search, over all their shingles and whatever their
length, in the order of a sample of these very texts: so a passage that very many of them share
comes last, and what they meet by is their own.  Pairs of different classes in groups of up to
``BLOCK`` are compared; larger groups that still hold several classes after that are settled
block against block.  So no link with the stated overlap that a bucket offers is lost.

Scale: exact copies are one node from the start; sketches are made where texts are read;
buckets, representatives and classes come from minima that combine before the shuffle.  Texts
move once per compared pair.  Intermediate tables are written to the shared folder.

Edge cases: null counts as the empty text; texts without words are alike only if equal; null
doc_ids take part, a class with no id at all has class_id null; repeated rows are copies; an
empty table gives no row.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import terms
from millrace.llm.common import bounded_sample, small_batches, written

SHINGLE, SIMILARITY, OVERLAP = 3, 0.8, 0.8
SKETCHES, PICKED = 48, 5
SHORT = 60
SAMPLE, OFTEN = 20_000, 1 << 16
_SEEDS = terms.mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)
BLOCK = 64
_CELLS, _KNOWN = 1 << 18, 1 << 20


def key_of(text: str = "text") -> Column:
    """The node of a text: 128 bits of its digest."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), 1, 32))


def labelled(grams: np.ndarray) -> np.ndarray:
    """Each hash joined with the number of equal ones before it."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.arange(len(grams))
    times = np.empty(len(grams), np.uint64)
    times[order] = at - at[new][np.cumsum(new) - 1]
    return terms.mix(grams + times * _ODD)


def words(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words of each row of a buffer, in text order."""
    row, h, _ = terms.words(data, offsets)
    return np.split(h, np.searchsorted(row, np.arange(1, len(offsets) - 1))) if len(offsets) > 1 else []


def shingles_of(own: np.ndarray) -> np.ndarray:
    """Labelled shingles of a sequence of words, in text order."""
    return labelled(terms.grams(np.zeros(len(own), np.int64), own, SHINGLE)[1]) if len(own) else own


def shingles(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Labelled shingles of each row of a buffer, in text order."""
    return [shingles_of(own) for own in words(data, offsets)]


def sketches(own: np.ndarray) -> np.ndarray:
    """One number per sketch of a sequence of labelled shingles."""
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, _CELLS // len(own))
    for a in range(0, SKETCHES, step):
        seeds = _SEEDS[a : a + step, None]
        if len(own) <= PICKED:
            at = np.broadcast_to(np.arange(len(own)), (len(seeds), len(own)))
        else:
            values = (own[None] ^ seeds) * _ODD
            values ^= values >> np.uint64(29)
            values *= _ODD
            at = np.sort(np.argpartition(values, PICKED - 1, axis=1)[:, :PICKED], axis=1)
        total = seeds[:, 0].copy()
        for i in range(at.shape[1]):
            total = terms.mix(total * _ODD + own[at[:, i]])
        out[a : a + step] = total
    return out


def rarest(own: np.ndarray, often: np.ndarray, times: np.ndarray) -> np.ndarray:
    """A number for each labelled shingle of which similar texts share at least one; ``often`` (sorted), shown ``times``, come last."""
    n = len(own)
    first = n - ceil(OVERLAP * n - 1e-6) + 1
    rank = np.zeros(n, np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, own), len(often) - 1)
        rank = np.where(often[at] == own, times[at], 0)
    return terms.mix(own[np.lexsort((own, rank))[:first]] + _ODD)


def _often(texts: DataFrame, longest: float = float("inf")) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a bounded sample of texts shows more than twice, and how often; a bounded number of them."""

    def made(batches):
        for batch in batches:
            data, offsets = terms.buffer_of(batch["text"])
            for a, b in terms.slices(offsets):
                own = [x for x in shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) if len(x) <= longest]
                if own:  # counted here, so a shingle that all texts share is one row a slice
                    grams, times = np.unique(np.concatenate(own).view(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(times)], ["gram", "n"])

    sample = bounded_sample(texts.select(F.coalesce("text", F.lit("")).alias("text")), SAMPLE, F.col("text"))
    shown = sample.mapInArrow(made, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("count")).where("count > 2")
    rows = shown.orderBy(F.desc("count"), "gram").limit(OFTEN).collect()
    grams, times = np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64)
    order = np.argsort(grams)
    return grams[order], times[order]


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Words of the longest common sequence that pairs no places further apart than ``band``.

    One row of the alignment is one number of len(a) bits, in which a zero marks a step up;
    a row is made from the one before by an addition.
    """
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    every = steps = (1 << len(a)) - 1
    window = (1 << (2 * band + 1)) - 1
    for j, y in enumerate(b.tolist()):
        met = places.get(y)
        if met is not None:
            met &= steps & (window << (j - band) if j > band else window >> (band - j))
            steps = ((steps + met) | (steps - met)) & every
    return len(a) - steps.bit_count()


def alike(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether an alignment of two sequences of words keeps ``least`` of the longer one."""
    if len(a) > len(b):
        a, b = b, a
    need = ceil(least * len(b) - 1e-6)
    if not len(a) or len(a) < need:
        return False
    for _ in range(2):  # equal beginnings, then equal ends
        same = a == b[: len(a)]
        k = len(a) if same.all() else int(np.argmin(same))
        a, b, need = a[k:][::-1], b[k:][::-1], need - k
    if need <= 0:
        return True
    if len(a) < need:
        return False
    _, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    size = int(which.max()) + 1
    if np.minimum(np.bincount(which[: len(a)], minlength=size), np.bincount(which[len(a) :], minlength=size)).sum() < need:
        return False
    return aligned(a, b, len(b) - need) >= need


def close_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs that hold enough common shingles, in whatever order."""
    both = left + right
    if not left or not right:
        return []
    sizes = np.array([len(x) for x in both])
    doc = np.repeat(np.arange(len(both)), sizes)
    _, slot, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1  # those in one text alone cannot be common
    keep = times[slot] > 1
    doc, slot = doc[keep], shared[slot[keep]]
    common = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, int(shared[-1]) + 1, 1 << 15):
        here = (slot >= a) & (slot < a + (1 << 15))
        has = np.zeros((len(both), 1 << 15), np.float32)
        has[doc[here], slot[here] - a] = 1
        common += has[: len(left)] @ has[len(left) :].T
    longer = np.maximum(sizes[: len(left), None], sizes[None, len(left) :])
    return list(zip(*(x.tolist() for x in np.nonzero(common >= OVERLAP * longer - 1e-3))))


def _like_sizes(a: str, b: str) -> Column:
    """Whether texts of so many words can be similar."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b) - 1e-6


def _buckets(texts: DataFrame, often: np.ndarray, times: np.ndarray, everything: bool) -> DataFrame:
    """(key, bucket, size) of ``texts`` (key, text): prefixes and sketches, or with ``everything`` prefixes whatever the length."""

    def made(batches):
        for batch in batches:
            first = {}
            for i, key in enumerate(batch["key"].to_pylist()):
                first.setdefault(key, i)
            batch = batch.take(pa.array(list(first.values()), pa.int64()))
            data, offsets = terms.buffer_of(batch["text"])
            for a, b in terms.slices(offsets):
                rows, numbers, sizes = [], [], []
                for i, told in enumerate(words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), a):
                    own = shingles_of(told)
                    short = len(own) * OVERLAP <= SHORT
                    own_numbers = [rarest(own, often, times)] if len(own) and (short or everything) else []
                    if len(own) > SHORT and not everything:
                        own_numbers.append(sketches(own))
                    for some in own_numbers:
                        rows += [i] * len(some)
                        sizes += [len(told)] * len(some)
                        numbers.append(some)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch["key"].take(pa.array(rows)), pa.array(np.concatenate(numbers).view(np.int64)), pa.array(sizes, pa.int64())],
                        ["key", "bucket", "size"],
                    )

    return texts.mapInArrow(made, "key binary, bucket long, size long")


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (key, other) whose texts are similar."""
    own = texts.select("key", "text")
    theirs = texts.select(F.col("key").alias("other"), F.col("text").alias("other_text"))

    def compared(batches):
        known: dict[bytes, np.ndarray] = {}
        held = 0
        for batch in batches:
            keys, others = batch["key"].to_pylist(), batch["other"].to_pylist()
            for i in range(batch.num_rows):
                sides = []
                for key, column in ((keys[i], "text"), (others[i], "other_text")):
                    if key not in known:
                        if held > _KNOWN:
                            known, held = {}, 0
                        known[key] = words(*terms.buffer_of(batch[column].slice(i, 1)))[0]
                        held += len(known[key])
                    sides.append(known[key])
                if alike(*sides):
                    yield pa.RecordBatch.from_arrays([batch["key"].slice(i, 1), batch["other"].slice(i, 1)], ["key", "other"])

    return pairs.join(own, "key").join(theirs, "other").select("key", "other", "text", "other_text").mapInArrow(compared, "key binary, other binary")


def components(links: DataFrame) -> DataFrame:
    """(key, root) of all keys in ``links`` (key, other); the root is the smallest key of the group.

    Each round takes the smallest root among a key and its neighbours, then that one's own
    root, so the number of rounds grows with the logarithm of a group's extent.
    """
    both = written(links.unionByName(links.select(F.col("other").alias("key"), F.col("key").alias("other"))).distinct(), "links")
    roots = written(both.groupBy("key").agg(F.min(F.least("key", "other")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("key").alias("other"), "root"), "other").select("key", "root", F.lit(None).cast("binary").alias("was"))
        lower = near.unionByName(roots.withColumn("was", F.col("root"))).groupBy("key").agg(F.min("root").alias("root"), F.max("was").alias("was"))
        above = roots.select(F.col("key").alias("root"), F.col("root").alias("above"))
        after = written(lower.join(above, "root", "left").select("key", F.least("root", "above").alias("root"), "was"), "roots")
        if after.where(F.col("root") != F.col("was")).isEmpty():
            return after.select("key", "root")
        roots = after.select("key", "root")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after new links: the groups' roots are linked, then every key follows its root."""
    of = roots.select("key", "root")
    ends = links.join(of, "key", "left").select(F.coalesce("root", "key").alias("key"), "other")
    ends = ends.join(of.withColumnRenamed("key", "other"), "other", "left").select("key", F.coalesce("root", "other").alias("other"))
    joined = components(ends.where(F.col("key") != F.col("other")).distinct())
    moved = joined.select(F.col("key").alias("root"), F.col("root").alias("to"))
    followed = roots.join(moved, "root", "left").select("key", F.coalesce("to", "root").alias("root"))
    return written(followed.unionByName(joined.join(roots.select("key"), "key", "left_anti")), "roots")


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (bucket, key, size, root) of buckets with more than one class."""
    rooted = members.join(roots, "key", "left").select("bucket", "key", "size", F.coalesce("root", "key").alias("root"))
    ends = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rooted.join(ends.where("low < high").select("bucket"), "bucket", "left_semi")


def _settled(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the classes that ``members`` (bucket, key, size, root) of open buckets still fall into.

    In each bucket all members outside its largest class are compared with all members of
    other classes than their own: both are dealt into blocks of ``BLOCK``, and each pair of
    blocks is one small group, which stops comparing two classes once they are linked.  No
    pair becomes a row.
    """
    held = members.groupBy("bucket", "root").count()
    tops = held.groupBy("bucket").agg(F.max_by("root", F.struct("count", "root")).alias("top"), F.sum("count").alias("all"), F.max("count").alias("most"))
    blocks = tops.select("bucket", "top", F.ceil(F.col("all") / BLOCK).alias("wide"), F.ceil((F.col("all") - F.col("most")) / BLOCK).alias("high"))
    dealt = members.join(blocks, "bucket").withColumn("spot", F.xxhash64("key", "bucket"))
    wide, high = F.pmod("spot", "wide"), F.pmod(F.xxhash64("spot"), "high")
    every = dealt.select("bucket", "key", "root", F.lit(False).alias("asks"), wide.alias("w"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("high") - 1)).alias("h"))
    asking = dealt.where("root != top").select("bucket", "key", "root", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("wide") - 1)).alias("w"), high.alias("h"))

    def compared(table: pa.Table) -> pa.Table:
        told = words(*terms.buffer_of(table["text"]))
        own, keys, roots = [shingles_of(x) for x in told], table["key"].to_pylist(), table["root"].to_pylist()
        asks = table["asks"].to_pylist()
        top = {r: r for r in roots}

        def find(r: bytes) -> bytes:
            while top[r] != r:
                r = top[r]
            return r

        left = [i for i, x in enumerate(asks) if x]
        right = [i for i, x in enumerate(asks) if not x]
        found = []
        for i, j in close_pairs([own[i] for i in left], [own[j] for j in right]):
            i, j = left[i], right[j]
            if find(roots[i]) != find(roots[j]) and alike(told[i], told[j]):
                top[find(roots[i])] = find(roots[j])
                found.append((keys[i], keys[j]))
        return pa.table([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["key", "other"])

    shown = every.unionByName(asking).join(texts, "key")
    return shown.groupBy("bucket", "w", "h").applyInArrow(compared, "key binary, other binary").distinct()


def _ordered_pairs(met: DataFrame) -> DataFrame:
    return met.select(F.greatest("key", "other").alias("key"), F.least("key", "other").alias("other")).distinct()


def _met_again(members: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """``roots`` after all links between texts of open buckets, which meet by their own rarest shingles."""
    open_ = written(_open(members, roots).select("key").distinct(), "open")
    left = written(texts.join(open_.hint("merge"), "key", "left_semi"), "texts")
    prefixes = written(_buckets(left, *_often(left), True), "prefixes")
    again = written(_open(prefixes, roots), "members")
    sizes = again.groupBy("bucket").agg(F.count("*").alias("n"))
    few = again.join(sizes.where(F.col("n") <= BLOCK).select("bucket"), "bucket", "left_semi")
    other = few.select("bucket", *[F.col(c).alias(o) for c, o in (("key", "other"), ("size", "other_size"), ("root", "other_root"))])
    met = few.join(other, "bucket").where((F.col("root") < F.col("other_root")) & _like_sizes("size", "other_size"))
    links = written(_linked(written(_ordered_pairs(met), "pairs"), left), "links")
    if not links.isEmpty():
        roots = _merged(roots, links)
    many = again.join(sizes.where(F.col("n") > BLOCK).select("bucket"), "bucket", "left_semi").select("bucket", "key", "size")
    rest = written(_settled(_open(many, roots), left), "links")
    return roots if rest.isEmpty() else _merged(roots, rest)


def _apart(pairs: DataFrame, seen: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` of different classes that were not compared yet."""
    left = roots.select("key", F.col("root").alias("_own"))
    right = roots.select(F.col("key").alias("other"), F.col("root").alias("_theirs"))
    rest = pairs.join(left, "key", "left").join(right, "other", "left").where(F.coalesce("_own", "key") != F.coalesce("_theirs", "other"))
    met = seen.withColumnRenamed("other", "_seen")
    return rest.join(met, "key").where(F.col("other") != F.col("_seen")).select("key", "other")


def classes(docs: DataFrame) -> DataFrame:
    """(key, root) of every text that is linked with a different one."""
    with small_batches(docs.sparkSession):
        return _classes(docs)


def _classes(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(key_of().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    sketched = written(_buckets(rows, *_often(docs, SHORT / OVERLAP), False), "sketches")
    shared = sketched.groupBy("bucket").agg(F.min("key").alias("other"), F.max("key").alias("high")).where("other < high")
    members = written(sketched.join(shared.select("bucket", "other"), "bucket").distinct(), "members")
    wanted = members.select("key").distinct()
    texts = rows.join(wanted.hint("merge"), "key", "left_semi")  # grows with the corpus: never broadcast
    texts = written(texts.groupBy("key").agg(F.first("text").alias("text")), "texts")
    pairs = written(_ordered_pairs(members.where(F.col("key") != F.col("other"))), "pairs")
    first = pairs.groupBy("key").agg(F.min("other").alias("other"))
    links = written(_linked(first, texts), "links")
    roots = spark.createDataFrame([], "key binary, root binary") if links.isEmpty() else components(links)
    links = written(_linked(written(_apart(pairs, first, roots), "pairs"), texts), "links")
    if not links.isEmpty():
        roots = _merged(roots, links)
    return _met_again(members.drop("other"), roots, texts)


def group(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class) and class_size of every row of ``docs`` (doc_id, text)."""
    placed = _placed(docs)
    sizes = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return placed.join(sizes, "root").select("doc_id", "class_id", "class_size")


def _placed(docs: DataFrame) -> DataFrame:
    roots = classes(docs)
    rows = docs.select("doc_id", key_of().alias("key"))
    return written(rows.join(roots, "key", "left").select("doc_id", "key", F.coalesce("root", "key").alias("root")), "placed")


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, one of each class: that of the smallest doc_id (no id last), then of the smallest text digest."""
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    kept = written(_placed(docs).groupBy("root").agg(F.min(first).alias("first")).select("first.doc_id", "first.key"), "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id"), key_of().alias("key"))
    same = rows.alias("r").join(kept.alias("k").hint("merge"), (F.col("r.key") == F.col("k.key")) & F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi")
    return same.dropDuplicates(["key"]).select("row.*")
