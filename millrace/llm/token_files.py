"""Token ids in binary shards, compressed per document with a shared zstandard dictionary.

Each document's ids, followed by an end id, are serialised little-endian with the fewest
bytes the vocabulary allows and compressed alone, with a dictionary trained on a bounded
sample of such arrays.  A shard image holds, in ascending doc_id order: a header (magic,
version, bytes per id, number of documents), the SHA-256 of the dictionary, doc_ids with
their null marks, ids per document, offsets of the frames, the frames.  Any document can be
read by its offset alone.  Images are kept in Parquet cells, so that Spark's committer makes
writing atomic and any store will do; the dictionary is a one-row table beside them.

Scale: texts are encoded where they are read; only compressed frames are shuffled, by ranges
of (doc_id, hash), so a repeated doc_id spreads over tasks.  Shards hold about ``BLOCK``
bytes.  Places in the whole (``start``) are sums of shard totals: within a range by a window
over its shards, across ranges by one number per range.

A text is encoded by chunks between spaces and newlines: the tokenizer cuts at white space
and drops it, so a chunk's ids do not depend on its surroundings; chunks are remembered per
worker up to about ``MEMORY`` bytes, and each different chunk of about ``SLICE`` bytes of text
is looked up once.  As it lower-cases, Latin-1 texts are looked up in lower case; as it cuts
between letters, digits and marks, a word and the stop or comma after it are two chunks there,
a new Latin-1 chunk is put together from its pieces, and only new pieces go to the tokenizer.  Neither is done where a special token
could be meant.  These facts are read from the tokenizer's file; under other settings whole
texts go to the tokenizer as they are.

Edge cases: null and empty texts are the end id alone; null doc_ids come last and stay null;
rows that repeat stay, ordered by hash and content; too few samples for a dictionary give
an empty one (plain frames); an empty table gives no shard.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm import terms
from millrace.llm.common import bounded_sample, fresh_path, written

MAGIC, VERSION = b"TOKS", 1
BLOCK = 1 << 20
MEMORY, ENTRY = 160 << 20, 250  # bytes of remembered chunks in a worker, and of one beside its characters
SLICE = 1 << 22  # bytes of text encoded at once
SAMPLE_ROWS, SAMPLE_BYTES, SLICES, DICTIONARY = 2_000, 1 << 14, 8, 1 << 16
_HEAD = struct.Struct("<4sHHI32s")


#: Settings of a tokenizer file under which chunks can be encoded apart.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_chunks(settings: dict) -> bool:
    """Whether a tokenizer (its file, parsed) drops white space, lower-cases, cuts letters from marks and marks special tokens with ``<|``."""
    normal, cut = settings.get("normalizer") or {}, (settings.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split = cut[0] if cut else {}
    return (
        normal.get("normalizers") == _NORMAL
        and [c["type"] for c in cut] == ["Split", "ByteLevel"]
        and split.get("pattern") == {"Regex": _CUT} and split.get("behavior") == "Removed" and split.get("invert") is True
        and not cut[1].get("add_prefix_space") and not cut[1].get("use_regex")
        and all(t["content"].startswith("<|") and " " not in t["content"] and not t["lstrip"] and not t["rstrip"] for t in settings.get("added_tokens", []))
    )


# ``_CUT`` for lower-case Latin-1: its letters, numbers and white space by name.
_L, _N = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_pieces = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\x20\t-\r\x85\xa0{_L}{_N}]+").findall


# The characters that stand for bytes in a byte-level vocabulary.
_shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _shown)}


def _byte_level(piece: str) -> str:
    return piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(_BYTES)


def _plain(text: str) -> bool:
    """Whether a text is Latin-1 and no special token could be meant."""
    if "<|" in text:
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


# A single stop or comma that ends a word: a piece of its own, so a space before it changes no id.
_ends = re.compile(r"[.,](?<=[a-z0-9].)(?= )").sub


def _spaced(text: str) -> str:
    """With spaces between chunks; in lower case and words apart from the mark at their end, where that cannot change the ids."""
    flat = text.replace("\n", " ")
    return _ends(r" \g<0>", flat.lower()) if _plain(text) else flat


class Encoder:
    """Ids of whole texts by a tokenizers file; by remembered chunks where its settings allow that."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.apart = by_chunks(json.loads(Path(path).read_text(encoding="utf-8")))
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.memory: dict[str, bytes] = {}
        self.held = 0

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Serialised ids of each text."""
        if not self.apart:
            return [array(self.kind, x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if self.held > MEMORY:
            self.memory, self.held = {}, 0
        folded = pa.array([_spaced(text) for text in texts], pa.large_string())
        chunks = pc.split_pattern(folded, " ")
        told = chunks.flatten().dictionary_encode()  # each different chunk of these texts is looked up once
        known = self._chunks(told.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(known, pa.large_binary()).take(told.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[chunks.offsets.to_numpy()]
        data = ids.buffers()[2].to_pybytes()
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Serialised ids of different chunks."""
        memory = self.memory
        fresh = [c for c in chunks if c not in memory]
        cut = {c: [c] if c.isascii() and c.isalpha() and c.islower() else _pieces(c.lower()) for c in fresh if _plain(c)}
        odd = [c for c in fresh if c not in cut]
        for chunk, ids in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            memory[chunk] = array(self.kind, ids.ids).tobytes()
        tokenize, new = self.tokenizer.model.tokenize, set(chain.from_iterable(cut.values())).difference(memory)
        for piece in new:  # nothing is left to normalise or cut: the model alone
            memory[piece] = array(self.kind, [t.id for t in tokenize(_byte_level(piece))]).tobytes()
        memory.update([(c, b"".join([memory[x] for x in parts])) for c, parts in cut.items() if c not in new])
        out = [memory[c] for c in chunks]
        long = [c for c, parts in cut.items() if len(parts) > 2 and c not in new]  # these seldom come again
        for c in long:
            del memory[c]
        kept = new.union(fresh).difference(long)
        self.held += ENTRY * len(kept) + sum(map(len, kept))
        return out


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _serialised(texts: pa.Array, path: str, end: int):
    own = _encoder(path)
    last = array(own.kind, [end]).tobytes()
    _, offsets = terms.buffer_of(texts)
    for a, b in terms.slices(offsets, SLICE):
        for ids in own.encode_all([t or "" for t in texts.slice(a, b - a).to_pylist()]):
            yield ids + last


def spread(ids: bytes, width: int) -> bytes:
    """At most ``SAMPLE_BYTES`` of an array: ``SLICES`` slices from its beginning to its end."""
    size = SAMPLE_BYTES // SLICES
    if len(ids) <= SAMPLE_BYTES:
        return ids
    last = (len(ids) - size) // width
    return b"".join(ids[at : at + size] for at in (last * i // (SLICES - 1) * width for i in range(SLICES)))


def train(docs: DataFrame, tokenizer: str, end: int, rows: int = SAMPLE_ROWS) -> bytes:
    """A dictionary from at most ``rows`` documents, picked by hashes, ``SAMPLE_BYTES`` of each; empty if they are too few."""
    sample = bounded_sample(docs.select("doc_id", "text"), 2 * rows, F.col("doc_id"), F.col("text"))

    def cut(batches):
        for batch in batches:
            width = _encoder(tokenizer).width
            yield pa.RecordBatch.from_arrays([pa.array([spread(x, width) for x in _serialised(batch["text"], tokenizer, end)], pa.binary())], ["ids"])

    sample = sample.mapInArrow(cut, "ids binary").distinct().orderBy(F.xxhash64("ids"), "ids").limit(rows)
    samples = sorted(sample.toArrow()["ids"].to_pylist())
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3, **({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))


def pack(doc_ids: list[int | None], counts: list[int], frames: list[bytes], width: int, dictionary_hash: bytes) -> bytes:
    """A shard image."""
    n = len(doc_ids)
    return b"".join([
        _HEAD.pack(MAGIC, VERSION, width, n, dictionary_hash),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(), np.array([i is None for i in doc_ids], np.uint8).tobytes(),
        np.array(counts, "<u4").tobytes(), np.cumsum([0, *map(len, frames)], dtype="<u8").tobytes(), *frames,
    ])


@dataclass
class Shard:
    """Reader of an image; a document is found by the offset index and decompressed alone."""

    image: bytes
    dictionary: bytes

    def __post_init__(self) -> None:
        magic, version, self.width, self.size, digest = _HEAD.unpack_from(self.image)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a shard of token ids")
        if digest != sha256(self.dictionary).digest():
            raise ValueError("written with another dictionary")
        n, at = self.size, _HEAD.size
        self.doc_ids = np.frombuffer(self.image, "<i8", n, at)
        self.null = np.frombuffer(self.image, np.uint8, n, at + 8 * n)
        self.counts = np.frombuffer(self.image, "<u4", n, at + 9 * n)
        self.offsets = np.frombuffer(self.image, "<u8", n + 1, at + 13 * n)
        self.base = at + 13 * n + 8 * (n + 1)
        self.open = _decompressor(self.dictionary)

    def ids(self, i: int) -> np.ndarray:
        a, b = (self.base + int(x) for x in self.offsets[i : i + 2])
        raw = self.open.decompress(self.image[a:b], max_output_size=int(self.counts[i]) * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")


def write(docs: DataFrame, path: str, tokenizer: str, end: int) -> None:
    """Encode every row of ``docs`` (doc_id, text) into shards at ``path``/shards, the dictionary at ``path``/dictionary."""
    spark = docs.sparkSession
    dictionary = train(docs, tokenizer, end)
    digest = sha256(dictionary).digest()
    spark.createDataFrame([(digest, dictionary)], "hash binary, dictionary binary").write.parquet(f"{path}/dictionary")

    def compress(batches):
        own, small = _encoder(tokenizer), _compressor(dictionary)
        for batch in batches:
            raw = list(_serialised(batch["text"], tokenizer, end))
            frames = [small.compress(x) for x in raw]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(x) // own.width for x in raw], pa.int64()), pa.array(frames, pa.binary())],
                ["doc_id", "n", "frame"],
            )

    frames = docs.select("doc_id", "text").mapInArrow(compress, "doc_id long, n long, frame binary")
    frames = written(frames, "frames")  # the range sampling below would else encode everything twice

    def shards(batches):
        part, block = TaskContext.get().partitionId(), 0
        width = _encoder(tokenizer).width
        ids, counts, held, size = [], [], [], 0

        def flush():
            nonlocal block, ids, counts, held, size
            row = [[part], [block], [len(ids)], [sum(counts)], [pack(ids, counts, held, width, digest)]]
            block, ids, counts, held, size = block + 1, [], [], [], 0
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "block", "n_docs", "n_ids", "image"])

        for batch in batches:
            for doc_id, n, frame in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "frame"))):
                ids.append(doc_id)
                counts.append(n)
                held.append(frame)
                size += len(frame)
                if size >= BLOCK:
                    yield flush()
        if ids:
            yield flush()

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("frame"), F.col("frame")]
    ordered = frames.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(shards, "part int, block long, n_docs long, n_ids long, image binary").write.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document, from the shards."""
    shards = spark.read.parquet(f"{path}/shards")
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    totals = sorted(shards.groupBy("part").agg(F.sum("n_ids")).collect())  # one number per range
    before, total = [], 0
    for part, n in totals:
        before.append((part, total))
        total += n
    places = spark.createDataFrame(before, "part int, before long")
    window = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "block", "n_ids").withColumn("within", F.coalesce(F.sum("n_ids").over(window), F.lit(0)))
    starts = starts.join(places, "part").select("part", "block", (F.col("before") + F.col("within")).alias("start"))

    def rows(batches):
        for batch in batches:
            for start, image in zip(batch["start"].to_pylist(), batch["image"]):
                shard = Shard(image.as_py(), dictionary)
                ids = [None if gone else i for i, gone in zip(shard.doc_ids.tolist(), shard.null.tolist())]
                counts = shard.counts.astype(np.int64)
                sums = [crc32(shard.ids(i).tobytes()) for i in range(shard.size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(start + np.cumsum(counts) - counts), pa.array(counts), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = shards.select("part", "block", "image").join(starts, ["part", "block"]).select("start", "image")
    return placed.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Write to a fresh folder and read back."""
    path = fresh_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer, end)
    return read(docs.sparkSession, path)
