"""Token files: new chunks are put together from pieces, and what a worker remembers is bounded."""

from __future__ import annotations

import random
import tracemalloc
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, near_duplicates, token_files
from millrace.llm.common import ready


def test_chunks_from_pieces_give_the_ids_of_whole_texts(monkeypatch):
    own = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    parts = ["'s", "'S", "'ll", "a", "É", "1", "½", "'", "<|", "|>", "endoftext", " ", "\n", "\t", "\x1c", "\xa0", "\x85", "é", "Ω", "ﬁ", "İ", "ß", "."]
    texts = ["".join(chr(rng.randrange(256)) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    want = [array(own.kind, x.ids).tobytes() for x in own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert own.encode_all(texts) == want
    monkeypatch.setattr(token_files, "MEMORY", 1000)  # forget often
    assert [x for i in range(0, len(texts), 500) for x in own.encode_all(texts[i : i + 500])] == want


def test_numbers_that_never_come_again_are_not_remembered():
    own = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    own.encode_all([" ".join(f"id-{i}" for i in range(10_000))])
    assert len(own.memory) < 100


def test_words_are_remembered_without_the_mark_at_their_end():
    own = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    parts = ["ab", "Cd", "é", "7", "'s", ".", ",", "!", "...", ". ", ", ", " ", "\n", "<|", "Ω"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    want = [array(own.kind, x.ids).tobytes() for x in own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert own.encode_all(texts) == want
    own = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    own.encode_all(["one, two. one. two, One end"])
    assert set(own.memory) == {"one", "two", "end", ",", "."}


def test_byte_level_codec_counts_what_a_remembered_chunk_takes():
    own = byte_bpe.Codec({bytes([i]): i for i in range(256)}, public_tokenizers.PATTERN)
    own.encode_all([" ".join(f"w{i}" for i in range(10_000))])
    assert own.held >= 200 * 10_000


def test_byte_level_codec_takes_little_memory_beside_what_it_remembers(monkeypatch):
    own = byte_bpe.Codec({bytes([i]): i for i in range(256)}, public_tokenizers.PATTERN)
    monkeypatch.setattr(byte_bpe, "MEMORY", 8 << 20)
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(36):x}" for _ in range(1000)) for _ in range(320)]
    tracemalloc.start()
    assert sum(ids.size for ids in byte_bpe._encoded(own, pa.array(texts))) == sum(map(len, texts))
    most = tracemalloc.get_traced_memory()[1]
    own.forget()
    own.encode_all(texts[:100])
    held, full = own.held, tracemalloc.get_traced_memory()[0]
    own.first = own.spaced = own.known = None
    freed = full - tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert most < 160e6
    assert freed <= held < 1.5 * freed


def test_byte_level_rows_are_encoded_in_small_batches(spark, monkeypatch):
    def sizes(text, path, pattern):
        @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
        def counted(texts: pa.Array) -> pa.Array:
            n = len(texts)
            return pa.StructArray.from_arrays([pa.array([n] * n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=["n_tokens", "ids_sha256", "decoded_sha256"])

        return counted(text)

    ready(spark)
    monkeypatch.setattr(byte_bpe, "round_trip", sizes)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, docs = spark.conf.get(key), spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id", "'a' AS text")
    got = byte_bpe.encode_documents(docs, "", "").agg(F.max("n_tokens"), F.count("*")).first()
    assert tuple(got) == (2000, 5000) and spark.conf.get(key) == before


def test_sketches_take_little_memory_and_do_not_depend_on_it(monkeypatch):
    own = np.random.default_rng(3).integers(0, 1 << 63, 20_000).astype(np.uint64)
    tracemalloc.start()
    few = near_duplicates.sketches(own)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 16 << 20
    monkeypatch.setattr(near_duplicates, "_CELLS", 1 << 21)
    assert (near_duplicates.sketches(own) == few).all()


def test_near_duplicates_are_found_in_small_batches(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    monkeypatch.setattr(near_duplicates, "_classes", lambda docs: seen.append(int(spark.conf.get(key))))
    before = spark.conf.get(key)
    near_duplicates.classes(spark.range(1))
    assert seen == [2000] and spark.conf.get(key) == before
