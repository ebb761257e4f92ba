"""Importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import importance, terms
from millrace.llm.common import written


def features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return len(w), [crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def test_buckets_are_those_of_the_joined_words(texts):
    chance = random.Random(1)
    own = ["".join(chance.choices("abZé9 .-\n", k=chance.randint(0, 60))) for _ in range(200)] + ["q" * n + " " + "w" * n for n in range(0, 3000, 13)]
    own += [t for _, t in texts]
    row, bucket, n = importance.buckets(*terms.buffer_of(pa.array(own, pa.string())))
    for i, t in enumerate(own):
        size, want = features(t)
        assert size == n[i] and Counter(want) == Counter(bucket[row == i].tolist())


@pytest.mark.parametrize("last", [1, 50])
def test_cut_is_the_ranked_key(spark, monkeypatch, last):
    monkeypatch.setattr(importance, "LAST", last)
    chance = random.Random(last)
    many = [(chance.choice([chance.randint(-9, 9), 3, chance.randint(-(10**6), 10**6)]), 0, chance.randint(0, 40), chance.randint(-2, 2)) for _ in range(1500)]
    many += [(5, 1, 0, 0)] * 300 + [(-(10**9), 0, i, 0) for i in range(200)]
    uneven = spark.createDataFrame(many, "low long, gone long, id long, tie long").repartitionByRange(7, "low")
    keys, ranked = written(uneven, "test-keys"), sorted(many)
    for rank in (1, 2, 199, 200, 201, 777, 1500, len(many) - 1, len(many)):
        assert importance.cutoff(keys, rank) == ranked[rank - 1]
    assert importance.cutoff(keys, 0) is None and importance.cutoff(keys, len(many) + 1) is None and importance.cutoff(keys.limit(0), 1) is None


def brute(rows, target, percent, least):
    made = [(i, t, *features(t)) for i, t in rows]
    corpus, wanted = Counter(b for r in made for b in r[3]), Counter(b for t in target for b in features(t)[1])
    s, t = sum(corpus.values()) + 10000, sum(wanted.values()) + 10000
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * s / ((corpus[b] + 1) * t))) for b in corpus}
    out = []
    for i, _, n, found in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    size = sum(r[4] for r in out) * percent // 100
    ranked = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1:3]))[:size]
    shown = [(*r[:4], place) for place, r in enumerate(ranked, 1)]
    left = Counter(r[:4] for r in out)
    left.subtract(r[:4] for r in ranked)
    return sorted(shown, key=repr), sorted(((*r, None) for r in left.elements()), key=repr)


@pytest.mark.parametrize(("percent", "least", "last"), [(5, 20, 4096), (40, 3, 8), (100, 1, 1), (0, 20, 4096)])
def test_drawn_documents(spark, docs, texts, monkeypatch, percent, least, last):
    monkeypatch.setattr(importance, "LAST", last)
    target = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()] + [None, ""]
    items = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    odd = docs.selectExpr("*", "1 AS low", "2 AS rank", "3 AS tie", "4 AS weight", "5 AS n", "6 AS part", "7 AS n_words").repartition(5)
    made = [tuple(r) for r in importance.resample(odd, items, percent, least).collect()]
    drawn, others = brute(texts, target, percent, least)
    assert sorted((r for r in made if r[4] is not None), key=repr) == drawn
    assert sorted((r for r in made if r[4] is None), key=repr) == others


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert importance.resample(none, docs).count() == 0
    made = importance.resample(docs, none, 10).collect()
    assert len(made) == docs.count() and max(r["rank"] or 0 for r in made) > 0


def test_one_text_in_a_third_of_all_rows_shares_places(spark):
    rows = [(7, "the same words again " * 9)] * 400 + [(i, f"word {i} " * 15) for i in range(800)]
    made = importance.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), spark.createDataFrame([("the same words",)], "text string"), 10)
    assert sorted(r["rank"] for r in made.where("rank IS NOT NULL").collect()) == list(range(1, 121))
    assert made.count() == 1200


def test_moves_of_checksums_are_those_of_zlib():
    for n in (0, 1, 2, 3, 7, 64, 1000, 65537):
        left, right = b"some words", bytes(range(256)) * (n // 256 + 1)
        right = right[:n]
        made = importance.joined(np.array([crc32(left)], np.uint32), np.array([crc32(right)], np.uint32), np.array([n]))
        assert made[0] == crc32(left + right)
