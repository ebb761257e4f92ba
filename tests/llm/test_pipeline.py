"""The corpus pipeline as a whole against a plain chain of its five decisions."""

from __future__ import annotations

import random
import zlib

import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from test_operators import closure, common, plain_bpe, plain_contamination, plain_spans, rows, sha, told  # noqa: F401
from millrace.llm import near_duplicates, pii, quality
from millrace.llm.common import ready


def plain_near_duplicates(docs):
    """One row of each group of texts of which an alignment keeps enough words."""
    words = [list(map(int, w)) for w in told([t for _, t, *_ in docs])]
    links = []
    for i, a in enumerate(words):
        for j in range(i):
            b = words[j]
            same = (docs[i][1] or "") == (docs[j][1] or "")
            long = max(len(a), len(b))
            if same or (a and b and min(len(a), len(b)) >= 0.8 * long and common(a, b) >= 0.8 * long - 1e-6):
                links.append((i, j))
    groups = {}
    for i, root in enumerate(closure(len(docs), links)):
        groups.setdefault(root, []).append(docs[i])
    return [min(g, key=lambda d: (d[0] is None, d[0] or 0, sha(d[1] or ""))) for g in groups.values()]


def plain_redaction(text):
    """Base spans, joined where they overlap, replaced by the kind of the first."""
    found = sorted((a, b, k) for k, spans in enumerate(plain_spans(text)[n] for n in pii.KINDS) for a, b in spans)
    joined = []
    for a, b, k in found:
        if joined and a < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b, k])
    out, at = "", 0
    for a, b, k in joined:
        out, at = f"{out}{text[at:a]}[{pii.KINDS[k].upper()}]", b
    return out + text[at:]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with nulls, copies, near copies, a benchmark passage, personal data and clashing extra columns."""
    ready(spark)
    path = tmp_path_factory.mktemp("tables")
    rng = random.Random(11)
    supplied = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(150)
    own = [tuple(r) for r in supplied.collect()]
    item = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first()
    plain = [t for _, t in own if t and 40 <= len(t.split()) <= 150][:12]
    at = 10_000_000
    for i, t in enumerate(plain):
        near = t.split(" ")
        near[rng.randrange(len(near))] = f"changed{i}"
        own += [(at + 10 * i, t), (at + 10 * i + 1, " ".join(near)), (at + 10 * i + 2, f"{i} different words here {i} {item.text} and {i} more"), (at + 10 * i + 3, f"{t} {t} write to ann{i}@mail{i}.org or +1 (017) 555-77{10 + i}, 10.0.0.{i}")]
    own += [(None, plain[0]), (None, None), (at + 900, None), (at + 901, ""), (at + 902, "!!"), (at + 903, plain[1]), (at + 903, plain[1])]
    docs = spark.createDataFrame(own, "doc_id long, text string").selectExpr(
        "doc_id", "text", "CASE WHEN doc_id % 2 = 0 THEN 'en' END AS lang", "'s' AS source", "length(text) AS n_chars", "1 AS key", "2 AS root", "3 AS row", "4 AS base", "5 AS shard",
    )
    docs.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").join(docs.select("doc_id").distinct(), "doc_id").write.parquet(f"{path}/labels.parquet")
    spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline_equals_the_plain_chain(spark, folder, plain_bpe):  # noqa: F811
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    docs = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    model = quality.fit(read("documents"), read("labels"))
    good = [d for d in docs if model.logits(pa.array([d[1]], pa.string()))[0] >= 0]
    assert 20 < len(good) <= len(docs)
    single = plain_near_duplicates(good)
    assert len(single) < len(good)
    items = [tuple(r) for r in read("benchmark").select("item_id", "text").collect()]
    dirty = [r[-1] for r in plain_contamination(single, items)]
    clean = [d for d, hit in zip(single, dirty) if not hit]
    assert len(clean) < len(single)
    masked = [(i, plain_redaction(t or "")) for i, t in clean]
    assert any("[EMAIL]" in t and "[PHONE]" in t and "[IP]" in t for _, t in masked)
    want = []
    for i, t in masked:
        ids = plain_bpe(t)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t)))
    assert rows(corpus_pipeline.run(spark, folder)) == sorted(want, key=repr)


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
