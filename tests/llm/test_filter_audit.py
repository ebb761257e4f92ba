"""Filter audit and term matrix against brute force."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import filter_audit, term_matrix


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


@pytest.mark.parametrize(("tasks", "buckets"), [(5, 3), (1, 1024)])
def test_matrix_holds_every_word_under_one_id(spark, docs, texts, tasks, buckets):
    shards, known = term_matrix.matrix(docs.repartition(tasks), F.col("doc_id"), F.col("text").alias("whole"), F.col("key"), buckets=buckets)
    ids = {r["word"]: r["word_id"] for r in known.collect()}
    assert sorted(ids.values()) == list(range(len(ids))) and set(ids) == {w for _, t in texts for w in words(t)}
    names = {i: w for w, i in ids.items()}
    found = []
    for s in shards.collect():
        indptr, indices, counts = (term_matrix.unpack(s[c]).tolist() for c in ("indptr", "indices", "counts"))
        for d, a, b in zip(s["docs"], indptr, indptr[1:]):
            assert indices[a:b] == sorted(indices[a:b]) and d["key"] == 1
            assert {names[i]: n for i, n in zip(indices[a:b], counts[a:b])} == Counter(words(d["whole"]))
            found.append((d["doc_id"], d["whole"]))
    assert Counter(found) == Counter(texts)


def brute(rows, labels):
    """The report by applying the filters one after the other."""
    best = {}
    for i, quality, toxic in labels:
        was = best.get(i, (None, None))
        best[i] = tuple(max((x for x in pair if x is not None), default=None) for pair in zip(was, (quality, toxic)))
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)

    def fails(i, t):
        t = t or ""
        w = words(t)
        return {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t],
        }

    judged = [(part or "", fails(i, t), *(best.get(i, (None, None)) if i is not None else (None, None))) for i, t, part in rows]
    out, share = {}, Counter()
    for part in {j[0] for j in judged}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [j[1:] for j in judged if j[0] == part]
            everything = left
            for step, f in enumerate(order, 1):
                gone, left = [j for j in left if j[0][f]], [j for j in left if not j[0][f]]
                share[part, f] += len(gone)
                alone = sum(j[0][f] and sum(j[0].values()) == 1 for j in everything)
                redundant = sum(j[0][f] for j in everything) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, alone, sum(j[1] == 1 for j in gone), sum(j[2] == 1 for j in gone)]
    return sorted((*k, *v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items())


EXTRA = [
    (1001, "copy me", "xx"), (1002, "copy me", "xx"), (1002, "copy me", "xx"), (1003, "copy me", "yy"), (None, "copy me", "xx"), (None, "copy me", None),
    (1004, "ABC " * 200, "yy"), (1005, "a # b", ""), (1006, " ".join(f"w{i}" for i in range(100)), "yy"), (1007, " ".join(f"w{i}" for i in range(99)), "yy"),
    (1008, " ".join(f"w{i % 80}" for i in range(100)), "yy"), (1009, " ".join(f"w{i % 79}" for i in range(100)), "yy"), (1010, "A23456789é", "yy"),
    (1011, "A2345678é", "yy"), (1012, "　a\x1cb\x85c " * 120, "yy"),
]
LABELS = [(1001, 1, 0), (1002, 1, 1), (1002, 0, None), (1004, 0, 1), (1006, 1, 1), (1005, None, 1), (None, 1, 1), (5, 1, 1), (-4, 1, 0), (99999, 1, 1)]


def test_audit_equals_filtering_in_every_order(spark, docs):
    extra = spark.createDataFrame(EXTRA, "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang", *[c for c in docs.columns if c in ("key", "h", "root", "score")]).unionByName(extra, allowMissingColumns=True)
    both = both.selectExpr("*", "7 AS n_words", "'x' AS part", "true AS first", "8 AS n", "9 AS digest")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS n", "2 AS part")
    made = sorted(tuple(r) for r in filter_audit.audit(both, labels).collect())
    assert made == brute([tuple(r) for r in both.select("doc_id", "text", "lang").collect()], LABELS)
    assert len(made) == 600 * len({r[0] for r in made})


def test_audit_of_nothing(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    made = filter_audit.audit(docs, labels).agg(F.sum("good_lost"), F.sum("toxic_lost"), F.min("kept")).first()
    assert made[:2] == (0, 0)
