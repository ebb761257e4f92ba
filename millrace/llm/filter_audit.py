"""How filters interact: what each removes in every order in which they can be applied.

Five filters, by the condition a text fails: A has under ``LEAST_WORDS`` words; B has fewer
distinct words than ``DISTINCT`` percent of its words; C has more A-Z than ``CAPITALS`` percent
of its characters; D holds one of ``MARKS``; E equals the text of a row with a smaller doc_id.
A and B are read off the rows of a sparse document-term matrix (``term_matrix``): the sum of a
row and its nonzero cells.  C and D are counted where the texts are encoded, E is a minimum per
text digest.

The filters that a row fails are one of 32 sets, so all that the orders need is a count per (part,
set, labels).  Each count is then laid out over the 120 orders and 5 steps, a fixed 600 rows.
Shapley values need no order either: a row that fails k filters is removed by each of them in
120 / k orders.

Scale: besides the matrix only digests and ids are shuffled.  Minima per digest combine before
the shuffle; they are joined on (digest, doc_id), so copies of one text, however many, spread.
Equal rows are folded to a count before that.  The report has 600 rows a part.

Edge cases: null counts as the empty text, which fails neither B, C nor D (0 words are not fewer than 80 %
of 0 words); a null lang is part ''; a null doc_id is neither smaller nor larger than another,
so such rows never fail E and have no labels; equal ids do not make copies of each other; of
several labels of one id the largest counts; an empty table gives no row.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import terms
from millrace.llm.common import written
from millrace.llm.term_matrix import matrix, row_measures

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT, CAPITALS, MARKS = 100, 80, 10, "#$%&*|"
_MARK = np.isin(np.arange(256), list(MARKS.encode()))


def _characters(texts: pa.Array) -> list[pa.Array]:
    """(C, D) of some texts, counted in their bytes."""
    data, offsets = terms.buffer_of(texts)

    def count(hit: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(hit), offsets))

    capitals, characters = count((data >= 65) & (data <= 90)), count((data & 0xC0) != 0x80)
    return [pa.array(100 * capitals > CAPITALS * characters), pa.array(count(_MARK[data]) > 0)]


def flags(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest, n_words, n_distinct and whether each filter A to E fails, for every row of ``docs`` (doc_id, text, lang)."""
    shards, _ = matrix(
        docs, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), measure=_characters, fields="C boolean, D boolean",
    )
    rows = row_measures(shards).withColumns({
        "A": F.col("n_words") < LEAST_WORDS, "B": 100 * F.col("n_distinct") < DISTINCT * F.col("n_words"),
    })
    rows = written(rows, "flags")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    return rows.join(first, ["digest", "doc_id"], "left").withColumn("E", F.col("doc_id").isNotNull() & F.col("first").isNull()).drop("first")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")
    )
    return rows.join(known, "doc_id", "left").withColumns({n: F.coalesce(n, F.lit(False)) for n in ("good", "toxic")})


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows per (part, failed, good, toxic); ``failed`` names the filters that a row fails."""
    failed = F.concat(*[F.when(F.col(f), f).otherwise("") for f in FILTERS])
    folded = flags(docs).groupBy("doc_id", "part", failed.alias("failed")).agg(F.count("*").alias("n"))
    return _labelled(folded, labels).groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def report(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``cells``."""
    orders = ",".join("".join(order) for order in permutations(FILTERS))
    laid = counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
    laid = laid.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    own = F.expr("substr(filter_order, step, 1)")
    fails = F.expr("contains(failed, substr(filter_order, step, 1))")
    gone = F.expr("translate(failed, substr(filter_order, 1, step - 1), '') != failed")
    removed = fails & ~gone
    share = F.col("n") * (F.lit(factorial(len(FILTERS))) / F.greatest(F.length("failed"), F.lit(1))).cast("long")

    def total(when: Column, value: Column | None = None) -> Column:
        return F.sum(F.when(when, F.col("n") if value is None else value).otherwise(0))

    return laid.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(removed).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("failed") == own).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"), total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report of all rows of ``docs`` (doc_id, text, lang) with ``labels`` (doc_id, quality, toxic)."""
    return report(written(cells(docs, labels), "cells"))
