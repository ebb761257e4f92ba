"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are runs of characters other than ASCII marks, white space and controls, with A-Z
lower-cased.  A window of an item is ``WINDOW`` words in a row, or the whole item where it is
shorter.  Both sides are fingerprinted alike: of the ``WINDOW - GRAM + 1`` hashed grams in
each window of ``WINDOW`` words the smallest is kept.  Equal windows keep equal grams, so a
join of the fingerprints meets every shared window.  Hits are then extended: every document
window around a met fingerprint is compared word by word with the items' windows.  Items
shorter than a window have no guarantee from winnowing; for each length that occurs (nine at
most) documents also show all their grams of that length.

Scale: one pass over the texts emits about 0.4 fingerprints a word, in generated code, and
joins them with the items' table, which is written first, so Spark knows its size when it
chooses between broadcast and shuffle.  What follows touches only texts that met a
fingerprint, once per distinct text, whatever the number of copies.  Results go back to the
rows by the text's digest, a join Spark can split at hot keys.

Edge cases: null and empty texts have no words and no hit; null and repeated doc_ids stay
rows of their own; item rows without an id mark words but are no item; equal item_ids count
once; an item without words has no window; either table may be empty.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import written

WINDOW, GRAM = 10, 5
_GAP = r"[^\p{Alnum}\x{80}-\x{10FFFF}]+"


def _text(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def words(lowered: Column) -> Column:
    """Words of a text whose A-Z are lower-cased."""
    return F.array_remove(F.split(lowered, _GAP), "")


def exact(text: Column) -> Column:
    return words(F.translate(text, ascii_uppercase, ascii_lowercase))


def _grams(n: int) -> Column:
    """Hash of the ``n`` words from each place on; places too near the end have one of no meaning.

    Lower-casing is Unicode's here, which at most makes more words equal than A-Z alone.
    """
    hashed = F.transform(words(F.lower(_text())), lambda w: F.xxhash64(w))
    return F.flatten(F.transform(F.array(hashed), lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, n)], F.lit(n)))))


def fingerprints(texts: DataFrame, short: list[int], whole: bool, *keep: str) -> DataFrame:
    """(keep, n_words, first, at, n, print): the fingerprints of all texts; each text has one row that is ``first``, be it without a print.

    ``n`` is the length of the window a print stands for.  A print of ``WINDOW`` stands for
    the windows from ``at`` to ``at + WINDOW - GRAM``: it is shown where the smallest gram
    changes, and once in as many places at least.  ``whole``: for the lengths in ``short``,
    only texts of that length show a print.

    Grams are an array of their own, so the generated code that looks for the smallest one
    stays small enough for the JVM to compile.
    """
    sizes = [GRAM, *short]
    grams = texts.select(*keep, *[_grams(n).alias(f"_g{i}") for i, n in enumerate(sizes)])
    rows = grams.select(*keep, F.size("_g0").alias("n_words"), *[f"_g{i}" for i in range(len(sizes))], F.posexplode_outer("_g0").alias("at", "_own"))
    at, left, span = F.col("at"), F.col("n_words") - F.col("at"), WINDOW - GRAM + 1
    lowest = F.least(*[F.get("_g0", at + i) for i in range(span)])
    before = F.least(*[F.get("_g0", at - 1 + i) for i in range(span)])
    first = F.coalesce(at == 0, F.lit(True))
    new = F.coalesce((left >= WINDOW) & ((at % span == 0) | (lowest != before)), F.lit(False))
    shown = rows.where(new | first).select(
        *keep, "n_words", first.alias("first"), "at", F.lit(WINDOW).alias("n"), F.when(new, lowest).alias("print")
    )
    for i, n in enumerate(short, 1):
        fits = (at == 0) & (left == n) if whole else left >= n
        more = rows.where(fits).select(*keep, "n_words", F.lit(False).alias("first"), "at", F.lit(n).alias("n"), F.get(f"_g{i}", at).alias("print"))
        shown = shown.unionByName(more)
    return shown


def _windows(items: DataFrame) -> DataFrame:
    """(item_id, window) of all items, by their exact words."""
    cut = F.transform(
        F.array(exact(_text())),
        lambda ws: F.when(F.size(ws) == 0, F.array().cast("array<string>"))
        .when(F.size(ws) < WINDOW, F.array(F.array_join(ws, " ")))
        .otherwise(F.transform(F.sequence(F.lit(1), F.size(ws) - WINDOW + 1), lambda i: F.array_join(F.slice(ws, i, WINDOW), " "))),
    )
    return items.select("item_id", F.explode(F.flatten(cut)).alias("window")).distinct()


def _met(docs: DataFrame, items: DataFrame, *keep: str) -> DataFrame:
    """(keep, text_key, n_words, first, at, n, known): the first row of each text, and the places that meet an item's print."""
    sized = items.select(F.size(exact(_text())).alias("size"))
    short = sorted(r["size"] for r in sized.where((F.col("size") > 0) & (F.col("size") < WINDOW)).distinct().collect())
    prints = written(fingerprints(items, short, True).where("print IS NOT NULL").select("n", "print").distinct().withColumn("known", F.lit(True)), "prints")
    keyed = docs.select(*keep, F.sha2(_text(), 256).alias("text_key"), "text")
    shown = fingerprints(keyed, short, False, *keep, "text_key")
    return written(shown.join(prints, ["n", "print"], "left").where("known OR first").drop("print"), "met")


def contamination(docs: DataFrame, items: DataFrame, met: DataFrame) -> DataFrame:
    """(text_key, n_hit, item_ids) of each distinct text of ``docs`` with a hit; ``item_ids`` sorted as strings."""
    windows = written(_windows(items), "windows")
    around = F.when(F.col("n") == WINDOW, F.sequence(F.col("at"), F.col("at") + (WINDOW - GRAM))).otherwise(F.array("at"))
    places = met.where("known").select("text_key", "at", "n").distinct().groupBy("text_key").agg(
        F.array_distinct(F.flatten(F.collect_list(F.transform(around, lambda i: F.struct(i.alias("at"), F.col("n").alias("n")))))).alias("places")
    )
    places = written(places, "places")

    texts = docs.select(F.sha2(_text(), 256).alias("text_key"), "text").join(places.select("text_key").hint("merge"), "text_key", "left_semi")  # grows with the corpus: never broadcast
    texts = texts.groupBy("text_key").agg(F.first("text").alias("text"))
    cut = F.transform(
        F.array(exact(_text())),
        lambda ws: F.transform(
            F.filter("places", lambda p: p["at"] + p["n"] <= F.size(ws)),
            lambda p: F.struct(p["at"].alias("at"), p["n"].alias("n"), F.array_join(F.slice(ws, p["at"] + 1, p["n"]), " ").alias("window")),
        ),
    )
    shown = texts.join(places, "text_key").select("text_key", F.explode(F.flatten(cut)).alias("p")).select("text_key", "p.*")
    hits = written(shown.join(windows.select("window").distinct(), "window", "left_semi"), "hits")
    covered = hits.groupBy("text_key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1))))).cast("long").alias("n_hit")
    )
    found = hits.select("text_key", "window").distinct().join(windows.where(F.col("item_id").isNotNull()), "window")
    named = found.groupBy("text_key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    return written(covered.join(named, "text_key", "left"), "contamination")


def measure(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs`` (doc_id, text)."""
    met = _met(docs, items, "doc_id")
    found = contamination(docs, items, met)
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return met.where("first").join(found, "text_key", "left").select(
        "doc_id", F.greatest(F.col("n_words"), F.lit(0)).cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` without a hit, with their columns."""
    found = contamination(docs, items, _met(docs, items)).select("text_key")
    rows = docs.select(F.struct("*").alias("row"), F.sha2(_text(), 256).alias("text_key"))
    return rows.join(found.hint("merge"), "text_key", "left_anti").select("row.*")
