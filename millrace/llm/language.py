"""Language identification with error-correcting output codes.

Every language gets a codeword; each bit is a binary n-gram classifier that tells the
languages with a 1 from those with a 0.  Up to five languages take the exhaustive code
(all ways to split them in two), more take a random code of growing length.

A bit's classifier is multinomial: the log ratio of the hashed byte n-grams' frequencies in
both groups of languages, averaged over the n-grams of a text.  Decoding sums, per language,
a logistic loss of (code bit x margin), weighted by how reliably the bit was predicted on the
sample, and picks the smallest; ``ambiguous`` is set where the runner-up is close.

N-grams are taken over lower-cased letters; anything else separates words.  All counts come
from all labelled rows (or from about ``rows`` of them, where a caller gives a number),
spread over the tasks; the driver gets languages x ``2**bits`` counts.

Edge cases: null texts and texts without a letter give ``und`` with score 0; with no
labelled row at all everything is ``und``; with one language that one is chosen; ties go to
the language first by name; null ids are held out; repeated rows are treated alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import terms
from millrace.llm.common import bounded_sample, held_out

SIZE = 3
UNKNOWN = "und"
_map = np.full(256, 32, np.uint8)
_map[97:123] = np.arange(97, 123)
_map[65:91] = np.arange(97, 123)
_map[128:] = np.arange(128, 256)


def letters_only(text: Column) -> Column:
    """Lower-cased letters between spaces; every run of other characters becomes one space."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), F.lit(" "))


def grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of the byte n-grams of prepared rows, none across a row's end."""
    n = len(data) - SIZE + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values = _map[data].astype(np.uint32)
    window = values[:n].copy()
    for i in range(1, SIZE):
        window = (window << np.uint32(8)) | values[i : n + i]
    inside = np.ones(n, bool)
    for i in range(1, SIZE):  # those that begin in the last bytes of a row
        inside[np.clip(offsets[1:] - i, 0, n)[offsets[1:] - i < n]] = False
    at = np.flatnonzero(inside)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[at]
    window = window[at] * np.uint32(0x9E3779B1)
    return row, (window >> np.uint32(32 - bits)).astype(np.int64)


def code_of(n: int) -> np.ndarray:
    """Codewords (-1, 1) of ``n`` languages, one row each."""
    if n <= 5:
        return np.array([bits for bits in product((1, -1), repeat=n) if bits[0] == 1 and -1 in bits], np.float64).T.reshape(n, -1)
    rng, width = np.random.default_rng(n), 10 * int(np.ceil(np.log2(n)))
    while True:
        code = rng.choice((-1.0, 1.0), (n, width))
        code = code[:, np.abs(code.sum(0)) < n]
        if len(np.unique(code, axis=0)) == n:
            return code


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray
    ratios: np.ndarray
    trust: np.ndarray
    scale: float = 8.0
    close: float = 0.1

    @property
    def bits(self) -> int:
        return int(len(self.ratios)).bit_length() - 1

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean log ratio of each bit for each row."""
        row, slot = grams(data, offsets, self.bits)
        out = np.zeros((len(offsets) - 1, self.ratios.shape[1]))
        if len(row) and out.shape[1]:
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            size = np.diff(np.concatenate([first, [len(row)]]))
            out[row[first]] = np.add.reduceat(self.ratios[slot], first, axis=0) / size[:, None]
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, runner-up is close) of each row of margins."""
        loss = np.log1p(np.exp(-np.clip(self.scale * self.code[None] * margins[:, None], -50, 50))) @ self.trust
        odds = np.exp(-(loss - loss.min(1, keepdims=True)) * self.code.shape[1] / 2)
        odds /= odds.sum(1, keepdims=True)
        best = odds.argmax(1)
        top = np.sort(odds, 1)
        return best, top[:, -1], (top[:, -1] - top[:, -2] if odds.shape[1] > 1 else top[:, -1]) < self.close


def fit(docs: DataFrame, rows: int | None = None, bits: int = 16) -> Model:
    """Learn from all texts (or about ``rows``) with a language outside the held-out fold; only the text is an input."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", "text", "lang")
    if rows is not None:
        known = bounded_sample(known, rows, F.col("doc_id"))
    prepared = known.select("lang", letters_only(F.col("text")).alias("text"))
    size = 1 << bits

    def counts(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = terms.buffer_of(batch["text"])
            names = batch["lang"].to_pylist()
            for a, b in terms.slices(offsets):
                row, slot = grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], bits)
                for name in sorted(set(names[a:b])):
                    own = np.array([x == name for x in names[a:b]])
                    total.setdefault(name, np.zeros(size, np.int64))
                    total[name] += np.bincount(slot[own[row]], minlength=size)
        for name, found in total.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(found[at])], ["lang", "slot", "n"])

    table = prepared.mapInArrow(counts, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = table["lang"].to_pylist()
    languages = tuple(sorted(set(names)))
    if not languages:
        return Model((), np.zeros((0, 0)), np.zeros((size, 0)), np.zeros(0))
    tally = np.zeros((len(languages), size))
    number = {x: i for i, x in enumerate(languages)}
    tally[[number[x] for x in names], table["slot"].to_numpy()] = table["n"].to_numpy()
    share = tally / np.maximum(1, tally.sum(1, keepdims=True))  # every language weighs the same in its group
    code = code_of(len(languages))
    if not code.shape[1]:
        return Model(languages, code, np.zeros((size, 0)), np.zeros(0))
    least = 1e-6
    ratios = np.stack(
        [np.log((share[bit > 0].mean(0) + least) / (share[bit < 0].mean(0) + least)) for bit in code.T], 1
    ).astype(np.float32)
    model = Model(languages, code, ratios, np.full(code.shape[1], 1 / code.shape[1]))

    def hits(batches):
        for batch in batches:
            data, offsets = terms.buffer_of(batch["text"])
            names = [number[x] for x in batch["lang"].to_pylist()]
            for a, b in terms.slices(offsets):
                margin = model.margins(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                right = ((margin * code[names[a:b]]) > 0).sum(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(right))), pa.array(right), pa.array(np.full(len(right), b - a))], ["bit", "hit", "n"]
                )

    found = prepared.mapInArrow(hits, "bit long, hit long, n long").groupBy("bit").agg(F.sum("hit").alias("hit"), F.sum("n").alias("n")).toArrow()
    trust = np.ones(code.shape[1])
    trust[found["bit"].to_numpy()] = (found["hit"].to_numpy() + 1) / (found["n"].to_numpy() + 2)
    return Model(languages, code, ratios, trust / trust.sum())


def predict(model: Model, text: Column) -> Column:
    """Struct of lang_pred, score (0 to 1) and ambiguous, from the whole text."""

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def decoded(texts: pa.Array) -> pa.Array:
        data, offsets = terms.buffer_of(texts)
        n = len(texts)
        named, scores, close = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
        for a, b in terms.slices(offsets):
            part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            filled = np.concatenate([[0], np.cumsum(_map[part] != 32)])
            some = np.flatnonzero(filled[cuts[1:]] > filled[cuts[:-1]])
            if len(some) and model.languages:
                best, top, near = model.decode(model.margins(part, cuts)[some])
                named[a + some], scores[a + some], close[a + some] = np.array(model.languages, object)[best], top, near
        return pa.StructArray.from_arrays([pa.array(named, pa.string()), pa.array(scores), pa.array(close)], names=["lang_pred", "score", "ambiguous"])

    return decoded(letters_only(text))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row."""
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(model, F.col("text")).alias("found")).select(
        "doc_id", "held_out", "found.*"
    )
