"""Personal data by candidate boosting, in DataFrame operations only.

Base spans (email, ip, card, phone) are matches of fixed patterns that pass a check of their
kind; they are always kept.  On top, wide generators propose further, overlapping spans:
addresses with spelt-out signs, defanged network addresses, card and phone numbers in other
notations.  Each candidate is described by small whole-number features of its format and
context; boosted trees turn them into the probability that a candidate like it passes the
check of its kind (``known``), a threshold per kind decides.  Added is what passes the check
itself and stands where such candidates pass: a number that passes by chance, among many that
fail, is not added.

Training: base and wide candidates of all documents, labelled by their check, are counted by
feature vector and label.  No feature holds the label: digits are
not counted for phones, whose check is their number, and the end of an address is not seen.
The number of vectors is fixed by the features' ranges, so the driver boosts on a small table,
whatever the size of the corpus.  One half of the documents (by hash) grows the trees, the
other calibrates: a kind's threshold is the lowest score from which on precision reaches
``precision``.  Precision is that of candidates that pass: those that fail show how many pass
by chance, ``CHANCE / (1 - CHANCE)`` for each.  A kind without examples of both sorts gets no
added spans.

Places are code points.  They come from the lengths of the gaps and the matches of a
pattern, summed up in blocks, so a text with many matches stays linear.  Scoring is one
projection over the texts without a shuffle.

The patterns keep the meaning of the plain ones (leftmost, longest, not overlapping) but do
not try places inside a run that already failed, and repeat without backtracking.

Edge cases: null and empty texts have no span; null and repeated doc_ids stay rows of their
own; very long runs of digits or dotted parts take linear time; an empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import exp, log

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?+(?:\(at\)|\[at\]|(?<=\x20)at(?=\x20)|@)\x20?+[A-Za-z0-9-]++(?:(?:\x20?\(dot\)\x20?|\x20?\[dot\]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\x20\.\x20|\x20dot\x20|\[dot\])[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[./_]|\x20{2,3}|\x20?-\x20?)[0-9]{4}+(?:(?:[./_]|\x20{2,3}|\x20?-\x20?)[0-9]{1,4}+){2,3}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{2,4}\)\x20?|00[1-9][0-9]?[\x20.-]|[0-9]{3,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?:[\x20.-][0-9]{2,4})?(?![0-9])",
}
_HINT = {"email": "@", "phone": "+"}
_WIDE_HINT = {"email": r"(?:\(at\)|\[at\]| at |@ )", "ip": r"[0-9] ?(?:\[|\(|dot|\.)", "card": r"[0-9]{4}[./_ -]", "phone": r"[0-9)][ .-]?[0-9]{3}"}
_CUES = {
    "email": r"(?i)(mail|contact|write|address)", "ip": r"(?i)\b(ip|host|server|addr)",
    "card": r"(?i)(card|visa|master|account|pay|credit)", "phone": r"(?i)(tel|phone|call|fax|mobile|whatsapp)",
}
FEATURES = ("cue", "left", "right", "size", "marks")
#: Ends of addresses that count as real: country codes and the common generic ones.
_ADDRESS = rf"(?i)^[{_LOCAL}]++@(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+(?:[a-z]{{2}}|com|org|net|edu|gov|mil|int|info|biz|name|pro|mobi|museum|coop|aero|asia|app|dev|cloud|online|shop|site|tech|blog|xyz)$"
#: How often what is none passes its check: one check digit, four numbers below 1000; for the others nothing better than half is known.
CHANCE = {"email": 0.5, "ip": 0.256**4, "card": 0.1, "phone": 0.5}
_BLOCK = 256
_SPAN = "array<struct<kind:int,start:bigint,stop:bigint,value:string,before:string,after:string>>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def running(lengths: Column) -> Column:
    """Sums of an array up to and with each place."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")), lambda b: total(F.slice(lengths, b * _BLOCK + 1, _BLOCK)))
    starts = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return let(starts, lambda s: F.transform(lengths, lambda x, i: F.get(s, F.floor(i / _BLOCK).cast("int")) + total(F.slice(lengths, i - i % _BLOCK + 1, i % _BLOCK + 1))))


def spans(text: Column, kind: int, pattern: str, worth: Column | None = None) -> Column:
    """Matches of a pattern with their places and surroundings."""
    none = F.array().cast(_SPAN)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if worth is not None:
        found = F.when(worth, found).otherwise(F.array().cast("array<string>"))

    def placed(m: Column) -> Column:
        def cut(gaps: Column) -> Column:
            lengths = F.zip_with(F.slice(gaps, 1, F.size(m)), m, lambda g, x: (F.char_length(g) + F.char_length(x)).cast("long"))
            return let(lengths, lambda sizes: let(running(sizes), lambda stops: F.transform(m, lambda x, i: F.struct(
                F.lit(kind).alias("kind"), (F.get(stops, i) - F.char_length(x)).alias("start"), F.get(stops, i).alias("stop"), x.alias("value"),
                F.right(F.get(gaps, i), F.lit(24)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
            ))))

        return F.when(F.size(m) == 0, none).otherwise(let(F.split(text, pattern), cut))

    return let(found, placed)


def valid(kind: str, value: Column) -> Column:
    """The check of a kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"[^0-9]+"), lambda x: x.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return F.char_length(digits).between(13, 19) & F.call_function("luhn_check", F.when(F.char_length(digits) <= 19, digits).otherwise("1"))
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def known(kind: str, value: Column) -> Column:
    """The label of a candidate in any notation: ``valid``, and for addresses a host with a real end."""
    if kind != "email":
        return valid(kind, value)
    plain = F.regexp_replace(F.regexp_replace(value, r"\x20?(?:\(at\)|\[at\]|(?<=\x20)at(?=\x20)|@)\x20?", "@"), r"\x20?\(dot\)\x20?|\x20?\[dot\]\x20?|\x20dot\x20", ".")
    return plain.rlike(_ADDRESS)


def _passing(kind: str, found: Column) -> Column:
    return F.filter(found, lambda s: valid(kind, s["value"]))


def base(text: Column, checked: bool = True) -> dict[str, Column]:
    """Base spans of a text by kind; with ``checked`` only those that pass."""
    out = {}
    for i, kind in enumerate(KINDS):
        own = spans(text, i, BASE[kind], F.contains(text, F.lit(_HINT[kind])) if kind in _HINT else None)
        out[kind] = _passing(kind, own) if checked and kind != "email" else own
    return out


def wide(text: Column) -> Column:
    """Candidates of all wide generators."""
    return F.concat(*[spans(text, i, WIDE[kind], text.rlike(_WIDE_HINT[kind])) for i, kind in enumerate(KINDS)])


def _by_kind(span: Column, of) -> Column:
    out = F.lit(0)
    for i, kind in enumerate(KINDS):
        out = F.when(span["kind"] == i, of(kind).cast("int")).otherwise(out)
    return out


def passes(span: Column) -> Column:
    """Whether a candidate passes the check of its kind."""
    return _by_kind(span, lambda kind: known(kind, span["value"])) == 1


def features(span: Column) -> Column:
    """Small whole numbers that describe a candidate; their ranges bound the number of vectors."""
    def side(c: Column) -> Column:
        return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike("^[0-9]$"), 2).when(c.rlike(r"^\p{L}$"), 3).otherwise(4)

    value, digits = span["value"], F.char_length(F.regexp_replace(span["value"], "[^0-9]", ""))
    phone, email = span["kind"] == KINDS.index("phone"), span["kind"] == KINDS.index("email")
    spelt = F.when(value.rlike(r"[\[(]"), 3).when(value.rlike(r"\x20(?:at|dot)\x20"), 2).when(value.rlike(r"\x20"), 1).otherwise(0)
    numbers = [
        _by_kind(span, lambda kind: span["before"].rlike(_CUES[kind])),
        side(F.right(span["before"], F.lit(1))), side(span["after"]),
        F.when(phone | (digits < 9), 0).when(digits < 13, 1).when(digits < 16, 2).when(digits < 17, 3).when(digits < 20, 4).otherwise(5),
        F.when(email, spelt).when(value.rlike(r"[\[(]"), 3).when(value.rlike(r"[0-9]\x20"), 2).when(value.rlike("[./_-]"), 1).otherwise(0),
    ]
    return F.struct(*[n.cast("int").alias(name) for n, name in zip(numbers, FEATURES)])


@dataclass
class Tree:
    """A leaf, or a question ``feature == value`` with two branches."""

    weight: float = 0.0
    feature: str = ""
    value: int = 0
    yes: Tree | None = None
    no: Tree | None = None

    def of(self, row: dict) -> float:
        return self.weight if not self.feature else (self.yes if row[self.feature] == self.value else self.no).of(row)

    def column(self, f: Column) -> Column:
        if not self.feature:
            return F.lit(self.weight)
        return F.when(f[self.feature] == self.value, self.yes.column(f)).otherwise(self.no.column(f))


@dataclass
class Model:
    """Boosted trees of each kind with their prior and threshold (in log odds)."""

    trees: dict[int, list[Tree]] = field(default_factory=dict)
    prior: dict[int, float] = field(default_factory=dict)
    threshold: dict[int, float] = field(default_factory=dict)

    def odds(self, kind: int, row: dict) -> float:
        return self.prior[kind] + sum(t.of(row) for t in self.trees[kind])

    def selects(self, span: Column) -> Column:
        chosen = F.lit(False)
        for kind, least in self.threshold.items():
            chosen = F.when(span["kind"] == kind, self._odds(kind, span) >= least).otherwise(chosen)
        return chosen & passes(span)

    def _odds(self, kind: int, span: Column) -> Column:
        return let(features(span), lambda f: sum((t.column(f) for t in self.trees[kind]), F.lit(self.prior[kind])))


def _grow(rows: list[tuple[dict, float, float]], depth: int) -> Tree:
    """A tree for rows of (features, gradient, curvature)."""
    def gain(part) -> float:
        return sum(g for _, g, _ in part) ** 2 / (sum(h for *_, h in part) + 1.0)

    leaf = Tree(sum(g for _, g, _ in rows) / (sum(h for *_, h in rows) + 1.0))
    best = None
    for name in FEATURES if depth else ():
        for value in sorted({r[name] for r, *_ in rows}):
            yes = [x for x in rows if x[0][name] == value]
            no = [x for x in rows if x[0][name] != value]
            if yes and no and (better := gain(yes) + gain(no) - gain(rows)) > (best[0] if best else 1e-6):
                best = better, name, value, yes, no
    return leaf if best is None else Tree(0.0, best[1], best[2], _grow(best[3], depth - 1), _grow(best[4], depth - 1))


def _free(span: Column) -> Column:
    """Whether a candidate touches no base span (column ``base``)."""
    return ~F.exists(F.concat(*[F.col(f"base.{k}") for k in KINDS]), lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))


def fit(docs: DataFrame, rounds: int = 12, depth: int = 2, rate: float = 0.5, precision: float = 0.99) -> Model:
    """Boost on the candidates of all documents; see the module's text."""
    text = F.coalesce("text", F.lit(""))
    grows = (F.pmod(F.xxhash64("text"), F.lit(2)) == 0).alias("grow")
    held = docs.select(grows, F.struct(*[c.alias(k) for k, c in base(text, checked=False).items()]).alias("every"), wide(text).alias("wide"))
    held = held.select("grow", "every", "wide", F.struct(*[_passing(k, F.col(f"every.{k}")).alias(k) for k in KINDS]).alias("base"))
    candidates = F.concat(*[F.col(f"every.{k}") for k in KINDS], F.filter("wide", _free))
    found = held.select("grow", F.explode(candidates).alias("s")).select("grow", "s.kind", passes(F.col("s")).alias("good"), features(F.col("s")).alias("f"))
    counted = found.groupBy("grow", "kind", "good", "f").count().collect()  # bounded by the features' ranges
    model = Model()
    for kind in range(len(KINDS)):
        table = [(r["f"].asDict(), float(r["good"]), r["count"], r["grow"]) for r in counted if r["kind"] == kind]
        table.sort(key=lambda x: (sorted(x[0].items()), x[1], x[3]))
        grow, check = [x for x in table if x[3]], [x for x in table if not x[3]]
        good, all_ = sum(n * y for _, y, n, _ in grow), sum(n for _, _, n, _ in grow)
        if not 0 < good < all_ or not check:
            continue
        model.prior[kind], model.trees[kind] = log(good / (all_ - good)), []
        for _ in range(rounds):
            steps = []
            for f, y, n, _ in grow:
                p = 1 / (1 + exp(-model.odds(kind, f)))
                steps.append((f, rate * n * (y - p), n * p * (1 - p)))
            model.trees[kind].append(_grow(steps, depth))
        scored: dict[float, list[float]] = {}
        for f, y, n, _ in check:  # all of one score count together
            both = scored.setdefault(model.odds(kind, f), [0.0, 0.0])
            both[0], both[1] = both[0] + n * y, both[1] + n
        hit = wrong = 0.0
        chance = CHANCE[KINDS[kind]]
        for odds, (right, all_) in sorted(scored.items(), reverse=True):
            hit, wrong = hit + right, wrong + (all_ - right) * chance / (1 - chance)
            if hit - wrong >= precision * hit and odds > 0:
                model.threshold[kind] = odds - 1e-9
    return model


def find(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns ``keep``, the base spans of each kind, and ``added`` spans (selected, not touching a base one)."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select(*keep, F.struct(*[c.alias(k) for k, c in base(text).items()]).alias("base"), (wide(text) if model.threshold else F.array().cast(_SPAN)).alias("wide"))
    return own.select(*keep, "base", F.filter("wide", lambda s: _free(s) & model.selects(s)).alias("added"))


def _named(spans_: Column) -> Column:
    """kind:start:stop, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["stop"])), ",")


def measure(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, base counts, base_sha256 and all spans of every row of ``docs`` (doc_id, text)."""
    places = [F.transform(F.col(f"base.{k}"), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))) for k in KINDS]
    added = F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    found = find(docs, model, "doc_id")
    return found.select(
        "doc_id", *[F.size(f"base.{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_named(F.concat(*places)), 256).alias("base_sha256"), _named(F.array_sort(F.concat(*places, added))).alias("spans"),
    )


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; touching spans become one, named by the first."""
    found = find(docs.select(F.struct("*").alias("row"), "text"), model, "row", "text")
    every = F.array_sort(F.transform(F.concat(*[F.col(f"base.{k}") for k in KINDS], "added"), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    joined = F.aggregate(every, F.array().cast("array<struct<start:bigint,stop:bigint,kind:int>>"), lambda a, s: F.when(
        (F.size(a) > 0) & (s["start"] < F.element_at(a, -1)["stop"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["stop"], s["stop"]).alias("stop"), F.element_at(a, -1)["kind"].alias("kind")))),
    ).otherwise(F.concat(a, F.array(s))))
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def masked(spans_: Column) -> Column:
        pieces = F.transform(spans_, lambda s, i: F.concat(
            F.substring(F.col("text"), (F.when(i == 0, F.lit(0)).otherwise(F.get(spans_, i - 1)["stop"]) + 1).cast("int"),
                        (s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(spans_, i - 1)["stop"])).cast("int")),
            F.get(kinds, s["kind"])))
        rest = F.substring(F.col("text"), (F.element_at(spans_, -1)["stop"] + 1).cast("int"), F.char_length("text"))
        return F.when(F.size(spans_) == 0, F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), rest))

    return found.select("row", let(joined, masked).alias("clean")).select(
        *[F.col("clean").alias("text") if c == "text" else F.char_length("clean").cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns]
    )
