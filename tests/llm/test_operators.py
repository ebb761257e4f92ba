"""Text operators against brute force, on supplied rows and on edges."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from millrace.llm import (
    byte_bpe, decontaminate, fingerprints, language, near_duplicates, pii, quality, terms, token_counts, token_files, url_filters,
)
from millrace.llm.common import fresh_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_words_and_grams_do_not_depend_on_pieces(monkeypatch):
    texts = ["Don't stop, ÄÖ ü2 x", "", "one", "a b c d e f g a b c d e f g", "x" * 5000 + " y"] * 3
    data, offsets = terms.buffer_of(pa.array([*texts, None]))
    row, h, size = terms.words(data, offsets)
    plain = [w for t in texts for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t)]
    assert len(row) == len(plain) and size.tolist() == [len(w.encode()) for w in plain]
    assert len(set(h.tolist())) == len({w.encode().lower() for w in plain})
    at, gram = terms.grams(row, h, 3)
    lengths = [len(re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t)) for t in texts]
    assert np.bincount(at, minlength=len(texts)).tolist() == [max(n - 2, min(n, 1)) for n in lengths]
    monkeypatch.setattr(terms, "PIECE", 7)
    again = terms.words(data, offsets)
    assert all((a == b).all() for a, b in zip(again, (row, h, size)))


def test_token_counts_and_cache(spark, docs, texts):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    cache = fresh_path(spark, "test-cache")
    want = sorted(((i, len((t or "").encode()), len(own.encode(t or ""))) for i, t in texts), key=repr)
    assert rows(token_counts.count_tokens(docs.limit(40), cache, path))
    known = token_counts.open_cache(spark, cache)
    before = known.count()
    assert known.select("content").distinct().count() == before
    assert rows(token_counts.count_tokens(docs, cache, path)) == want
    after = token_counts.open_cache(spark, cache)
    assert after.select("content").distinct().count() == after.count() == len({t or "" for _, t in texts})
    assert rows(token_counts.count_tokens(docs, cache, path)) == want  # all hits
    assert token_counts.open_cache(spark, cache).count() == after.count()
    assert token_counts.count_tokens(docs.limit(0), cache, path).count() == 0


def test_cached_counts_are_used_and_belong_to_one_tokenizer(spark):
    path, cache = public_tokenizers.path("piece_bpe_32k.model"), fresh_path(spark, "test-cache")
    one = spark.createDataFrame([(1, "hello")], "doc_id long, text string")
    stored = [(sha("hello"), token_counts.version_of(path), 77), (sha("hello"), token_counts.version_of(path), 77), (sha("hello"), "other", 5)]
    spark.createDataFrame(stored, token_counts.CACHE).write.parquet(cache)
    assert rows(token_counts.count_tokens(one, cache, path)) == [(1, 5, 77)]


HISTORY = [
    ("spam", "host", "A.example.com", "add", "2024-01-05 00:00:00"), ("spam", "host", "a.example.com", "remove", "2024-01-20 00:00:00"),
    ("spam", "host", "a.example.com", "add", "2024-05-02 12:00:00"), ("adult", "domain", "example.com", "add", "2024-03-31 23:00:00"),
    ("adult", "domain", "example.com", "remove", "2024-06-01 00:00:00"), ("adult", "domain", "example.com", "add", "2024-06-01 00:00:00"),
    ("bad", "prefix", "b.org/x/y", "add", "2023-11-11 00:00:00"), ("bad", "prefix", None, "add", "2023-11-11 00:00:00"), ("bad", "host", "b.org", "add", None),
]


def test_url_filters(spark):
    from datetime import datetime, timedelta

    entries = spark.createDataFrame(HISTORY, "list string, kind string, pattern string, action string, at string").selectExpr("* EXCEPT (at)", "to_timestamp(at) AS at")
    urls = ["https://a.example.com/q", "http://u:p@A.EXAMPLE.com:80?x", "https://x.y.example.com", "https://b.org/x/y/z?u#v", "https://b.org/x", "nonsense", "", None, "https://c.net/"]
    times = [datetime(2023, 10, 1) + timedelta(hours=137 * i) for i in range(60)] + [None]
    captures = [(i, u, t) for i, (u, t) in enumerate(itertools.product(urls, times))] + [(None, urls[0], times[40])] * 2

    def judged(u, t):
        if u is None or t is None:
            return []
        m = re.match(url_filters._HOST, u)
        host = m[1].lower() if m else ""
        p = [x for x in (re.match(url_filters._PATH, u) or [0, ""])[1].split("/") if x]
        labels = host.split(".")
        keys = {("host", host)} | {("domain", ".".join(labels[i:])) for i in range(len(labels))} | {("prefix", f"{host}/{'/'.join(p[:i])}") for i in range(1, len(p) + 1)}
        state = {}
        for name, kind, pattern, action, at in sorted((e for e in HISTORY if all(e)), key=lambda e: (e[4], e[3])):
            if host and (kind, pattern.lower()) in keys and datetime.fromisoformat(at) <= t:
                state[name, kind, pattern.lower()] = action
        return sorted({k[0] for k, v in state.items() if v == "add"})

    want = sorted(((i, bool(x), len(x), ",".join(x)) for i, u, t in captures for x in [judged(u, t)]), key=repr)
    table = spark.createDataFrame(captures, "id long, url string, fetched_at timestamp")
    assert rows(url_filters.judge(table, entries)) == want
    assert {r[1] for r in rows(url_filters.judge(table, entries.limit(0)))} == {False}
    assert url_filters.judge(table.limit(0), entries).count() == 0


def test_language(spark, docs):
    from pyspark.sql import functions as F

    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(full)
    assert len(model.languages) == 4 and len({tuple(c) for c in model.code}) == 4
    judged = language.identify(full, model).join(full.select("doc_id", "lang"), "doc_id").where("held_out")
    assert judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99
    own = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert language.identify(docs, model).count() == docs.count()
    assert (own[-3].lang_pred, own[-3].score) == ("und", 0.0) and own[-7].lang_pred == own[-1].lang_pred == own[-2].lang_pred == "und"
    assert own[-4].lang_pred in model.languages and all(0 <= r.score <= 1 for r in own.values())
    none = language.fit(full.limit(0))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    single = language.fit(full.where("lang = 'en'"))
    assert {r.lang_pred for r in language.identify(docs, single).collect()} == {"en", "und"}
    assert language.identify(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 9])
def test_codewords(n):
    code = language.code_of(n)
    assert len({tuple(c) for c in code}) == n and all(abs(c.sum()) < n for c in code.T)


def plain_spans(t: str) -> dict[str, list[tuple[int, int]]]:
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    match = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    check = {
        "email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), "phone": lambda s: 9 <= len(digits(s)) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, t) if check[k](m[0])] for k, p in match.items()}


@pytest.fixture(scope="module")
def private(spark):
    rng = random.Random(3)
    parts = ["a", "b@c", "@", "x.y", " ", ".", "-", "+", "1", "22", "4111111111111111", "4111 1111-1111 1111", "255", "256", "1.2.3.4", "(", ")", "é", "\n", "_d@e.f", "+1 (017) 555-7713", "tel 555-123-4567 ", "j (at) m dot com", "0.00.1.0255", "1.2.3.4.5.6.7.8"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(3000)] + ["1.2.3.4 " * 1500, "+1" + "(" * 30_000 + "234567890"]
    return spark.createDataFrame(list(enumerate(texts, 1000)), "doc_id long, text string")


def test_pii(docs, texts, private):
    model = pii.fit(private)
    assert set(model.threshold) >= {1, 3}
    every = docs.select("doc_id", "text").unionByName(private)
    found = [tuple(r) for r in pii.measure(every, model).collect()]
    base = {}
    for i, t in [tuple(r) for r in every.collect()]:
        spans = plain_spans(t or "")
        named = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in spans[k]]
        base.setdefault(i, []).append((*(len(spans[k]) for k in pii.KINDS), sha(",".join(named)), set(named)))
    assert len(found) == every.count()
    for i, *counts, digest, spans in found:
        assert any((*counts, digest) == x[:-1] and x[-1] <= set(filter(None, spans.split(","))) for x in base[i]), i
    assert sum(len(list(filter(None, r[-1].split(",")))) > sum(r[1:5]) for r in found) > 100  # spans were added
    assert pii.measure(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def test_pii_adds_spelt_out_addresses_and_turns_down_by_context(spark):
    texts = []
    for i in range(300):
        texts.append(f"please contact u{i} (at) host{i} dot com for more, or u{i}@host{i}.org; card 4111.1111.1111.1111 ok")
        texts.append(f"mail u{i} at host{i}.net soon")
        texts += [f"we sat at table{i}.{x}" for x in ("top", "left", "x1")]  # no real end
        texts.append(f"lot {4000 + i}.1111.2222.{3000 + 7 * i} and 4111.1111.1111.1112 in stock")  # most fail their check
    texts += ["please contact eve (at) corp dot org for more", "mail eve at corp.org soon", "we sat at corp.org", "lot 4111.1111.1111.1111 in stock"]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.fit(given)
    assert "valid" not in pii.FEATURES and 0 in model.threshold
    got = {r.doc_id: set(filter(None, r.spans.split(","))) for r in pii.measure(given, model).collect()}
    last = [got[i] for i in range(len(texts) - 4, len(texts))]
    assert last[0] == {"email:15:36"} and last[1] == {"email:5:20"}
    assert last[2] == set() and last[3] == set()  # both pass their check
    assert any(s.startswith("card:") for s in got[0])


def test_redaction(spark):
    given = [(1, "ann@x.org or +1 (017) 555-7713, é 10.0.0.1.", 5, "row"), (2, None, None, None), (3, "", 0, ""), (4, "clean", 5, "x")]
    table = spark.createDataFrame(given, "doc_id long, text string, n_chars long, row string")
    out = pii.redact(table, pii.Model())
    assert out.columns == table.columns
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [
        (1, "[EMAIL] or [PHONE], é [IP].", 27, "row"), (2, None, None, None), (3, "", 0, ""), (4, "clean", 5, "x"),
    ]


def plain_contamination(docs, items):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    windows = {}
    for i, t in items:
        w = split(t)
        for j in range(len(w) - 9 if len(w) >= 10 else min(1, len(w))):
            windows.setdefault(tuple(w[j : j + 10]), set()).add(i)
    sizes = {len(w) for w in windows}
    for d, t in docs:
        w, hit, ids = split(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (k := tuple(w[j : j + n])) in windows:
                    hit.update(range(j, j + n))
                    ids |= windows[k]
        ids = sorted(str(i) for i in ids if i is not None)
        yield d, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)


@pytest.mark.parametrize("short", [False, True])
def test_decontamination(spark, docs, short):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    more = [(9001, "the"), (9002, "of THE and"), (9003, ""), (9004, None), (None, "word word"), (9001, "é É a b c d e f g h i j k")]
    items = items.unionByName(spark.createDataFrame(more if short else more[-1:], items.schema))
    passages = [(-20 - i, f"x {r.text} y") for i, r in enumerate(items.where("length(text) > 60").limit(3).collect())]
    odd = spark.createDataFrame([*passages, (-30, "é É a b c d e f g h i j"), (-31, "é é a b c d e f g h i j"), (-32, "of the and")], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(odd)
    want = sorted(plain_contamination([tuple(r) for r in every.collect()], [tuple(r) for r in items.collect()]), key=repr)
    assert rows(decontaminate.measure(every, items)) == want
    assert sum(r[-1] for r in want) >= 3
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    if not short:
        assert decontaminate.measure(docs.limit(0), items).count() == 0
        assert not any(r[-1] for r in rows(decontaminate.measure(docs, items.limit(0))))


@pytest.fixture(scope="module")
def plain_bpe():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_byte_bpe(docs, texts, plain_bpe):
    got = rows(byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN))
    want = []
    for i, t in texts:
        ids = plain_bpe(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t or "")))
    assert got == sorted(want, key=repr)
    assert byte_bpe.encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_on_odd_texts(plain_bpe, monkeypatch):
    rng = random.Random(5)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "ß", "<|endoftext|>", "12", "'s", "!!", "　", "\U0001f600", "\xa0", "\x85", "ab ab", "aaaa"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(3000)] + ["a" * 50_001, "ab" * 20_000 + "c", " " * 3000, "é" * 9999]
    own = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(byte_bpe, "MEMORY", 1000)  # forget often
    for a in range(0, len(texts), 50):
        for t, ids in zip(texts[a : a + 50], own.encode_all(texts[a : a + 50])):
            assert ids.tolist() == plain_bpe(t) and own.decode(ids) == t.encode()
    for m in {m for t in texts[:500] for m in own.split(t) if m.encode() not in own.ranks}:
        assert own.merge(m.encode()) == plain_bpe(m)  # entry by entry


def test_merges_that_make_a_lower_rank():
    """A vocabulary in which a merge yields a pair that comes before other merges of the same bucket."""
    ranks = {bytes([c]): i for i, c in enumerate(b"abcd")} | {b"bc": 4, b"abcd": 5, b"ab": 6, b"cd": 7, b"abab": 8}
    own = byte_bpe.Codec(ranks, r"\w+")

    def plain(p):
        parts = [p[i : i + 1] for i in range(len(p))]
        while found := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[x] for x in parts]

    words = ["".join(w).encode() for n in range(2, 7) for w in itertools.product("abcd", repeat=n)]
    for w, ids in zip(words, own.merge_all(words)):
        assert ids.tolist() == plain(w) == own.merge(w)


def test_rank_queue():
    queue, rng, held = byte_bpe.RankQueue(70_000), random.Random(1), []
    for _ in range(3000):
        if held and rng.random() < 0.4:
            assert queue.pop() == held.pop(held.index(min(held)))
        else:
            held.append((rng.randrange(70_000), rng.randrange(10**6)))
            queue.push(*held[-1])
    assert [queue.pop() for _ in held] == sorted(held) and queue.pop() == (-1, -1)


def common(a, b):
    """Longest common sequence, plainly."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def told(texts):
    return near_duplicates.words(*terms.buffer_of(pa.array([t or "" for t in texts])))


def closure(n, pairs):
    top = list(range(n))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in pairs:
        a, b = sorted((find(i), find(j)))
        top[b] = a
    return [find(i) for i in range(n)]


def judged(texts):
    """(classes that must be found, classes that may be found) of all pairs."""
    own = told(texts)
    grams = [near_duplicates.shingles_of(x) for x in own]
    must, may = [], []
    for i, j in itertools.combinations(range(len(texts)), 2):
        if (texts[i] or "") == (texts[j] or ""):
            must.append((i, j))
        elif near_duplicates.alike(own[i], own[j]):
            may.append((i, j))
            if len(np.intersect1d(grams[i], grams[j])) >= near_duplicates.OVERLAP * max(len(grams[i]), len(grams[j])) - 1e-6:
                must.append((i, j))
    return closure(len(texts), must), closure(len(texts), must + may)


def assert_between(found, must, may):
    """All that must be linked is, and nothing is that may not be."""
    for i in range(len(found)):
        assert found[i] == found[must[i]] and may[found[i]] == may[i], i


def test_near_duplicates(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([6, 40, 200, 600]))] for _ in range(25)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(rng.randrange(5)):
            copy = list(b)
            for _ in range(max(1, len(b) // rng.choice([20, 60, 200]))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
        texts.append(" ".join(b[len(b) // 2 :] + b[: len(b) // 2]))  # same shingles in another order
    texts += [" ".join([rng.choice(vocabulary) for _ in range(30)] + passage) for _ in range(40)]
    texts += [" ".join([rng.choice(vocabulary) for _ in range(n)] + passage) for n in range(8, 24)] + texts[:5]
    texts += ["", "", None, "!!", "??", "one", "One!", "z " * 3000, "z " * 2990]
    must, may = judged(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = {r.doc_id: r for r in near_duplicates.group(table).collect()}
    found = [made[i].class_id for i in range(len(texts))]
    assert_between(found, must, may)
    assert all(made[i].class_size == found.count(found[i]) and found[i] <= i for i in range(len(texts)))
    assert len(set(found)) < len(texts) - 20
    wide = table.selectExpr("*", "text AS key", "doc_id AS root", "1 AS row", "2 AS bucket", "3 AS other", "4 AS size")
    kept = near_duplicates.keep_one(wide)
    assert kept.columns == wide.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(found))
    assert near_duplicates.group(table.limit(0)).count() == 0
    odd = spark.createDataFrame([(i if i % 3 else None, texts[0]) for i in range(9)] + [(None, "alone")], "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS root")
    assert Counter(tuple(r) for r in near_duplicates.group(odd).collect()) == Counter([(i if i % 3 else None, 1, 9) for i in range(9)] + [(None, None, 1)])


def test_near_copies_of_short_texts(spark):
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(12)]
    texts = []
    for n in [*range(5, 26), 40, 63, 64, 66] * 3:
        own = [f"w{rng.randrange(10**6)}" for _ in range(n)] + rng.choice([[], passage])
        for words in (own, ["new", *own], [*own, "new"], ["new", *own[1:]], [*own[:-1], "new"], [*own[: n // 2], "new", *own[n // 2 :]]):
            texts.append(" ".join(words))
    must, may = judged(texts)
    made = {r.doc_id: r.class_id for r in near_duplicates.group(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert_between([made[i] for i in range(len(texts))], must, may)
    assert sum(must[i] != i for i in range(len(texts))) > 200


def test_passage_that_fills_most_of_many_texts(spark):
    """Texts that share four fifths, a little more or a little less, each with words of its own."""
    rng = random.Random(9)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(200)]
    texts = [" ".join(passage[: rng.choice([200, 199])] + [f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(30, 75))]) for _ in range(260)]
    must, may = judged(texts)
    made = {r.doc_id: r.class_id for r in near_duplicates.group(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert_between([made[i] for i in range(len(texts))], must, may)
    assert len(set(must)) > 20


@pytest.mark.parametrize("least", [0.8, 0.9])
def test_recall_against_word_alignment_on_supplied_texts(spark, least):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    some = {}
    for i, t in table.collect():
        some.setdefault(t or "", i)
    texts, ids = list(some), list(some.values())
    own = told(texts)
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if near_duplicates.alike(own[i], own[j], least)]
    made = {r.doc_id: r.class_id for r in near_duplicates.group(table).collect()}
    caught = [(i, j) for i, j in pairs if made[ids[i]] == made[ids[j]]]
    assert len(pairs) >= 50 and len(caught) >= 0.9 * len(pairs), (len(caught), len(pairs))


@pytest.mark.parametrize(("size", "share"), [(90, 0.06), (90, 0.1), (700, 0.05), (700, 0.08)])
def test_recall_of_scattered_changes(spark, size, share):
    """Pairs by length and share of changed words; what sketches miss is stated in the module."""
    rng = random.Random(size)
    texts = []
    for _ in range(150):
        own = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        other = list(own)
        for i in rng.sample(range(size), round(share * size)):
            other[i] = f"n{rng.randrange(10**6)}"
        texts += [" ".join(own), " ".join(other)]
    made = {r.doc_id: r.class_id for r in near_duplicates.group(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(made[i] == made[i + 1] for i in range(0, len(texts), 2)) >= 0.9 * len(texts) / 2


def test_alignment_equals_the_plain_one():
    rng = random.Random(4)
    for _ in range(600):
        size = rng.choice([6, 60, 1000])
        a = [rng.randrange(size) for _ in range(rng.randrange(0, 60))]
        b = [x for x in a if rng.random() > rng.choice([0, 0.05, 0.2])]
        for _ in range(rng.randrange(8)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(size))
        if rng.random() < 0.3:
            i = rng.randrange(len(b) + 1)
            b = b[i:] + b[:i]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        want = common(a, b)
        assert near_duplicates.aligned(x, y, max(len(a), len(b))) == want
        for least in (0.5, 0.8, 0.95):
            assert near_duplicates.alike(x, y, least) == bool(a and b and want >= least * max(len(a), len(b)) - 1e-6)


def test_token_files(spark, docs, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(-40, "a <|endoftext|> B<|ENDOFTEXT|>c"), (-41, "Don't. It's, 'twas ΣΑΣ ²,. a\x1cb\x85c ÀÉ!!"), (-40, "x")], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(extra)
    known = {}
    for i, t in [tuple(r) for r in every.collect()]:
        ids = own.encode(t or "", add_special_tokens=False).ids + [1]
        known.setdefault(i, []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    got = sorted((tuple(r) for r in token_files.store(every, path, 1).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, ts in known.items() if i is not None for _ in ts)) + [None] * len(known[None])
    total = 0
    for _, start, n, _ in got:
        assert start == total
        total += n
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted((i, *x) for i, ts in known.items() if i is not None for x in ts)
    assert sorted((r[2], r[3]) for r in got if r[0] is None) == sorted(known[None])
    assert token_files.store(docs.limit(0), path, 1).count() == 0


def test_shard_image():
    import zstandard

    frames = [np.arange(n, dtype="<u2").tobytes() for n in (0, 5, 70)]
    dictionary = b""
    small = [zstandard.ZstdCompressor().compress(f) for f in frames]
    image = token_files.pack([3, None, 9], [0, 5, 70], small, 2, hashlib.sha256(dictionary).digest())
    shard = token_files.Shard(image, dictionary)
    assert [shard.ids(i).tolist() for i in range(3)] == [list(range(n)) for n in (0, 5, 70)]
    with pytest.raises(ValueError):
        token_files.Shard(image, b"another")


def test_fingerprints(spark, docs, texts):
    got = [tuple(r) for r in fingerprints.edit_and_compare(docs).collect()]
    assert len(got) == len(texts)
    unique = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string").repartition(7)
    got = sorted((tuple(r) for r in fingerprints.edit_and_compare(unique).collect()), reverse=True)
    order = [t or "" for _, t in reversed(texts)]
    prints = [p.tobytes().hex() for p in fingerprints.fingerprint_texts(order)]
    for i, (doc_id, n, edited, own, new, near, following) in enumerate(got):
        changed = fingerprints.edited(order[i], order[(i + 1) % len(order)])
        assert (doc_id, n, edited, own) == (len(order) - 1 - i, len(order[i]), sha(changed), prints[i])
        assert new == fingerprints.fingerprint_texts([changed])[0].tobytes().hex()
        different = [bin(int(own, 16) ^ int(x, 16)).count("1") for x in (new, prints[(i + 1) % len(order)])]
        assert [near, following] == [1 - d / fingerprints.BITS for d in different]
    assert fingerprints.edit_and_compare(docs.limit(0)).count() == 0
    assert fingerprints.edited("abcdefg", "XYZ") == "abcdeXY" and fingerprints.edited("abcdefg", "X") == "abcdeX"


def test_search_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 256, (12, 16), dtype=np.uint8)
    prints = [b.tobytes() for b in base]
    for b in base:
        for flips in range(8):
            bits = np.unpackbits(b)
            bits[rng.choice(128, flips, replace=False)] ^= 1
            prints.append(np.packbits(bits).tobytes())
    table = spark.createDataFrame([(i if i % 41 else None, p.hex()) for i, p in enumerate(prints)], "doc_id long, fingerprint string")
    number = [int(p.hex(), 16) for p in prints]
    want = {i: sum(bin(number[i] ^ x).count("1") <= fingerprints.RADIUS for x in number) for i in range(len(prints)) if i % 20 == 0 and i % 41}
    got = fingerprints.search(table).collect()
    assert len(got) == len(prints)
    assert {r.doc_id: r.n_near for r in got if r.n_near is not None} == want


def test_search_reaches_distance_six(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, (12, 16), dtype=np.uint8)
    base[0], base[1] = 0, 255
    prints, planted = [], []
    for b in base:
        for flips in range(12):
            for spread in (range(128), range(30, 66), [7, 8, 40, 41, 70, 71, 100, 101, 9, 42, 72, 102]):  # anywhere; in two blocks; dealt over all blocks
                bits = np.unpackbits(b)
                bits[rng.choice(spread, flips, replace=False)] ^= 1
                prints.append(np.packbits(bits).tobytes())
                planted.append(flips)
    table = spark.createDataFrame([(i, p.hex()) for i, p in enumerate(prints)], "doc_id long, fingerprint string")
    number = [int(p.hex(), 16) for p in prints]
    apart = lambda a, b: bin(a ^ b).count("1")
    want = {i: sum(apart(number[i], x) <= 6 for x in number) for i in range(0, len(prints), 20)}
    assert {r.doc_id: r.n_near for r in fingerprints.search(table).collect() if r.n_near is not None} == want
    assert {4, 5, 6} <= {apart(number[i], x) for i in want for x in number}
    asked = table.where("doc_id % 20 = 0")
    for radius, blocks in ((6, 4), (3, 4), (2, 4), (6, 8), (9, 4)):
        pairs = sorted((p.hex(), q.hex()) for p in {prints[i] for i in want} for q in set(prints) if apart(int(p.hex(), 16), int(q.hex(), 16)) <= radius)
        assert sorted((r.query, r.fingerprint) for r in fingerprints.within_radius(table, asked, radius, blocks).collect()) == pairs


def test_quality(spark, docs):
    from pyspark.sql import functions as F

    full = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit(full, labels)
    judged = quality.classify(full, model).join(labels, "doc_id").where("held_out")
    right = judged.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right")).collect()
    assert all(r.right > 0.95 for r in right)
    got = {r.doc_id: r for r in quality.classify(docs, model).collect()}
    assert quality.classify(docs, model).count() == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values()) and got[-1].score == got[-2].score
    assert quality.keep_good(docs, model).columns == docs.columns
    none = quality.fit(full.limit(0), labels.limit(0))
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1), (0, None), (0, 1), (0, 0)], "doc_id long, quality int")
    assert quality.classify(docs, quality.fit(docs, odd)).count() == docs.count()


def test_shards_of_labelled_rows_are_bounded_and_averaged(spark, monkeypatch):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    own = [(i, f"{'good' if i % 2 else 'bad'} text {i}") for i in range(200)]
    hot = next(i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1)
    once = spark.createDataFrame(own, "doc_id long, text string")
    often = once.unionByName(once.where(f"doc_id = {hot}").crossJoin(spark.range(2000)).select("doc_id", "text"))
    a, b = quality.fit(once, labels), quality.fit(often, labels)
    assert (a.weights == b.weights).all() and a.bias == b.bias
    seen = []
    sample = quality.bounded_sample
    monkeypatch.setattr(quality, "bounded_sample", lambda df, *rest: seen.append(sample(df, *rest)) or seen[-1])
    many = once.unionByName(spark.range(5000).selectExpr(f"{hot}L AS doc_id", "concat('text no ', id) AS text"))
    quality.fit(many, labels, rows=150)
    assert seen[-1].count() < 300  # one id with 5,000 texts
    few = labels.where(f"doc_id = {hot}")
    alone, spread = quality.fit(once, few, shards=1), quality.fit(once, few, shards=4)
    assert (alone.weights == spread.weights).all() and alone.bias == spread.bias  # empty shards do not count


def test_url_filters_with_times_far_apart(spark, monkeypatch):
    from datetime import datetime

    entries = spark.createDataFrame(
        [("spam", "host", f"h{i}.org", "add", datetime(2023, 1, 1 + i % 28)) for i in range(100)]
        + [("old", "host", "h0.org", "add", datetime(1, 1, 1)), ("old", "host", "h0.org", "remove", datetime(9999, 12, 31)), ("late", "domain", "org", "add", datetime(9999, 12, 1))],
        "list string, kind string, pattern string, action string, at timestamp",
    )
    times = [datetime(1, 1, 1), datetime(1, 2, 1), datetime(2023, 1, 1), datetime(9999, 12, 1), datetime(9999, 12, 31, 12)]
    captures = spark.createDataFrame([(i, "http://h0.org/", t) for i, t in enumerate(times)] + [(9, "http://h5.org/", times[3])], "id long, url string, fetched_at timestamp")
    sizes = []
    monkeypatch.setattr(url_filters, "written", lambda df, name: sizes.append((name, df.count())) or df)
    assert rows(url_filters.judge(captures, entries)) == [
        (0, True, 1, "old"), (1, True, 1, "old"), (2, True, 2, "old,spam"), (3, True, 3, "late,old,spam"), (4, True, 2, "late,spam"), (9, True, 2, "late,spam"),
    ]
    assert dict(sizes)["intervals"] <= 103 + 2 * captures.count() + 3


def test_dictionary_learns_from_whole_arrays(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = np.arange(50_000, dtype="<u2").tobytes()
    cut = token_files.spread(ids, 2)
    assert len(cut) == token_files.SAMPLE_BYTES and cut[:2] == ids[:2] and cut[-2:] == ids[-2:] and token_files.spread(ids[:100], 2) == ids[:100]
    at = np.frombuffer(cut, "<u2")
    assert (np.diff(at) > 0).all() and (np.diff(at) > 1).sum() == token_files.SLICES - 1
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = full.unionByName(full.limit(1).crossJoin(spark.range(3000)).select(full.columns))
    first = token_files.train(full, path, 1, 300)
    assert first and first == token_files.train(full.repartition(7), path, 1, 300)  # no order of rows decides
    assert token_files.train(hot, path, 1, 300)


def test_token_files_of_another_tokenizer(spark, docs, tmp_path):
    import json

    from tokenizers import Tokenizer

    dealt = json.loads(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    assert token_files.by_chunks(dealt)
    cased = json.loads(json.dumps(dealt))
    cased["normalizer"]["normalizers"].pop()  # no lower-casing
    marked = json.loads(json.dumps(dealt))
    marked["added_tokens"][0]["content"] = "[START]"
    odd = [(-51, "Don't SHOUT, [START] it's  fine.\n"), (-52, None), (-53, ""), (-54, "ÀÉ <|endoftext|> B")]
    table = spark.createDataFrame(odd, "doc_id long, text string").unionByName(docs.select("doc_id", "text").where("doc_id > 0").limit(30))
    paths = [public_tokenizers.path("byte_bpe_50k.json")]
    for name, own in (("cased", cased), ("marked", marked)):
        assert not token_files.by_chunks(own)
        paths.append(str(tmp_path / f"{name}.json"))
        (tmp_path / f"{name}.json").write_text(json.dumps(own))
    for path in paths:
        own = Tokenizer.from_file(path)
        got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_files.store(table, path, 1).collect()}
        for i, t in map(tuple, table.collect()):
            ids = own.encode(t or "", add_special_tokens=False).ids + [1]
            assert got[i] == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))), (path, i)
