"""Substring dedup, decontamination, sharding, PII, quality and line dedup against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import words

from playback_qos.llm import pii
from playback_qos.llm.common import table
from playback_qos.llm.decontaminate import decontaminate, phrases, search
from playback_qos.llm.line_dedup import drop_boilerplate
from playback_qos.llm.quality import fit_weights, quality
from playback_qos.llm.sharding import rendezvous, shard_documents
from playback_qos.llm.substring_dedup import remove_repeated_windows

SF = "/root/testdata/sf0.001"


def plain_substring(pairs, width=13):
    last = float("inf")
    starts = defaultdict(lambda: last)
    split = [(last if i is None else i, words(t)) for i, t in pairs]
    for i, w in split:
        for k in range(len(w) - width + 1):
            q = tuple(w[k : k + width])
            starts[q] = min(starts[q], i)
    out = []
    for (i, w), (key, _) in zip(split, pairs):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if starts[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((key, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("sizes", [(4 << 20, 16 << 20), (30_000, 50_000)])
def test_substring_dedup(docs, odd, empty, sizes):
    for table_ in (docs, odd, empty):
        got = remove_repeated_windows(table_, block_bytes=sizes[0], range_bytes=sizes[1]).collect()
        want = plain_substring([(r.doc_id, r.text) for r in table_.collect()])
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
        for r in got:
            assert sum(s.end - s.start for s in r.removed) == r.n_removed
            assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


def low_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain_hits(texts, items, width=13):
    found = defaultdict(set)
    for name, t in items:
        w = low_words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            found[tuple(w[k : k + width])].add(str(name))
    lengths = {len(q) for q in found}
    for t in texts:
        w, hit, names = low_words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if q := found.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    names |= q
        yield len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("query_bytes", [8 << 20, 2000])
def test_decontamination(spark, docs, odd, empty, query_bytes):
    bench = table(spark, SF, "benchmark")
    extra = spark.createDataFrame([(901, "One, TWO"), (902, None), (903, "..."), (901, "word3 word4")], "item_id long, text string")
    items = bench.select("item_id", "text").union(extra)
    plain = [(r.item_id, r.text) for r in items.collect()]
    for table_ in (docs, odd, empty):
        rows = table_.collect()
        got = decontaminate(table_, items, query_bytes=query_bytes).collect()
        want = Counter((r.doc_id, n, h, ",".join(x), c) for r, (n, h, x, c) in zip(rows, plain_hits([r.text for r in rows], plain)))
        assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got) == want


def test_proximity_and_no_benchmark(spark, odd):
    texts = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "gamma beta alpha")], "doc_id long, text string")
    query = phrases(spark.createDataFrame([("q", "alpha beta gamma")], "id string, text string").toArrow())
    near = {r.key for r in search(texts, query, slop=1).collect() if r["items"]}
    exact = {r.key for r in search(texts, query).collect() if r["items"]}
    assert (exact, near) == ({2}, {1, 2})
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated or r.n_hit for r in decontaminate(odd, none).collect())


def test_sharding(spark, docs, odd, empty):
    assert shard_documents(empty).count() == 0
    for table_ in (docs, odd):
        rows = shard_documents(table_).collect()
        assert Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in table_.collect()) == Counter(
            (r.doc_id, r["size"], r.text_crc32) for r in rows
        )
        assert all(r.grown_shard in (r.shard, 40) for r in rows)
        by = defaultdict(list)
        for r in rows:
            by[r.shard].append(r.slot)
        assert all(sorted(x) == list(range(len(x))) for x in by.values())
        keys = defaultdict(set)
        for r in rows:
            keys[r.doc_id].add(r.shard)
        assert all(len(x) == 1 for x in keys.values())
    ids = spark.range(6000)
    light = ids.select("id", rendezvous(ids.id, [1.0, 2.0, 1.0]).alias("a"), rendezvous(ids.id, [1.0, 2.0, 1.0, 4.0]).alias("b")).collect()
    assert all(r.b in (r.a, 3) for r in light)
    n = Counter(r.a for r in light)
    assert abs(n[1] / 6000 - 0.5) < 0.03 and abs(n[0] / 6000 - 0.25) < 0.03


def test_sharding_of_hot_keys(spark):
    n = 75_000  # a third is one row, a third has no key
    docs = spark.range(n).selectExpr(
        "CASE id % 3 WHEN 0 THEN 5 WHEN 2 THEN id END AS doc_id",
        "CASE WHEN id % 3 > 0 THEN repeat('x', int(id % 97)) || id END AS text",
    )
    rows = shard_documents(docs, 7).collect()
    assert len(rows) == n

    def place(r):
        bucket = hashlib.md5(b"" if r.doc_id is None else str(r.doc_id).encode()).hexdigest()[:2]
        return r.shard, bucket, (r.doc_id is not None, r.doc_id), r.size, r.text_crc32

    for shard in range(7):
        own = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [place(r) for r in own] == sorted(map(place, own))
    told = Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    texts = (("x" * (i % 97) + str(i)).encode() if i % 3 else b"" for i in range(n))
    keys = ((5, None, i)[i % 3] for i in range(n))
    assert told == Counter((k, len(t) + 16, zlib.crc32(t)) for k, t in zip(keys, texts, strict=True))



def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_pii(t):
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )
    for kind, pattern in kinds:
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                yield kind, m.start(), m.end()


TRICKY = [
    "a@b.c_d@e.f x@y a@b..c é日a.b@c.d.e.f😀 me@x.yz",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 1..2.3.4.5 00000000000000000000000000000000000000001.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 5 1" + "0" * 15,
    "+1 (234) 567-8901 ++12 345 67890 +1 2 +123456789012345678 +1 234 567 890 ---",
    "a" * 3000 + "@" + "b." * 3000 + "c " + "1 " * 3000,
]


def test_pii(spark, docs, odd, empty):
    assert pii.sanitise(empty).count() == 0
    tricky = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    for table_ in (docs, odd.select("doc_id", "text"), tricky):
        got = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind != "term")) for r in pii.sanitise(table_).collect())
        assert got == Counter((r.doc_id, tuple(plain_pii(r.text or ""))) for r in table_.collect())


def test_pii_terms(spark):
    texts = [(i, f"write to Zorblat at boss@corp.org today number {i}") for i in range(4)]
    texts += [(10 + i, f"today write number {i} to nobody and nothing") for i in range(30)]
    table_ = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.sanitise(table_).collect()}
    for i, t in texts[:4]:
        terms = {t[s.start : s.end]: s.action for s in found[i] if s.kind == "term"}
        assert terms == {"Zorblat": "remove"}
    assert not any(found[i] for i, _ in texts[4:])
    from pyspark.sql import functions as F

    joined = table_.join(pii.sanitise(table_), "doc_id").select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("r")).collect()
    assert {r.doc_id: r.r for r in joined}[0] == "write to  at <EMAIL> today number 0"


def test_pii_terms_anywhere_in_the_text(spark):
    far = " common words of the text" * 10
    texts = [(i, f"Zorblat and Bo, 李{far} {i} boss@corp.org xboss") for i in range(4)]
    texts += [(4, f"a text{far} on Zorblat, Bo 😀 and 李 alone, Zorblat")]
    texts += [(10 + i, f"and a text on{far} alone xboss {i}") for i in range(30)]
    table_ = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.sanitise(table_).collect()}
    for i, t in texts[:5]:
        terms = [(t[s.start : s.end], s.action) for s in found[i] if s.kind == "term"]
        assert terms == [(x, "generalise") for x in ("Zorblat", "Bo", "李", "Zorblat")[: 3 if i < 4 else 4]]
    assert not any(found[i] for i, _ in texts[5:])


def test_pii_mutual_information(spark):
    """Against plain counting over all pairs: random documents with shared, rare and repeated terms and entities."""
    import math
    import random

    r = random.Random(12)
    names = [f"Na{a}{b}e" for a in "bcdfg" for b in "klmnp"]
    rows = []
    for i in range(150):
        who = r.randrange(6)
        entity = [f"p{who}@x.org"] * (r.random() < 0.7) + [f"q{r.randrange(40)}@y.org"] * (r.random() < 0.3)
        terms = r.sample(names[4 * who : 4 * who + 4], 2) + r.sample(names, 2) + ["common", "words"]
        rows.append((i, " ".join(r.sample(terms + entity + entity[:1], len(terms) + len(entity) + len(entity[:1])))))
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    docs_ = [({w.lower() for w in t.split() if "@" not in w}, {"email:" + w for w in t.split() if "@" in w}) for _, t in rows]
    for generalise, support in ((0.75, 3), (0.3, 2), (0.05, 1)):
        n_t, n_e = Counter(w for ws, _ in docs_ for w in ws), Counter(e for _, es in docs_ for e in es)
        want = {}
        for t in n_t:
            for e in n_e:
                n = sum(t in ws and e in es for ws, es in docs_)
                if n >= support:
                    d = math.log2(len(rows) * n / (n_t[t] * n_e[e])) / math.log2(len(rows) / n_e[e])
                    if d >= generalise:
                        want[t, e] = (pytest.approx(d), "remove" if d >= 0.9 else "generalise")
        got = pii.disclosing_terms(found, generalise=generalise, min_support=support).collect()
        assert {(x.term, x.entity): (x.disclosure, x.action) for x in got} == want and len(got) == len(want) > 0


def test_pii_of_a_text_with_very_many_matches(spark):
    """Positions, masks and terms of 20,000 spans in one text, in time that grows with it."""
    import time

    parts = [f"Käthe a{i}@b.co ü 1.2.3.{i % 300} +1 234 567 {i:04d}" for i in range(7100)]
    text = " ".join(parts)
    df = spark.createDataFrame([(1, text), (2, " ".join(parts[:3])), (3, " ".join(parts[5:8]))], "doc_id long, text string")
    began = time.monotonic()
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.sanitise(df, min_support=2).collect()}
    assert time.monotonic() - began < 120
    base = [x for x in got[1] if x[0] != "term"]
    assert base == list(plain_pii(text)) and len(base) > 20_000
    assert [text[a:b] for k, a, b in got[1] if k == "term"] in ([], ["Käthe"] * 7100)


def plain_quality(t):
    w = words(t)
    trigrams = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for k in range(len(w) - 2):
        if trigrams[tuple(w[k : k + 3])] > 1:
            hit.update((k, k + 1, k + 2))
    lines = [x for x in (t or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))


def test_quality(spark, docs, odd, empty):
    labels = table(spark, SF, "labels")
    weights = fit_weights(docs, labels)
    assert quality(empty, weights).count() == 0
    assert not fit_weights(empty, labels).any() and not fit_weights(docs, labels.limit(0)).any()
    for table_ in (docs, odd):
        got = quality(table_, weights).collect()
        want = Counter((r.doc_id, *plain_quality(r.text)) for r in table_.collect())
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed and r.log_ratio >= -0.15)
    judged = quality(docs, weights).join(labels, "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1 and r.toxic == 0 and not r.base_failed]
    bad = [r.kept for r in judged if r.quality == 0]
    assert np.mean(good) > 0.97 and (not bad or np.mean(bad) < 0.3)


def test_line_dedup(docs, odd, empty):
    assert drop_boilerplate(empty).count() == 0
    for table_ in (docs, odd):
        rows = table_.collect()
        total, held = Counter(r.source for r in rows), Counter()
        for r in rows:
            held.update((r.source, x) for x in set((r.text or "").split("\n")) if words(x))
        want = Counter()
        for r in rows:
            lines = r.text.split("\n") if r.text is not None else []
            kept = [x for x in lines if not (held[r.source, x] >= 3 and held[r.source, x] > 0.1 * total[r.source])]
            want[r.doc_id, r.source, None if r.text is None else "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
        got = drop_boilerplate(table_)
        assert set(got.columns) == {*table_.columns, "n_lines", "n_dropped"}
        assert Counter((r.doc_id, r.source, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == want


