"""Jaccard join, WARC, language id, SentencePiece and the pipeline."""

import io
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest
import sentencepiece
import zstandard
from conftest import words
from pyspark.sql import functions as F

import corpus_pipeline
from playback_qos.llm import jaccard_join, language_id, warc
from playback_qos.llm.bpe import Encoder, encode_documents
from playback_qos.llm.common import scratch_dir, table, written
from playback_qos.llm.components import components, joined
from playback_qos.llm.language_id import held_out, identify, train
from playback_qos.llm.queries import piece_model_path

SF = "/root/testdata/sf0.001"


def plain_groups(pairs):
    """For each row its least linked key and number of links, by comparing all sets with a common shingle."""
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := words(t)) else frozenset() for _, t in pairs]
    posting, common = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for q in s:
            posting[q].append(i)
    for x in posting.values():
        common.update(combinations(x, 2))
    up = list(range(len(pairs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    n = Counter()
    for (a, b), c in common.items():
        if 5 * c >= 4 * (len(sets[a]) + len(sets[b]) - c):
            n.update((a, b))
            up[top(a)] = top(b)
    least = {}
    for i, (key, _) in enumerate(pairs):
        t = top(i)
        least[t] = key if least.get(t) is None else least[t] if key is None else min(least[t], key)
    return [(key, least[top(i)], n[i]) for i, (key, _) in enumerate(pairs)]


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_join(docs, odd, small, monkeypatch):
    options = {}
    if small:  # deep trees, and parts in several blocks
        options = {"bucket": 4, "block": 3}
    for table_ in (docs, odd):
        rows = [(r.doc_id, r.text) for r in table_.collect()]
        found = jaccard_join.near_duplicates(table_, **options)
        assert Counter((r.doc_id, r.group_id, r.n_links) for r in found.collect()) == Counter(plain_groups(rows))
        if small:
            continue
        kept = jaccard_join.keep_one(table_, **options).collect()
        groups = {g for (_, g, _), (_, t) in zip(plain_groups(rows), rows) if words(t)}
        blank = sum(not words(t) for _, t in rows)
        assert len(kept) == len(groups) + blank
        assert set(kept[0].asDict()) == set(table_.columns)


def test_jaccard_empty(empty):
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.keep_one(empty).count() == 0


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    edges += [(7, 7), (300, 301), (301, 300)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    assert got == {i: top(i) for i in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    # some edges first, the rest by the parts they gave: chains of parts, new nodes alone and on parts
    first, rest = [e for i, e in enumerate(edges) if i % 3], edges[::3]
    parts = written(components(spark.createDataFrame(first, "a long, b long")))
    root = {x.node: x.root for x in parts.collect()}
    more = spark.createDataFrame([(root.get(a, a), root.get(b, b)) for a, b in rest], "a long, b long")
    both = joined(parts, more).collect()
    assert {x.node: x.root for x in both} == got and len(both) == len(got)
    assert joined(parts, more.limit(0)).count() == len(root)


def test_warc_roundtrip(spark):
    pages = [(i, f"http://h/{i}\r\nX: y" if i % 7 else None, "x" * (i % 150) if i % 5 else None) for i in range(400)]
    pages += [(None, None, "y" * 200), (500, "u", "y" * 200), (500, "u", "y" * 200), (501, "u", "y" * 200), (502, "ü", "é" * 500_000)]
    table_ = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    folder = scratch_dir(spark)
    archives = warc.write_archives(table_, folder, archive_bytes=3000)
    got = warc.read_archives(archives).collect()
    first = {}
    for i, _, h in pages:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    count = Counter((h or "").encode() for _, _, h in pages)
    want = Counter()
    for i, _, h in pages:
        b = (h or "").encode()
        twin = first.get(b) if count[b] > 1 else None
        revisit = twin is not None and twin != i
        want[i, len(b), "revisit" if revisit else "response", twin if revisit else None, None if revisit else b] += 1
    assert Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want
    assert archives.count() > 3 and sum(r.n_records for r in archives.collect()) == len(pages)
    assert warc.roundtrip(table_.limit(0)).count() == 0


def test_warc_damage():
    good = warc.record(5, "u", b"payload " * 30, __import__("hashlib").sha256(b"payload " * 30).hexdigest(), None, "1970-01-01T00:00:00Z")
    assert warc.parse(good)["payload"] == b"payload " * 30
    for old, new in ((b"WARC/1.1", b"WARC/0.9"), (b"payload p", b"qayload p"), (b"WARC-Date", b"WARC-Dote"), (b"Content-Length: ", b"Content-Length: 1"), (b"\r\n\r\n", b"\r\n")):
        with pytest.raises(warc.WarcError):
            warc.parse(good.replace(old, new, 1))
    with pytest.raises(warc.WarcError):
        warc.parse(good + b"more")
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(good)
    assert list(warc.frames(io.BytesIO(frame * 3))) == [good] * 3
    for raw in (frame[:-3], b"junkjunkjunk", frame[:40] + b"\xff\xff" + frame[42:]):
        with pytest.raises(warc.WarcError):
            list(warc.frames(io.BytesIO(raw)))


def test_language_id(spark, odd, empty):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    assert model.langs == ["de", "en", "es", "fr"]
    rows = identify(docs, model, keep=["doc_id", "lang"]).filter(held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert not any(r.rejected for r in rows) and all(0 <= r.score <= 1 for r in rows)
    got = identify(odd, model).collect()
    assert len(got) == odd.count() and set(odd.columns) < set(got[0].asDict())
    for r in got:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter) and (letter or (r.rejected and r.score == 0))
    foreign = spark.createDataFrame([(1, "хорошо жить на свете " * 20)], "doc_id long, text string")
    assert identify(foreign, model).first().rejected
    bare = train(empty)
    assert bare.langs == [] and {r.lang_pred for r in identify(odd, bare).collect()} == {"und"}
    # probabilities after a context add up to one, with the unseen share
    import numpy as np

    top = model.levels[0]
    total = np.exp(top.logp).sum(axis=0) + np.exp(model.unseen)
    assert np.allclose(total, 1)


def test_language_id_rare_and_unlearned(spark):
    r = random.Random(11)
    latin = {x: ["".join(r.choice(a) for _ in range(r.randint(2, 7))) for _ in range(60)] for x, a in (("aa", "aeiourstln"), ("bb", "aeouhkmpvw"))}
    han = [chr(0x4E00 + i) for i in range(500)]

    def text(x):
        return "".join(r.choices(han, k=150)) if x == "zh" else " ".join(r.choices(latin[x], k=60))

    names = ["aa"] * 150 + ["bb"] * 150 + ["zh"] * 12
    docs = spark.createDataFrame([(i, text(x), x) for i, x in enumerate(names)], "doc_id long, text string, lang string")
    model = train(docs)
    assert model.limit["zh"][0] > model.limit["aa"][0] + 1  # its own mean, not the pool's
    new = spark.createDataFrame([(i, text(x), x) for i, x in enumerate(["aa", "bb", "zh"] * 10)], docs.schema)
    assert all(x.lang_pred == x.lang and not x.rejected for x in identify(new, model).collect())
    foreign = ["kysymys on siitä että minä en ole käynyt siellä " * 4, "dlaczego nie przyszedłeś wczoraj do mojego domu " * 4]
    assert all(x.rejected for x in identify(spark.createDataFrame([(1, t) for t in foreign], "doc_id long, text string"), model).collect())


def test_language_id_stored_model_is_the_same(spark, docs, odd, monkeypatch):
    named = docs.select("doc_id", "text", "lang").union(odd.select("doc_id", "text", "lang"))
    held = train(docs)
    monkeypatch.setattr(language_id, "MAX_GRAMS", 100)
    stored = train(docs)
    assert stored.order == held.order == 4 and stored.langs == held.langs
    for name, limit in held.limit.items():
        assert stored.limit[name] == pytest.approx(limit, rel=1e-6)
    columns = ("doc_id", "text", "lang_pred", "rejected", "n_chars_scored", "score", "cross_entropy")
    got, want = (sorted((tuple(r[c] for c in columns) for r in identify(named, m).collect()), key=repr) for m in (stored, held))
    assert len(got) == named.count()
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert (a[6] is None) == (b[6] is None) and (a[6] is None or a[5:] == pytest.approx(b[5:], rel=1e-6))


def test_sentencepiece_matches_library(spark, docs, odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    assert encode_documents(empty, piece_model_path()).count() == 0
    for table_ in (docs, odd):
        got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in encode_documents(table_, piece_model_path()).collect())
        want = Counter()
        for r in table_.collect():
            ids = library.encode(r.text or "")
            want[r.doc_id, tuple(ids), library.decode(ids) if ids else ""] += 1
        assert got == want


def test_sentencepiece_random_texts():
    with open(piece_model_path(), "rb") as f:
        encoder = Encoder(f.read())
    r, pieces = random.Random(5), sorted(encoder.ids)
    for _ in range(1500):
        kind = r.random()
        if kind < 0.4:
            text = "".join(r.choice("ab ▁  \n\té1x.<s>") for _ in range(r.randint(0, 40)))
        elif kind < 0.7:
            text = "".join(r.choice(pieces) for _ in range(r.randint(1, 12)))
        else:
            text = " " * r.randint(0, 70) + "".join(chr(r.choice([r.randint(32, 126), r.randint(0x80, 0x2FFF)])) for _ in range(9))
        assert encoder.encode(text) == encoder.library.encode(text), text


def test_jaccard_runs_repeat_until_one_adds_nothing(spark, monkeypatch):
    """Pairs around the threshold and one choice a node: a single run misses some, the measured runs do not."""
    monkeypatch.setattr(jaccard_join, "CHOICES", 1)
    r = random.Random(21)
    rows = []
    for i in range(300):
        w = [f"w{r.randint(0, 10**6)}" for _ in range(64)]
        rows.append((2 * i, " ".join(w)))
        w[r.randint(5, 58)] = "changed"  # five of sixty shingles: a similarity of 55 / 65
        rows.append((2 * i + 1, " ".join(w)))
    docs_ = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = written(jaccard_join._sketches(docs_, "doc_id", "text").select("text_id", "tokens"))
    once = jaccard_join.components(jaccard_join.candidate_edges(sets, runs=1)).count()
    parts, measured = jaccard_join.connected_parts(sets, runs=1)
    assert once < parts.count() == 600 and parts.select("root").distinct().count() == 300
    assert measured[-1][1] == 0 < measured[0][1] and all(new <= total for total, new in measured)
    assert 0.7 < 1 - measured[0][1] / measured[0][0] < 1  # the first run's recall
    assert len(jaccard_join.connected_parts(sets, runs=1, recall=0.5)[1]) < len(measured)
    found = jaccard_join.near_duplicates(docs_)
    assert all(x.n_links == 1 and x.group_id == x.doc_id // 2 * 2 for x in found.collect())


def test_pipeline_stages(spark, docs, odd, empty):
    kept = docs
    for (name, stage), nxt in zip(corpus_pipeline.STAGES, [*corpus_pipeline.STAGES[1:], None]):
        out = written(stage(spark, kept, SF))
        if nxt:
            assert out.columns == docs.columns, name
            before, after = {r.doc_id: r.text for r in kept.collect()}, {r.doc_id: r.text for r in out.collect()}
            assert set(after) <= set(before)
            if name == "language_id":
                assert set(after) == {i for i, t in before.items() if re.search(r"[^\W\d_]", t or "")}
            elif name == "line_dedup":
                assert set(after) == set(before)
            elif name == "jaccard_join":
                pairs = list(before.items())
                assert set(after) == {g for _, g, _ in plain_groups(pairs)} | {i for i, t in pairs if not words(t)}
            else:
                from test_text_ops import plain_hits

                items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
                bad = {i for (i, _), x in zip(before.items(), plain_hits(before.values(), items)) if x[3]}
                assert set(after) == set(before) - bad
            assert name == "line_dedup" or all(before[i] == t for i, t in after.items())
        kept = out
    assert [r.n_tokens for r in kept.collect()] == [len(r.ids) for r in kept.collect()]


def test_pipeline_odd_rows(spark, odd, empty):
    for table_ in (odd, empty):
        kept = written(table_)
        for _, stage in corpus_pipeline.STAGES[1:]:
            kept = written(stage(spark, kept, SF))
        told = corpus_pipeline.language(spark, table_, SF)
        assert told.columns == table_.columns and told.count() <= table_.count()
    assert kept.count() == 0


def test_pipeline_keeps_a_page_copied_for_a_third_of_the_rows(spark):
    page = "the only report of the flood\nwith its second line"
    texts = [page] * 10 + [f"page {i} has words of its own\nhome about contact" for i in range(20)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    cut = written(corpus_pipeline.lines(spark, docs, SF))
    after = {r.doc_id: r.text for r in cut.collect()}
    assert all(after[i] == page for i in range(10))
    assert all(after[i] == f"page {i - 10} has words of its own" for i in range(10, 30))
    kept = [r.text for r in corpus_pipeline.near_duplicates(spark, cut, SF).collect()]
    assert kept.count(page) == 1 and len(kept) == 21 and all(kept)
