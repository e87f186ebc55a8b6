"""Centroid clustering, SimHash and whitening against plain Python."""

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from conftest import words

from playback_qos.llm.centroids import VantageTree, cluster, largest_component
from playback_qos.llm.common import table
from playback_qos.llm.queries import LLM_QUERIES
from playback_qos.llm.simhash import covering_masks, fingerprint, near_duplicates, spanning_links
from playback_qos.llm.whitening import whiten

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, id string, x array<int>, cluster string, distance int, n int, component string"


def frame(spark, vectors):
    """(id, vector) rows beside columns with names that the operators use."""
    rows = [(i, v, 1, "id", [1], "c", 2, 3, "k") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Nulls, wrong lengths, non-finite, repeated and tied vectors, null and repeated ids, a vector in a third of all rows."""
    r = random.Random(3)
    some = [[r.randint(-3, 3) / 4 for _ in range(6)] for _ in range(40)]
    rows = list(enumerate(some)) + [(100 + i, some[0]) for i in range(30)]
    rows += [(5, some[5]), (5, some[6]), (None, some[7]), (None, None), (60, None), (61, []), (62, [1.0] * 5), (63, [None] + [1.0] * 5)]
    rows += [(64, [math.nan] * 6), (65, [math.inf] + [0.0] * 5), (66, [-0.0] * 6), (67, [0.0] * 6)]
    return frame(spark, rows)


def kept(df, dim):
    return [(r.vec_id, [float(c) for c in r.embedding]) for r in df.collect()
            if r.embedding is not None and len(r.embedding) == dim and all(c is not None and math.isfinite(c) for c in r.embedding)]


def plain_clusters(rows, k, rounds, scale):
    x = [(i, [math.floor(scale * c) for c in v]) for i, v in rows]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in x)
    centroids = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in x]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(x, own) if c == j]
            if mine:
                centroids[j] = [sum(z) // len(mine) for z in zip(*mine)]
    own, total = assign(), Counter()
    for d, j in own:
        total[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, j, d, total[j], sum(total.values()), sha[j]) for (i, _), (d, j) in zip(x, own))


@pytest.mark.parametrize("k", [1, 5, 16, 200])
def test_centroids(spark, odd_vectors, k):
    got = cluster(odd_vectors, k=k, dim=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == plain_clusters(kept(odd_vectors, 6), k, 3, 64)


def test_centroids_empty(spark, odd_vectors):
    for df in (odd_vectors.limit(0), odd_vectors.filter("embedding IS NULL")):
        got = cluster(df, dim=6)
        assert got.count() == 0 and got.schema == cluster(odd_vectors, k=2, rounds=0, dim=6).schema


def test_vantage_tree_is_exact():
    r = np.random.default_rng(4)
    for k, dim, most in ((1, 3, 2), (40, 3, 2), (300, 8, 50), (64, 64, largest_component(64)), (500, 2, 6)):
        centroids, x = (r.integers(-most, most + 1, (m, dim)) for m in (k, 700))
        who, best = VantageTree(centroids).nearest(x)
        squares = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centroids] for v in x[:50]]
        assert [(min(s), s.index(min(s))) for s in squares] == list(zip(best[:50].tolist(), who[:50].tolist()))
        if most < 100:
            full = ((x[:, None] - centroids[None]) ** 2).sum(2)
            assert (full.argmin(1) == who).all() and (full.min(1) == best).all()


def test_centroid_components_beyond_the_bound(spark):
    df = frame(spark, [(1, [3e38] * 6), (2, [-3e38] * 6), (3, [0.0] * 6)])
    rows = {r.vec_id: r for r in cluster(df, k=1, rounds=0, dim=6).collect()}
    assert len(rows) == 3 and all(0 <= r.distance < 2**63 for r in rows.values())


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_fingerprint(text):
    w = words(low(text))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, radius):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    values = sorted({f for _, f in prints})
    root = {f: f for f in values}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return Counter((i, f"{f:016x}", least.get(find(f))) for i, f in prints)


@pytest.mark.parametrize("radius,block", [(4, 2048), (2, 2), (8, 3)])
def test_simhash(spark, docs, odd, empty, radius, block):
    for df in (docs, odd, empty):
        got = near_duplicates(df, radius=radius, block=block)
        assert got.columns == ["doc_id", "fingerprint", "component_id"]
        assert Counter(map(tuple, got.collect())) == plain_components([(r.doc_id, r.text) for r in df.collect()], radius)


def test_simhash_large_group(spark):
    """Near copies of one text in a third of the rows, in buckets of more than a block."""
    r = random.Random(8)
    base = [r.choice("abcdefgh") * 3 + str(r.randint(0, 99)) for _ in range(150)]
    texts = []
    for _ in range(120):
        w = list(base)
        w[r.randrange(150)] = f"z{r.randint(0, 10**6)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"w{r.randint(0, 10**4)}" for _ in range(60)) for _ in range(240)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(map(tuple, near_duplicates(df, block=8).collect()))
    assert got == plain_components(rows, 4)
    assert Counter(c for _, _, c in got)[0] > 20


def test_covering_masks():
    r = random.Random(2)
    for radius in (0, 1, 4, 6):
        masks = covering_masks(radius)
        assert len(masks) == len(set(masks)) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            differ = sum(1 << i for i in r.sample(range(64), radius))
            assert any(not m & differ for m in masks)


def test_fingerprint_pieces(monkeypatch):
    from playback_qos.llm import simhash

    r = random.Random(1)
    texts = ["", None, " \n", "One", "one TWO three", "Ä Ö ü", " ".join(str(r.randint(0, 50)) for _ in range(500))]
    want = [plain_fingerprint(t) for t in texts]
    assert [fingerprint(t) % 2**64 for t in texts] == want
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert [fingerprint(t) % 2**64 for t in texts] == want


def test_spanning_links_connect_the_same():
    r = np.random.default_rng(5)
    v = np.unique(r.integers(0, 2**9, 120))
    a, b = spanning_links(v, 1)
    assert len(a) < len(v) and all((int(x) ^ int(y)).bit_count() <= 1 for x, y in zip(a, b))


def plain_whitening(rows, count):
    x = [(i, [math.floor(256 * c) for c in v]) for i, v in rows]
    fit = sorted({tuple(v) for _, v in x})
    n, dim = len(fit), len(fit[0])
    s = [sum(z) for z in zip(*fit)]
    cov = [[float(sum(Fraction(v[i] * n - s[i]) * (v[j] * n - s[j]) for v in fit) / n**3) for j in range(dim)] for i in range(dim)]
    values, basis = np.linalg.eigh(np.array(cov))
    values, basis = values[::-1], basis[:, ::-1]
    out = {}
    for k, (i, v) in enumerate(x):
        for c in range(count):
            w = sum((v[d] - s[d] / n) * basis[d, c] for d in range(dim)) / math.sqrt(values[c])
            out[k, c + 1] = (i, n, sum((n * a - b) ** 2 for a, b in zip(v, s)), w, values[c] / sum(values))
    return out


def signs_agree(got, want):
    """Rows in any order; each component may be turned as a whole."""
    for c in range(1, 5):
        a = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in got if r.component == c)
        for turn in (1, -1):
            b = sorted((v[0] is None, v[0] or 0, v[2], turn * v[3]) for (_, k), v in want.items() if k == c)
            if len(a) == len(b) and all(p[:3] == q[:3] and abs(p[3] - q[3]) < 1e-7 for p, q in zip(a, b)):
                break
        else:
            return False
    return True


def test_whitening(spark, odd_vectors):
    clean = odd_vectors.filter("embedding IS NULL OR size(embedding) IN (0, 5, 6)")
    got, want = whiten(clean).collect(), plain_whitening(kept(odd_vectors, 6), 4)
    assert len(got) == len(want) and signs_agree(got, want)
    explained = {r.component: r.explained for r in got}
    for (_, c), v in want.items():
        assert explained[c] == pytest.approx(v[4], rel=1e-9)
    assert {r.n for r in got} == {v[1] for v in want.values()}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in table(spark, SF, "embeddings").collect()]
    got, want = LLM_QUERIES["op13_whitening"](spark, SF).collect(), plain_whitening(rows, 4)
    assert len(got) == len(want) and signs_agree(got, want) and got[0].identity_error < 1e-9


def test_whitening_far_from_zero(spark):
    """A common offset of 10**5 does not cost digits, and the widest integers add up without overflow."""
    r = random.Random(6)
    near = [(i, [r.randint(-9, 9) / 256 for _ in range(3)]) for i in range(50)]
    got = {}
    for shift in (0, 4096):
        df = spark.createDataFrame([(i, [float(shift + c) for c in v]) for i, v in near], "vec_id long, embedding array<double>")
        got[shift] = sorted((x.vec_id, x.component, x.deviation, x.whitened, x.explained) for x in whiten(df, components=3).collect())
    for a, b in zip(*got.values(), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], abs=1e-7)
    wide = [(i, [r.choice([-1e30, 1e30, 0.0]) for _ in range(3)]) for i in range(300)]
    df = spark.createDataFrame(wide, "vec_id long, embedding array<double>")
    rows = whiten(df, components=3).collect()
    assert len(rows) == 900 and rows[0].identity_error < 1e-9


def test_whitening_without_variance(spark, odd_vectors):
    for df in (odd_vectors.limit(0), odd_vectors.filter("embedding IS NULL"), odd_vectors.filter("vec_id = 1"), odd_vectors.filter("size(embedding) = 0")):
        got = whiten(df)
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = frame(spark, [(i, [i / 8, i / 4]) for i in range(9)])
    assert {r.component for r in whiten(line).collect()} == {1}
