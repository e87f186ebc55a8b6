"""Language identification with interpolated Kneser-Ney models over characters."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import lean, written

#: Characters of the longest n-gram.
ORDER = 4
#: A model in memory holds at most so many n-grams of all languages (and 4 times as many
#: probabilities); beyond, the same model is computed, stored and joined by Spark.
MAX_GRAMS = 4_000_000
#: The models of left-out folds that are scored in one pass hold at most so many n-grams together, or are one.
FOLD_GRAMS = 1_000_000
#: The rejection limits are set on all labelled rows, each scored by the counts of the other parts of so many.
CALIBRATION_FOLDS = 8
#: The variance of a language of so many rows and one lies midway between its own and that of all
#: languages, and that of all, with so many rows, between its own and the variance PRIOR_SPREAD (nats squared).
PRIOR_ROWS = 20
PRIOR_SPREAD = 0.25
#: A text is rejected if its cross-entropy is above its language's usual one by so many
#: standard deviations, and by so many nats a character: another language, not a mixed text.
REJECT_Z = 8.0
REJECT_NATS = 1.0
#: Characters that are in hand at once.
SLICE_CHARS = 500_000
#: Rows that are turned into strings at once.
SLICE_ROWS = 512
UNDETERMINED = "und"
_BITS = 16


# --- characters and n-grams ---------------------------------------------------------------


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


class Grams(NamedTuple):
    key: np.ndarray  #: a packed n-gram for each predicted character
    first: np.ndarray  #: texts + 1 entries


def grams(texts: list[str], order: int = ORDER) -> Grams:
    """N-grams of lower-cased letters, every run of others taken as one space.

    A text is led by spaces, so its first letters have full contexts, and ends
    with one. A character is folded to 16 bits (itself, in the basic plane),
    and an n-gram is packed into 64, the last character lowest. A text without
    a letter has none.
    """
    lower = [t.lower() for t in texts]
    size = np.fromiter(map(len, lower), np.int64, len(lower))
    raw = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(texts)
    if not len(raw):
        return Grams(np.zeros(0, np.uint64), np.zeros(n + 1, np.int64))
    letter = _letters()[raw]
    begin = np.cumsum(size) - size
    after = np.empty(len(raw), bool)
    after[0], after[1:] = False, letter[:-1]
    after[begin[size > 0]] = False
    keep = letter | after
    code = np.where(letter, (raw ^ (raw >> 16) * np.uint32(0x9E37)) & 0xFFFF, 32)[keep].astype(np.uint64)
    upto = np.concatenate(([0], np.cumsum(keep)))
    edge = np.append(begin, len(raw))
    kept = upto[edge[1:]] - upto[edge[:-1]]
    last = upto[edge[1:]] - 1  # place of each text's last kept character
    spare = np.where(kept > 0, code[np.maximum(last, 0)] != 32, False).astype(np.int64)
    room = np.where(kept > 0, order - 1 + kept + spare, 0)
    at = np.cumsum(room) - room
    out = np.full(int(room.sum()), 32, np.uint64)
    out[np.arange(len(code)) + np.repeat(at + order - 1 - upto[edge[:-1]], kept)] = code
    packed = np.zeros(max(0, len(out) - order + 1), np.uint64)
    for i in range(order):
        packed = packed << np.uint64(_BITS) | out[i : i + len(packed)]
    ends = np.maximum(room - order + 1, 0)
    inside = np.ones(len(packed), bool)  # windows that do not run into the next text
    for k in range(1, order):
        cut = at[1:][room[1:] > 0] - k
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    return Grams(packed[inside], np.concatenate(([0], np.cumsum(ends))))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys and their counts."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[at], np.diff(np.append(at, len(keys)))


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _fold(text: str) -> Column:
    """Copies of a text share a fold, so that none is scored by counts of another."""
    return F.pmod(F.xxhash64(F.col(text)), F.lit(CALIBRATION_FOLDS)).cast("int")


def count_grams(docs: DataFrame, text: str, lang: str, order: int = ORDER) -> DataFrame:
    """(lang, fold, gram, n) over all rows with a language; each task counts its rows first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in (x.slice(i, SLICE_ROWS) for x in batches for i in range(0, x.num_rows, SLICE_ROWS)):
            rows: dict[tuple[str, int], list[str]] = {}
            for t, *name in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "fold")), strict=True):
                if t and name[0] is not None:
                    rows.setdefault(tuple(name), []).append(t)
            for name, texts in rows.items():
                for part in _slices(texts):
                    have = total.setdefault(name, [])
                    have.append(_distinct(grams(part, order).key))
                    if len(have) >= 8:
                        total[name] = [_sums(*(np.concatenate(x) for x in zip(*have)))]
        for (name, fold), have in total.items():
            keys, counts = _sums(*(np.concatenate(x) for x in zip(*have)))
            for i in range(0, len(keys), 100_000):
                part = slice(i, i + 100_000)
                k = keys[part].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(k)), pa.array([fold] * len(k), pa.int32()), pa.array(k), pa.array(counts[part], pa.int64())],
                    ["lang", "fold", "gram", "n"],
                )

    return (
        docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), _fold(text).alias("fold"))
        .filter("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(lean(count), "lang string, fold int, gram long, n long")
        .groupBy("lang", "fold", "gram")
        .agg(F.sum("n").alias("n"))
    )


# --- the models ---------------------------------------------------------------------------


def _suffix(keys: np.ndarray, k: int) -> np.ndarray:
    """The last k characters."""
    return keys if k * _BITS >= 64 else keys & np.uint64((1 << (k * _BITS)) - 1)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


class _Level(NamedTuple):
    grams: np.ndarray  #: sorted, of all languages
    logp: np.ndarray  #: a column for each language
    contexts: np.ndarray  #: sorted, of one character less
    backoff: np.ndarray  #: log of the weight left to the shorter context


class Model:
    """Interpolated Kneser-Ney models of all languages, in sorted arrays of packed n-grams."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int):
        self.langs = sorted(counts)
        self.order = order
        self.limit: dict[str, tuple[float, float, float]] = {}
        if not self.langs:
            return
        levels = {name: self._raw(*counts[name], order) for name in self.langs}
        chars = np.unique(np.concatenate([levels[name][0][0] for name in self.langs]))
        self.unseen = np.empty(len(self.langs))
        self.levels: list[_Level] = []
        for k in range(1, order + 1):
            keys = np.unique(np.concatenate([levels[name][k - 1][0] for name in self.langs]))
            contexts = np.unique(keys >> np.uint64(_BITS)) if k > 1 else np.zeros(1, np.uint64)
            logp = np.empty((len(keys), len(self.langs)))
            backoff = np.zeros((len(contexts), len(self.langs)))
            lower = self.lookup(_suffix(keys, k - 1), k - 1) if k > 1 else None
            for j, name in enumerate(self.langs):
                g, c = levels[name][k - 1]
                once, twice = np.count_nonzero(c == 1), np.count_nonzero(c == 2)
                d = once / (once + 2 * twice) if once and twice else 0.5
                ctx = g >> np.uint64(_BITS) if k > 1 else np.zeros(len(g), np.uint64)
                at, _ = _find(contexts, ctx)
                total = np.bincount(at, c, len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                with np.errstate(divide="ignore", invalid="ignore"):
                    weight = np.where(total > 0, d * kinds / total, 1.0)
                    backoff[:, j] = np.log(weight)
                    own, _ = _find(contexts, keys >> np.uint64(_BITS) if k > 1 else np.zeros(len(keys), np.uint64))
                    if k == 1:
                        self.unseen[j] = np.log(weight[0] / (len(chars) + 1))
                        base = np.full(len(keys), self.unseen[j])
                    else:
                        base = lower[:, j] + backoff[own, j]
                    where, known = _find(g, keys)
                    share = np.where(known & (total[own] > 0), np.maximum(c[where] - d, 0) / total[own], 0.0)
                    logp[:, j] = np.logaddexp(np.log(share), base)
            self.levels.append(_Level(keys, logp, contexts, backoff))

    @staticmethod
    def _raw(keys: np.ndarray, counts: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Counts of the longest n-grams; for shorter ones, of the different characters before them."""
        out = [_sums(keys, counts.astype(np.float64))]
        for k in range(order - 1, 0, -1):
            keys, n = _distinct(_suffix(out[-1][0], k))
            out.append((keys, n.astype(np.float64)))
        return out[::-1]

    def lookup(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Log-probability of the last character in each language, with the k - 1 before it."""
        level = self.levels[k - 1]
        at, known = _find(level.grams, keys)
        out = level.logp[at]
        rest = np.flatnonzero(~known)
        if len(rest):
            if k == 1:
                out[rest] = self.unseen
            else:
                out[rest] = self.lookup(_suffix(keys[rest], k - 1), k - 1)
                ctx, seen = _find(level.contexts, keys[rest] >> np.uint64(_BITS))
                out[rest] += np.where(seen[:, None], level.backoff[ctx], 0.0)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy a character (nats), a column for each language; the characters."""
        g = grams(texts, self.order)
        n = np.diff(g.first)
        if not len(g.key):
            return np.zeros((len(texts), len(self.langs))), n
        order = np.argsort(g.key)
        key = g.key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        place = np.empty(len(key), np.int32)
        place[order] = np.cumsum(new) - 1
        scores = self.lookup(key[new], self.order)
        out = np.zeros((len(texts), len(self.langs)))
        some = n > 0
        for j in range(len(self.langs)):
            out[some, j] = -np.add.reduceat(scores[:, j][place], g.first[:-1][some]) / n[some]
        return out, n

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None, int, bool]]:
        """(language, its share of the likelihoods, cross-entropy, characters, rejected) of each text."""
        if not self.langs:
            return [(UNDETERMINED, 0.0, None, 0, True)] * len(texts)
        h, n = self.entropies(texts)
        best = h.argmin(axis=1)  # a tie goes to the first language by name
        low = h[np.arange(len(h)), best] if len(h) else np.zeros(0)
        share = 1 / np.exp(np.maximum(-(h - low[:, None]) * n[:, None], -700)).sum(axis=1)
        out = []
        for i in range(len(texts)):
            if n[i] == 0:
                out.append((UNDETERMINED, 0.0, None, 0, True))
            else:
                name = self.langs[best[i]]
                mean, own, char = self.limit.get(name, (0.0, np.inf, 0.0))
                far = bool(low[i] > mean + max(REJECT_NATS, REJECT_Z * np.sqrt(own**2 + char**2 / n[i])))
                out.append((name, float(share[i]), float(low[i]), int(n[i]), far))
        return out


class StoredModel:
    """The same models as tables: the n-grams and contexts of each length, with a list of (language, value)."""

    order = ORDER

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.limit: dict[str, tuple[float, float, float]] = {}
        self.unseen = np.zeros(len(langs))
        self.grams: list[DataFrame] = []  #: (gram, found: log-probabilities), by length from 1 on
        self.contexts: list[DataFrame | None] = []  #: (ctx, weights: logs of the weight left to shorter contexts)


class _Light:
    """What Python workers need of a stored model; its tables stay on the driver."""

    def __init__(self, model: StoredModel):
        self.langs, self.order, self.limit = model.langs, model.order, model.limit


class _Answers(Model):
    """Looks up n-grams whose log-probabilities are at hand already."""

    def __init__(self, model: _Light, keys: np.ndarray, logp: np.ndarray):
        self.langs, self.order, self.limit = model.langs, model.order, model.limit
        self.keys, self.logp = keys, logp

    def lookup(self, keys: np.ndarray, k: int) -> np.ndarray:
        return self.logp[_find(self.keys, keys)[0]]


def _tail(gram: str, k: int) -> Column:
    """The last k characters."""
    return F.col(gram) if k * _BITS >= 64 else F.col(gram).bitwiseAND(F.lit((1 << (k * _BITS)) - 1))


def store(table: DataFrame, langs: list[str], order: int = ORDER) -> StoredModel:
    """The model of (lang, gram, n), computed by joins; only discounts and sums of each language are collected."""
    model = StoredModel(langs)
    model.order = order
    number = F.create_map(*[F.lit(x) for pair in enumerate(langs) for x in reversed(pair)])
    raw = {order: written(table.select(number[F.col("lang")].alias("lang"), "gram", F.col("n").cast("double").alias("c")))}
    for k in range(order - 1, 0, -1):
        shorter = raw[k + 1].select("lang", _tail("gram", k).alias("gram"))
        raw[k] = written(shorter.groupBy("lang", "gram").agg(F.count("*").cast("double").alias("c")))
    chars = raw[1].select("gram").distinct().count()
    ctx = F.shiftrightunsigned("gram", _BITS)
    lower = None
    for k in range(1, order + 1):
        stats = raw[k].groupBy("lang").agg(
            F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice"),
            F.sum("c").alias("total"), F.count("*").alias("kinds"),
        ).collect()
        d = {x.lang: x.once / (x.once + 2 * x.twice) if x.once and x.twice else 0.5 for x in stats}
        held = F.create_map(*[F.lit(v) for pair in d.items() for v in pair])
        rows = raw[k].withColumn("d", held[F.col("lang")]).withColumn("ctx", ctx)
        found = rows.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), (F.first("d") * F.count("*") / F.sum("c")).alias("weight"))
        contexts = written(found)
        rows = rows.join(contexts, ["lang", "ctx"])
        if k == 1:
            for x in stats:
                model.unseen[x.lang] = np.log(d[x.lang] * x.kinds / x.total / (chars + 1))
            base = F.col("weight") / F.lit(chars + 1)
        else:
            rows = rows.withColumn("tail", _tail("gram", k - 1)).join(
                lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("shorter")), ["lang", "tail"]
            )
            base = F.col("weight") * F.col("shorter")
        share = F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")
        lower = written(rows.select("lang", "gram", (share + base).alias("p")))
        logs = lower.groupBy("gram").agg(F.collect_list(F.struct("lang", F.log("p").alias("v"))).alias("found"))
        model.grams.append(written(logs))
        weights = contexts.groupBy("ctx").agg(F.collect_list(F.struct("lang", F.log("weight").alias("v"))).alias("weights"))
        model.contexts.append(written(weights) if k > 1 else None)
    return model


def _looked_up(keys: DataFrame, model: StoredModel) -> DataFrame:
    """(gram, logp) with the log-probability of each of the n-grams in every language."""
    unseen, order = model.unseen, model.order
    for k in range(1, order + 1):
        level = model.grams[k - 1].select(F.col("gram").alias(f"g{k}"), F.col("found").alias(f"found{k}"))
        keys = keys.join(level, _tail("gram", k) == F.col(f"g{k}"), "left").drop(f"g{k}")
        if k > 1:
            ctx = model.contexts[k - 1].select(F.col("ctx").alias(f"c{k}"), F.col("weights").alias(f"weights{k}"))
            keys = keys.join(ctx, F.shiftrightunsigned(_tail("gram", k), _BITS) == F.col(f"c{k}"), "left").drop(f"c{k}")

    def dense(column: pa.Array, fill: float) -> np.ndarray:
        out = np.full((len(column), len(unseen)), fill)
        n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = column.flatten()
        out[np.repeat(np.arange(len(column)), n), flat.field("lang").to_numpy()] = flat.field("v").to_numpy()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(i, 1000) for x in batches for i in range(0, x.num_rows, 1000)):
            out = np.broadcast_to(unseen, (batch.num_rows, len(unseen)))
            for k in range(1, order + 1):
                if k > 1:
                    out = out + dense(batch.column(f"weights{k}"), 0.0)
                own = dense(batch.column(f"found{k}"), np.nan)
                out = np.where(np.isnan(own), out, own)
            edges = np.arange(0, out.size + 1, len(unseen), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("gram"), pa.ListArray.from_arrays(edges, out.ravel())], ["gram", "logp"])

    return keys.mapInArrow(run, "gram long, logp array<double>")


def _identify_stored(source: DataFrame, body: str, model: StoredModel, ddl: str, new: tuple[str, ...]) -> DataFrame:
    """As ``identify``: blocks of texts ask for their distinct n-grams, and each block is scored with the answers.

    A frequent n-gram costs a row a block, and a block's answers a bounded size.
    """
    order, light = model.order, _Light(model)
    room = max(1, SLICE_CHARS * 4 // max(4, len(model.langs)))
    fields = [f.name for f in source.schema.fields]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, block, size = [], None, 0
            for i, n in zip(batch.column("__id").to_pylist(), batch.column("__size").to_pylist(), strict=True):
                if block is None or size >= room or len(ids) and i - block >= 100_000:
                    block, size = i, 0
                size += n
                ids.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(ids, pa.int64())], [*fields, "__block"])

    inner = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    sized = source.select("*", F.monotonically_increasing_id().alias("__id"), F.coalesce(F.length(body), F.lit(0)).alias("__size"))
    rows = written(sized.mapInArrow(deal, inner + ", __block long"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[int, list[str]] = {}
            for t, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(block, []).append(t or "")
            for block, own in texts.items():
                k = _distinct(grams(own, order).key)[0].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block)), pa.array(k)], ["__block", "gram"])

    asked = written(rows.select(body, "__block").mapInArrow(ask, "__block long, gram long").distinct())
    answers = written(_looked_up(asked.select("gram").distinct(), model))

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        keys = found.column("gram").to_numpy().view(np.uint64)
        by = np.argsort(keys)
        logp = found.column("logp").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(keys), len(light.langs))[by]
        own = [t or "" for t in texts.column(body).to_pylist()]
        told = list(zip(*_Answers(light, keys[by], logp).predict(own)))
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())
        out = [texts.column(c) for c in fields if c != body]
        return pa.Table.from_arrays([*out, *(pa.array(x, k) for x, k in zip(told, kinds, strict=True))], [c for c in fields if c != body] + list(new))

    return rows.groupBy("__block").cogroup(asked.join(answers, "gram").groupBy("__block")).applyInArrow(score, ddl)


def _scored(docs: DataFrame, text: str, lang: str, models: dict[int, Model]) -> DataFrame:
    """(lang, h, n) of the rows of the models' folds that their fold's model tells right."""
    held = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(i, SLICE_ROWS) for x in batches for i in range(0, x.num_rows, SLICE_ROWS)):
            rows: dict[int, list[tuple[str, str]]] = {}
            for t, name, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "fold")), strict=True):
                rows.setdefault(fold, []).append((t, name))
            for fold, pairs in rows.items():
                names = iter([name for _, name in pairs])
                for part in _slices([t for t, _ in pairs]):
                    told = [(own, x[2], float(x[3])) for x in held.value[fold].predict(part) if (own := next(names)) == x[0] and x[3]]
                    kinds = (pa.string(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[i] for x in told], k) for i, k in enumerate(kinds)], ["lang", "h", "n"]
                    )

    return (
        docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), _fold(text).alias("fold"))
        .filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("fold").isin(list(models)))
        .mapInArrow(lean(run), "lang string, h double, n double")
    )


def calibrate(langs: list[str], parts: Iterable[DataFrame]) -> dict[str, tuple[float, float, float]]:
    """What cross-entropy is usual for each language, from (lang, h, n) of labelled rows not learned from.

    The variance of a text's mean is fitted as ``own + char / n`` (n: its
    characters) from sums that Spark takes over all rows given. Each language
    has its own mean; the variance of one with few rows is drawn to that of all
    languages about their own means, that one in turn to a wide one, and widened
    by the error of its mean: the fewer rows, the less is rejected. A language
    without a row given rejects nothing.
    """
    sums = {"rows": F.lit(1), "n": F.col("n"), "hn": F.expr("h * n"), "h": F.col("h"), "hh": F.expr("h * h"),
            "r": F.expr("1 / n"), "rr": F.expr("1 / n / n"), "hr": F.expr("h / n"), "hhr": F.expr("h * h / n")}
    moments: dict[str, np.ndarray] = {}
    means = {}
    found: dict[str, dict[str, float]] = {}
    for scored in parts:
        for x in scored.groupBy("lang").agg(*[F.sum(v).alias(k) for k, v in sums.items()]).collect():
            have = found.setdefault(x["lang"], dict.fromkeys(sums, 0.0))
            for k in sums:
                have[k] += x[k]
    for name, x in found.items():
        mean = means[name] = x["hn"] / x["n"]
        square = x["hh"] - 2 * mean * x["h"] + x["rows"] * mean**2
        by_r = x["hhr"] - 2 * mean * x["hr"] + mean**2 * x["r"]
        moments[name] = np.array([square, by_r, x["r"], x["rr"], x["rows"]])

    def fit(m: np.ndarray) -> np.ndarray:
        square, by_r, r, rr = m[:4] / m[4]
        spread = rr - r**2
        slope = max(0.0, (by_r - square * r) / spread) if spread > 1e-12 else 0.0
        return np.array([max(square - slope * r, 1e-4), slope])

    if not moments:
        return {}
    pool = sum(moments.values(), np.zeros(5))
    common = (pool[4] * fit(pool) + PRIOR_ROWS * np.array([PRIOR_SPREAD, 0.0])) / (pool[4] + PRIOR_ROWS)
    limit = {}
    for name in langs:
        if name in moments:
            rows = moments[name][4]
            weight = (rows - 1) / (rows - 1 + PRIOR_ROWS)
            own, char = np.sqrt((weight * fit(moments[name]) + (1 - weight) * common) * (1 + 1 / rows))
            limit[name] = (means[name], float(own), float(char))
    return limit


def _by_lang(rows: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    names = np.array(rows.column("lang").to_pylist(), dtype=object)
    keys, n = rows.column("gram").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    out = {}
    for x in set(names):
        order = np.argsort(keys[names == x])
        out[x] = (keys[names == x][order], n[names == x][order])
    return out


def _without(counts: dict, part: dict) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The counts less those of a part of the rows."""
    out = {}
    for name, (keys, n) in counts.items():
        left = n.copy()
        if name in part:
            left[np.searchsorted(keys, part[name][0])] -= part[name][1]
        if (left > 0).any():
            out[name] = (keys[left > 0], left[left > 0])
    return out


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER) -> Model | StoredModel:
    """Fit the models on all labelled rows of ``docs``.

    Counting covers every row, and the order is the same at every size. The
    table of n-grams is written; if it has at most MAX_GRAMS rows it is
    collected, and the model held in memory, else Spark computes the same model
    as tables. Calibration scores every labelled row by the counts of the other
    folds: in memory as many folds in a pass as their models together have
    FOLD_GRAMS rows, else one. ``key`` is not read.
    """
    folds = written(count_grams(docs, text, lang, order))
    table = written(folds.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    some = sorted(x.fold for x in folds.select("fold").distinct().collect())
    langs = sorted(x.lang for x in table.select("lang").distinct().collect())
    size = table.count()
    if size > MAX_GRAMS or size * len(langs) > 4 * MAX_GRAMS:
        return _train_stored(docs, text, lang, order, folds, table, some, langs)
    counts = _by_lang(table.toArrow())
    model = Model(counts, order)
    at_once = max(1, FOLD_GRAMS // max(1, size))

    def parts() -> Iterator[DataFrame]:
        for i in range(0, len(some), at_once):
            others = {f: _without(counts, _by_lang(folds.filter(F.col("fold") == f).toArrow())) for f in some[i : i + at_once]}
            yield _scored(docs, text, lang, {f: Model(x, order) for f, x in others.items()})

    model.limit = calibrate(model.langs, parts())
    return model


def _train_stored(
    docs: DataFrame, text: str, lang: str, order: int, folds: DataFrame, table: DataFrame, some: list[int], langs: list[str]
) -> StoredModel:
    model = store(table, langs, order)
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), _fold(text).alias("fold"))
    labelled = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")

    def parts() -> Iterator[DataFrame]:
        for f in some:
            rest = written(folds.filter(F.col("fold") != f).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
            known = sorted(x.lang for x in rest.select("lang").distinct().collect())
            if known:
                told = identify(labelled.filter(F.col("fold") == f), store(rest, known, order), keep=["lang"])
                yield told.filter("lang_pred = lang AND n_chars_scored > 0").select(
                    "lang", F.col("cross_entropy").alias("h"), F.col("n_chars_scored").cast("double").alias("n")
                )

    model.limit = calibrate(langs, parts())
    return model


def identify(
    docs: DataFrame, model: Model | StoredModel, text: str = "text", keep: list[str | Column] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) with lang_pred, score, cross_entropy, n_chars_scored, rejected.

    The language of the lowest cross-entropy a character wins. ``score`` is its
    share of the likelihoods. A null text, or one without a letter, is 'und'
    with score 0 and rejected; so is a text whose cross-entropy lies far above
    what its language usually has, but it keeps its language. Without labelled
    rows to learn from, all are 'und'. Each row is judged alone. Columns of
    the names above are replaced.
    """
    new = ("lang_pred", "score", "cross_entropy", "n_chars_scored", "rejected")
    columns = keep if keep is not None else [c for c in docs.columns if c not in new]
    body = "__text_scored"
    source = docs.select(*columns, F.col(text).alias(body))
    types = [f for f in source.schema.fields if f.name != body]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in types)
    ddl += ", lang_pred string, score double, cross_entropy double, n_chars_scored long, rejected boolean"
    if isinstance(model, StoredModel):
        return _identify_stored(source, body, model, ddl, new)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            column = whole.column(whole.num_columns - 1)
            while at < whole.num_rows:
                texts, size = [], 0
                while at + len(texts) < whole.num_rows and size < SLICE_CHARS:
                    texts.append(column[at + len(texts)].as_py() or "")
                    size += len(texts[-1])
                got = list(zip(*held.value.predict(texts)))
                batch = whole.slice(at, len(texts))
                kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *(pa.array(x, k) for x, k in zip(got, kinds, strict=True))],
                    [f.name for f in types] + list(new),
                )
                at += len(texts)

    return source.mapInArrow(lean(run), ddl)


def held_out(key: Column) -> Column:
    """The fold of rows that are never learned from: crc32 of the key's text is 0 modulo 5 (a null key too)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5, F.lit(0)) == 0
