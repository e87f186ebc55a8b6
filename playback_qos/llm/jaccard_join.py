"""Similarity self-join of texts on word shingles, by chosen paths."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playback_qos.llm.common import NOT_BLANK, hash_words, lean, scan_words, text_bytes, window_hashes, written
from playback_qos.llm.components import components, joined

SHINGLE = 5
SIMILARITY = Fraction(4, 5)
#: Sampled tokens of a set: the least of its shingles under so many hash functions.
TOKENS = 64
#: Runs to begin with, and tokens that are chosen at each node of a run's tree. With two, a
#: pair of similarity 0.8 survives a run of any depth with probability 0.9375, so four runs
#: miss less than 2 in 100,000 of the pairs that lie exactly at the threshold. Further runs
#: follow until one of them measures the target recall.
RUNS = 4
CHOICES = 2
#: Share of a further run's connections that the runs before it must have found: all of them.
RECALL = 1.0
#: Buckets of at most so many sets are compared by brute force; larger ones are split
#: further, down to this depth, and what is larger then is compared block by block.
BUCKET = 4096
DEPTH = 3
#: Sets of a connected part that are compared in full against so many others at once.
BLOCK = 2048
#: Bits of the map by which rows are left out before their sets are compared in full.
FILTER_BITS = 1 << 24
#: Sets agreeing in so many sampled tokens are compared in full. At similarity 0.8 fewer
#: agree in 4.2 pairs of a million, by the binomial distribution of 64 samples.
AGREE = 36
#: Rows of a task of brute force, and rows of text in hand at once.
TASK_ROWS = 16_384
SLICE = 512

_RNG = np.random.Generator(np.random.PCG64(77))
_XOR = _RNG.integers(0, 2**32, TOKENS, dtype=np.uint32)
_MULTIPLY = _RNG.integers(0, 2**32, TOKENS, dtype=np.uint32) | np.uint32(1)


# --- sets -----------------------------------------------------------------------------------


def _shingles(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, and where each row's begin.

    A text of fewer words than a shingle has them all as its one shingle.
    """
    data, offsets = text_bytes(column)
    words = scan_words(data, offsets, NOT_BLANK)
    hashes = hash_words(data, words)
    windows = window_hashes(hashes, SHINGLE)
    first = words.first
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(windows[a : b - SHINGLE + 1]))
        elif b > a:
            short = np.full(SHINGLE, b - a, np.uint64)
            short[: b - a] = hashes[a:b]
            out.append(window_hashes(short, SHINGLE))
        else:
            out.append(hashes[:0])
    return np.concatenate(out) if out else hashes[:0], np.concatenate(([0], np.cumsum([len(x) for x in out])))


def _identity(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_id, n, tokens) of each row; tokens are null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                batch = whole.slice(i, SLICE)
                flat, first = _shingles(batch.column("text"))
                n = np.diff(first)
                some = n > 0
                tokens = np.zeros((int(some.sum()), TOKENS), np.uint32)
                if len(tokens):
                    low = (flat >> np.uint64(32)).astype(np.uint32)
                    for j in range(TOKENS):
                        tokens[:, j] = np.minimum.reduceat((low ^ _XOR[j]) * _MULTIPLY[j], first[:-1][some])
                at = np.concatenate(([0], np.cumsum(np.where(some, TOKENS, 0)))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(tokens.ravel().view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("text_id"), pa.array(n, pa.int64()), lists],
                    ["key", "text_id", "n", "tokens"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), _identity(F.col(text)).alias("text_id"), F.col(text).alias("text")).mapInArrow(
        lean(run), f"key {kind}, text_id binary, n long, tokens array<int>"
    )


# --- paths ----------------------------------------------------------------------------------


def _sized(paths: DataFrame) -> DataFrame:
    """(path, text_id, size) of the buckets that hold two sets or more."""
    sizes = written(paths.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1"))
    return paths.join(sizes, "path")  # plain exchanges on both sides: a hot path can be split


def _split(paths: DataFrame, sets: DataFrame) -> DataFrame:
    """Each bucket's sets dealt by the values of its two chosen tokens."""
    one = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(TOKENS))
    two = F.pmod(one + 1 + F.pmod(F.xxhash64("path", F.lit(2)), F.lit(TOKENS - 1)), F.lit(TOKENS))
    return (
        paths.join(sets.select("text_id", "tokens"), "text_id")
        .select("path", "text_id", "tokens", F.explode(F.array(one, two)).alias("choice"))
        .select(F.xxhash64("path", "choice", F.get("tokens", F.col("choice").cast("int"))).alias("path"), "text_id")
    )


def candidate_edges(sets: DataFrame, runs: int = RUNS, bucket: int = BUCKET, depth: int = DEPTH, first: int = 0) -> DataFrame:
    """Edges (a, b) that join the sets of each bucket that agree in AGREE sampled tokens or more.

    ``sets`` has (text_id, tokens). A run starts with one bucket of all sets;
    each bucket that is too large is split by tokens chosen by its path. Only
    identities move while splitting; the tokens join in for brute force. A
    bucket gives a spanning star for each of its components, not its pairs.
    ``first`` numbers the first run; runs of different numbers are independent.
    """
    roots = [(r, c % TOKENS) for r in range(first, first + runs) for c in range(r * CHOICES, r * CHOICES + CHOICES)]
    started = sets.select(
        "text_id", F.explode(F.array(*[F.xxhash64(F.lit(r), F.lit(c), F.get("tokens", F.lit(c))) for r, c in roots])).alias("path")
    )
    level, leaves = written(_sized(started)), []
    for _ in range(depth - 1):
        leaves.append(level.filter(F.col("size") <= bucket).select("path", "text_id"))
        large = level.filter(F.col("size") > bucket)
        if large.isEmpty():
            break
        level = written(_sized(_split(large.select("path", "text_id"), sets)))
    else:
        # what is large still, in blocks: each pair of blocks is a bucket
        n = F.ceil(F.col("size") / F.lit(max(1, bucket // 2))).cast("int")
        own = F.pmod(F.xxhash64("text_id", "path"), n).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), n - 1), lambda j: F.xxhash64("path", F.least(j, own), F.greatest(j, own))
        )
        leaves.append(level.select(F.when(F.col("size") <= bucket, F.array("path")).otherwise(pairs).alias("path"), "text_id")
                      .select(F.explode("path").alias("path"), "text_id"))
    rows = leaves[0]
    for more in leaves[1:]:
        rows = rows.union(more)
    rows = written(rows)
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    return (
        rows.join(sets.select("text_id", "tokens"), "text_id")
        .withColumn("task", F.pmod(F.xxhash64("path", F.lit(3)), F.lit(tasks)))
        .groupBy("task")
        .applyInArrow(_connect, "a binary, b binary")
        .distinct()
    )


def connected_parts(
    sets: DataFrame, runs: int = RUNS, bucket: int = BUCKET, depth: int = DEPTH, recall: float = RECALL
) -> tuple[DataFrame, list[tuple[int, int]]]:
    """(node, root) of the sets that candidate edges connect, and how each further run measured that.

    After ``runs`` runs one more is made at a time. Its edges are found without
    regard to the earlier ones, so the share of them whose ends are connected
    already estimates the recall of the runs before it. Edges that connect anew
    join whole parts, and the runs end when that share reaches ``recall``: at 1, when a
    run connects nothing that was not connected. Each entry of the list is (edges of the run, new ones).
    """
    parts = written(components(candidate_edges(sets, runs, bucket, depth)))
    measured: list[tuple[int, int]] = []
    while True:
        fresh = candidate_edges(sets, 1, bucket, depth, first=runs + len(measured))
        for side in ("a", "b"):
            of = parts.select(F.col("node").alias(f"{side}_node"), F.col("root").alias(f"{side}_root"))
            fresh = fresh.join(of, F.col(side) == F.col(f"{side}_node"), "left").drop(f"{side}_node")
        fresh = written(fresh.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
        total, new = fresh.agg(F.count("*"), F.count_if(F.col("a") != F.col("b"))).first()
        measured.append((total, new))
        if new:
            parts = written(joined(parts, fresh.filter("a != b")))
        if new <= (1 - recall) * total:
            return parts, measured


def _connect(rows: pa.Table) -> pa.Table:
    """Brute force in each bucket, by expanding components from one of their sets."""
    path = rows.column("path").to_numpy()
    order = np.argsort(path, kind="stable")
    path = path[order]
    lists = rows.column("tokens").combine_chunks()
    tokens = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, TOKENS)
    cuts = np.flatnonzero(np.concatenate(([True], path[1:] != path[:-1], [True])))
    left, right = [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        rest = order[a:b]
        while len(rest) > 1:
            seed, rest = rest[0], rest[1:]
            front = [seed]
            while front and len(rest):
                close = (tokens[rest] == tokens[front.pop()]).sum(axis=1) >= AGREE
                new, rest = rest[close], rest[~close]
                front.extend(new)
                left.extend(new)
                right.extend([seed] * len(new))
    ids = rows.column("text_id").combine_chunks()
    take = lambda x: ids.take(pa.array(x, pa.int64()))
    return pa.table({"a": take(left).cast(pa.binary()), "b": take(right).cast(pa.binary())})


# --- exact comparison -----------------------------------------------------------------------


def _similar(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Which sets of ``left`` and ``right`` (or of ``left`` alone) have the similarity; exact."""
    sets = left + (right or [])
    size = np.array([len(x) for x in sets], np.float32)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size.astype(np.int64))
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.concatenate(([False], flat[1:] != flat[:-1])))
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    column = np.cumsum(np.concatenate(([0], np.diff(column) != 0))) if len(column) else column
    m = len(left)
    common = np.zeros((m, len(right) if right else m), np.float32)
    width = max(256, (1 << 22) // len(sets))  # columns taken at once
    starts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b > a:
            part = np.zeros((len(sets), int(column[b - 1] - column[a]) + 1), np.float32)
            part[owner[a:b], column[a:b] - column[a]] = 1
            common += part[:m] @ (part[m:] if right else part).T
    num, den = SIMILARITY.numerator, SIMILARITY.denominator
    # common / (sizes - common) >= num / den, in whole numbers
    sizes = size[:m, None] + (size[m:] if right else size)[None, :]
    out = (num + den) * common >= num * sizes
    if not right:
        np.fill_diagonal(out, False)
    return out


def _links(rows: pa.Table) -> pa.Table:
    """(text_id, n_links, root) of the sets with links.

    All pairs of a group are compared; if it is made of two blocks, only the
    pairs across.
    """
    group = rows.column("group").to_numpy()
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], group[order][1:] != group[order][:-1], [True])))
    raw = rows.column("shingles").combine_chunks()
    ids = rows.column("text_id").combine_chunks()
    copies = rows.column("copies").to_numpy()
    side = rows.column("block").to_numpy()
    cross = rows.column("cross").to_numpy()
    out_id, out_n, out_root = [], [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        mine: dict[bytes, int] = {}
        for i in order[a:b].tolist():  # a row of documents that is repeated comes more than once
            mine.setdefault(ids[i].as_py(), i)
        at = np.array(sorted(mine.values(), key=lambda i: side[i]), np.int64)
        if len(at) < 2:
            continue
        names = ids.take(pa.array(at)).to_pylist()
        sets = [np.frombuffer(raw[i].as_buffer(), np.uint64) for i in at.tolist()]
        if cross[at[0]]:
            m = int(np.searchsorted(side[at], side[at], "right")[0])  # those of the lesser block
            if m == len(at):
                continue
            near = _similar(sets[:m], sets[m:])
            n = np.concatenate([near @ copies[at[m:]], near.T @ copies[at[:m]]])
            of = lambda i, near=near, m=m: np.flatnonzero(near[i]) + m if i < m else np.flatnonzero(near[:, i - m])
        else:
            near = _similar(sets)
            n = near @ copies[at]
            of = lambda i, near=near: np.flatnonzero(near[i])
        root = np.full(len(at), -1)
        for s in np.flatnonzero(n):
            if root[s] < 0:
                root[s], front = s, [int(s)]
                while front:
                    new = of(front.pop())
                    new = new[root[new] < 0]
                    root[new] = s
                    front.extend(new.tolist())
        for i in np.flatnonzero(root >= 0):
            out_id.append(names[i])
            out_n.append(int(n[i]))
            out_root.append(names[root[i]])
    return pa.table(
        {"text_id": pa.array(out_id, pa.binary()), "n_links": pa.array(out_n, pa.int64()), "root": pa.array(out_root, pa.binary())}
    )


def _place(key: str, text_id: str) -> Column:
    return F.pmod(F.xxhash64(key, text_id), F.lit(FILTER_BITS))


def _filter_bits(members: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS in which every member (rep, member) has its bit set."""
    bit = members.select(_place("rep", "member").alias("p"))
    words = bit.groupBy(F.expr("p div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits"))
    rows, out = words.toArrow(), np.zeros(FILTER_BITS // 64, np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _member_shingles(docs: DataFrame, key: str, text: str, members: DataFrame) -> DataFrame:
    """(text_id, copies, part, size, shingles) of the row of ``docs`` that stands for each member.

    A bitmap of fixed size leaves out almost all other rows where they are
    read, so only the members' sets are moved, to the exact join.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(members))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            place = whole.column("place").to_numpy()
            hit = bits.value[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)
            some = whole.take(pa.array(np.flatnonzero(hit)))
            for i in range(0, some.num_rows, SLICE):
                batch = some.slice(i, SLICE)
                flat, first = _shingles(batch.column("text"))
                sets = [flat[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("text_id"), pa.array(sets, pa.binary())], ["key", "text_id", "shingles"]
                )

    own = docs.select(F.col(key).alias("key"), _identity(F.col(text)).alias("text_id"), F.col(text).alias("text"))
    sets = own.withColumn("place", _place("key", "text_id")).mapInArrow(lean(run), f"key {kind}, text_id binary, shingles binary")
    same = (F.col("text_id") == F.col("member")) & F.col("key").eqNullSafe(F.col("rep"))
    return sets.join(members.hint("merge"), same).select("text_id", "copies", "part", "size", "shingles")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", bucket: int = BUCKET, block: int = BLOCK, recall: float = RECALL
) -> DataFrame:
    """(key, text_id, class_id, group_id, n_links, keep, n_rows) of every row.

    Two texts are linked if their sets of five-word shingles have a Jaccard
    similarity of 0.8 or more. ``class_id`` is the least key of the equal
    texts, ``group_id`` that of all texts connected by links, ``n_links`` the
    number of other rows linked to the row, its copies among them. ``keep``
    marks the one document of each group that stays: that of the least key.
    ``n_rows`` tells how many rows have this key and text.

    Equal texts are reduced to one set first. Chosen paths connect the sets
    that may be similar, in runs that are repeated until one measures
    ``recall`` (see ``connected_parts``); each connected part is then compared
    exactly, all pairs of it: parts of up to ``block`` sets at once, larger ones
    as pairs of blocks. So a link is lost only if no path of any run joins its part.

    A null text, or one without a word, is linked to nothing, is a class and
    group by itself (its own key) and is kept. A null key comes last: it names
    a class or group only if no row of it has a key. Repeated rows are copies.
    Texts that share their key and group: the least text identity is kept.
    Extra columns are not read.
    """
    rows = written(_sketches(docs, key, text))
    sets = written(
        rows.filter("n > 0")
        .groupBy("text_id")
        .agg(F.min("key").alias("rep"), F.count("*").alias("copies"), F.first("tokens").alias("tokens"))
    )
    parts, _ = connected_parts(sets, bucket=bucket, recall=recall)
    n_small = max(1, -(-parts.count() // block))
    sizes = written(parts.groupBy("root").agg(F.count("*").alias("size")))
    members = written(
        parts.join(sizes, "root")
        .join(sets.select(F.col("text_id").alias("node"), "rep", "copies"), "node")
        .select(F.col("node").alias("member"), "rep", "copies", F.xxhash64("root").alias("part"), "size")
    )
    small = F.col("size") <= block
    n = F.ceil(F.col("size") / F.lit(block)).cast("int")
    compared = (
        _member_shingles(docs, key, text, members)
        .withColumn("small", small)
        .withColumn("block", F.when(small, 0).otherwise(F.pmod(F.xxhash64("text_id"), n)).cast("int"))
        .withColumn("other", F.explode(F.when(small, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1))))
        .withColumn("cross", F.col("block") != F.col("other"))
        .withColumn(
            "group",
            F.when(F.col("small"), F.col("part")).otherwise(
                F.xxhash64("part", F.least("block", "other"), F.greatest("block", "other"))
            ),
        )
        .withColumn("task", F.when(F.col("small"), F.pmod("group", F.lit(n_small))).otherwise(F.col("group")))
    )
    found = written(
        compared.select("small", "task", "group", "text_id", "copies", "block", "cross", "shingles")
        .groupBy("small", "task")
        .applyInArrow(_links, "text_id binary, n_links long, root binary")
    )
    links = found.groupBy("text_id").agg(F.sum("n_links").alias("links"))
    groups = components(found.select(F.col("text_id").alias("a"), F.col("root").alias("b")))
    named = written(
        sets.select("text_id", "rep", "copies")
        .join(groups.select(F.col("node").alias("text_id"), "root"), "text_id", "left")
        .join(links, "text_id", "left")
        .withColumn("root", F.coalesce("root", "text_id"))
    )
    best = F.min(F.struct(F.col("rep").isNull().alias("last"), F.col("rep").alias("group_id"), F.col("text_id").alias("chosen")))
    least = written(named.groupBy(F.col("root").alias("of")).agg(best.alias("best")).select("of", "best.group_id", "best.chosen"))
    results = written(
        named.join(least, F.col("root") == F.col("of")).select(
            F.col("text_id").alias("id"), "rep", "copies", "links", "group_id", (F.col("text_id") == F.col("chosen")).alias("stays")
        )
    )
    repeated = rows.groupBy("key", "text_id").agg(F.count("*").alias("n_rows"), F.max("n").alias("n_shingles"))
    linked = F.col("id").isNotNull()
    return (
        repeated.join(results, (F.col("text_id") == F.col("id")) & (F.col("n_shingles") > 0), "left")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
        .select(
            F.col("key").alias(key),
            "text_id",
            F.when(linked, F.col("rep")).otherwise(F.col("key")).alias("class_id"),
            F.when(linked, F.col("group_id")).otherwise(F.col("key")).alias("group_id"),
            F.when(linked, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
            (~linked | (F.col("stays") & F.col("key").eqNullSafe(F.col("rep")))).alias("keep"),
            F.when(linked, F.col("n_rows")).otherwise(F.lit(1)).alias("n_rows"),
        )
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group (see ``near_duplicates``).

    Of rows that repeat both key and text, the first by their other columns
    stays. ``docs`` is read twice.
    """
    found = written(near_duplicates(docs, key, text, **options).distinct())
    mark = lambda x: x.select(F.col(key).alias("__key"), F.col("text_id").alias("__id"))
    same = (_identity(F.col(text)).eqNullSafe(F.col("__id"))) & F.col(key).eqNullSafe(F.col("__key"))
    kept = docs.join(mark(found.filter("NOT keep")), same, "left_anti")
    many = found.filter("keep AND n_rows > 1")
    if many.isEmpty():
        return kept
    place = Window.partitionBy(key, text).orderBy(*[c for c in docs.columns if c not in (key, text)] or [F.lit(1)])
    one = kept.join(mark(many), same, "left_semi").withColumn("__n", F.row_number().over(place)).filter("__n = 1").drop("__n")
    return kept.join(mark(many), same, "left_anti").unionByName(one)
