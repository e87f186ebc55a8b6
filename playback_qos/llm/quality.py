"""Rule counts of a text, and its hashed n-gram log-likelihood ratio of target against raw corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import NOT_BLANK, byte_set, hash_words, mix, scan_words, text_bytes, window_hashes

#: Words and pairs of words are hashed to 2 ** BITS features.
BITS = 16
#: Added to each feature's count in either multinomial.
SMOOTHING = 1.0
#: Labelled rows taken as the trusted target, at most: those with the smallest hashes of their ids.
TARGET_ROWS = 16_384
#: A text is kept if the mean log-ratio of its features is not below this.
THRESHOLD = -0.15
#: Words of a window that may repeat, and the rules' limits.
REPEAT = 3
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Rows that are in hand at once.
SLICE = 512

_SYMBOLS = byte_set(b"#*$%&|<>")
_BLANK = " \t\x0b\x0c\r"


def _words(column: pa.Array) -> tuple:
    data, offsets = text_bytes(column)
    words = scan_words(data, offsets, NOT_BLANK)
    return data, offsets, words, hash_words(data, words)


def _windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word, and row, of each window within a row."""
    n = np.maximum(np.diff(first) - width + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    return first[:-1][row] + np.arange(len(row)) - (np.cumsum(n) - n)[row], row


def _features(first: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature and row of each word and each pair of neighbours."""
    shift = np.uint64(64 - BITS)
    at, row = _windows(first, 2)
    pairs = window_hashes(hashes, 2)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    feature = np.concatenate([hashes >> shift, pairs[at] >> shift if len(at) else hashes[:0]])
    return feature.astype(np.int64), np.concatenate([rows, row])


def feature_counts(docs: DataFrame, text: str, target: Column) -> DataFrame:
    """(feature, n_raw, n_target) over every text of ``docs``; ``target`` marks the trusted rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int64)
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                batch = whole.slice(i, SLICE)
                _, _, words, hashes = _words(batch.column("text"))
                feature, row = _features(words.first, hashes)
                chosen = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
                total[0] += np.bincount(feature, minlength=1 << BITS)
                if chosen.any():
                    total[1] += np.bincount(feature[chosen[row]], minlength=1 << BITS)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[0][used]), pa.array(total[1][used])], ["feature", "n_raw", "n_target"])

    return (
        docs.select(F.col(text).alias("text"), F.coalesce(target, F.lit(False)).alias("target"))
        .mapInArrow(count, "feature long, n_raw long, n_target long")
        .groupBy("feature")
        .agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target"))
    )


def fit_weights(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Log-ratio of each feature between the trusted target and the whole corpus.

    The target is the rows labelled of good quality and not toxic, TARGET_ROWS
    of them at most (a bound on what is broadcast); the raw counts cover all
    texts. Without any target row all weights are 0.
    """
    trusted = (
        labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("__target"))
        .distinct()
        .orderBy(F.xxhash64("__target"), "__target")
        .limit(TARGET_ROWS)
    )
    marked = docs.select(key, text).join(F.broadcast(trusted), F.col(key) == F.col("__target"), "left")
    rows = feature_counts(marked, text, F.col("__target").isNotNull()).toArrow()  # 2 ** BITS rows at most
    counts = np.full((2, 1 << BITS), SMOOTHING)
    at = rows.column("feature").to_numpy()
    counts[0, at] += rows.column("n_raw").to_numpy()
    counts[1, at] += rows.column("n_target").to_numpy()
    if counts[1].sum() == SMOOTHING * (1 << BITS):
        return np.zeros(1 << BITS)
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1]) - np.log(share[0])


def _line_counts(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    if not text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines))


def _rules(batch: pa.RecordBatch, weights: np.ndarray) -> list[pa.Array]:
    data, offsets, words, hashes = _words(batch.column("text"))
    first, n = words.first, np.diff(words.first)

    def per_row(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])

    inside = NOT_BLANK[data]
    chars = per_row(inside & ((data & 0xC0) != 0x80))
    at, row = _windows(first, REPEAT)
    seen = window_hashes(hashes, REPEAT)[at] if len(at) else hashes[:0]
    seen = mix(seen + mix(row.astype(np.uint64) + np.uint64(1)))  # windows are compared within a row
    order = np.argsort(seen)
    same = seen[order][1:] == seen[order][:-1]
    twice = np.zeros(len(seen), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for k in range(REPEAT):
        covered[at[twice] + k] = True
    repeat = np.diff(np.concatenate(([0], np.cumsum(covered)))[first])
    feature, owner = _features(first, hashes)
    size = np.bincount(owner, minlength=len(n))
    total = np.bincount(owner, weights[feature], len(n))
    mean = np.where(size > 0, total / np.maximum(size, 1), 0.0)
    lines = [_line_counts(x) for x in batch.column("text").to_pylist()]
    return [pa.array(x, pa.int64()) for x in (n, chars, per_row(_SYMBOLS[data]), lines, repeat)] + [pa.array(mean)]


def quality(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rule counts, mean log-ratio and verdict of every whole text.

    Returns (key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    log_ratio, base_failed, kept). A null or empty text has 0 of everything, a
    ratio of 0, and fails. Rows are judged alone: repeated rows agree, nothing
    is shuffled, extra columns are not read. A ratio equal to the threshold is
    kept.
    """
    held = docs.sparkSession.sparkContext.broadcast(weights)
    names = ["key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ratio"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                batch = whole.slice(i, SLICE)
                yield pa.RecordBatch.from_arrays([batch.column("key"), *_rules(batch, held.value)], names)

    kind = docs.schema[key].dataType.simpleString()
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(run, f"key {kind}, " + ", ".join(f"{x} long" for x in names[1:-1]) + ", log_ratio double")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))
        .withColumnRenamed("key", key)
    )
