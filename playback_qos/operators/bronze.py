"""Bronze layer: required ids, and deduplication on the business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playback_qos.functions.paths import col_or_null
from playback_qos.schema import KEYS


def minimal_validation(df: DataFrame) -> DataFrame:
    """Keep rows whose three ids are non-null (``eventDate`` is not checked)."""
    return df.filter(
        F.col("customerId").isNotNull()
        & F.col("contentId").isNotNull()
        & F.col("clientId").isNotNull()
    )


def dedupe(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per key (nulls compare equal); the survivor is arbitrary.

    Works on batch and streaming frames (a stream keeps every key in state;
    see ``streaming.jobs.dedupe_stream`` for the bounded form).
    """
    return df.dropDuplicates(list(keys))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _unordered(t: T.DataType) -> bool:
    """True for types that hold a map or variant, which Spark does not compare."""
    if isinstance(t, T.StructType):
        return any(_unordered(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _unordered(t.elementType)
    return isinstance(t, (T.MapType, T.VariantType))


def comparable(c: Column, t: T.DataType) -> Column:
    """``c`` in a form that compares and hashes by its content: maps as sorted entries, variants as JSON, at any depth."""
    if not _unordered(t):
        return c
    if isinstance(t, T.VariantType):
        return F.to_json(c)
    if isinstance(t, T.MapType):
        entries = F.map_entries(c)
        if _unordered(t.valueType):
            entries = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), comparable(e["value"], t.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: comparable(x, t.elementType))
    return F.when(c.isNotNull(), F.struct(*[comparable(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))


def restored(c: Column, t: T.DataType) -> Column:
    """Inverse of :func:`comparable`."""
    if not _unordered(t):
        return c
    if isinstance(t, T.VariantType):
        return F.parse_json(c)
    if isinstance(t, T.MapType):
        if _unordered(t.valueType):
            c = F.transform(c, lambda e: F.struct(e["key"].alias("key"), restored(e["value"], t.valueType).alias("value")))
        return F.map_from_entries(c)
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: restored(x, t.elementType))
    return F.when(c.isNotNull(), F.struct(*[restored(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))


def row_digest(schema: T.StructType) -> list[Column]:
    """Two 64-bit hashes of a whole row, equal for equal rows whatever the order of a map's entries."""
    whole = F.struct(*[comparable(F.col(_quoted(f.name)), f.dataType).alias(f"_c{i}") for i, f in enumerate(schema.fields)])
    return [F.xxhash64(whole).alias("_digest0"), F.xxhash64(F.lit(1), whole).alias("_digest1")]


def first_row(schema: T.StructType, payload: Sequence[str], order: Sequence[str]):
    """Aggregate (to be named ``_best``) that picks the first row of a group, and the columns it gives back.

    Rows that tie on ``order`` are told apart by all payload columns in turn,
    so the choice never depends on how rows are partitioned. The least struct
    of order and payload columns is kept; maps and variants, at any depth, take
    part as their sorted entries and JSON.
    """
    types = {c: schema[c].dataType for c in payload}
    ties = [comparable(F.col(_quoted(c)), t).alias(f"_p{i}") for i, (c, t) in enumerate(types.items())]
    best = F.min(F.struct(*[col_or_null(schema, c).alias(f"_o{i}") for i, c in enumerate(order)], *ties))
    back = {c: restored(F.col(f"_best._p{i}"), t).alias(c) for i, (c, t) in enumerate(types.items())}
    return best, back


def dedupe_first(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ("serverTimestamp", "agentTimestamp"),
    digest: Sequence[str] | None = None,
) -> DataFrame:
    """Deterministic dedupe: per key keep the row that is first by ``order``, then by all other columns.

    Same result as ``row_number() over (partition by keys order by order, payload) = 1``
    with nulls first, but planned as an aggregate: the partial aggregate keeps
    one candidate per key and map task before the shuffle, so a key holding a
    third of all rows never lands whole in one task (a window would sort all
    of that key's rows in one task). Spark runs it as a sort aggregate because
    the buffer holds a row struct, as it does for ``dropDuplicates`` over
    non-primitive columns. Order columns may be nested paths.

    With ``digest``, columns that hold a digest of the row (:func:`row_digest`),
    ties go by these instead, and they are not returned. Then the choice is the
    same whichever of the row's other columns are left in ``df``, which may be of any type.
    """
    keys = list(keys)
    schema = df.schema
    columns = [c for c in schema.names if c not in (digest or ())]
    payload = [c for c in columns if c not in keys]
    if digest:
        rank = F.struct(*[col_or_null(schema, c).alias(f"_o{i}") for i, c in enumerate(order)], *digest)
        best = F.min_by(F.struct(*[F.col(_quoted(c)).alias(f"_p{i}") for i, c in enumerate(payload)]), rank)
        back = {c: F.col(f"_best._p{i}").alias(c) for i, c in enumerate(payload)}
    else:
        best, back = first_row(schema, payload, order)
    out = {c: F.col(_quoted(c)) for c in keys} | back
    return df.groupBy(*[_quoted(k) for k in keys]).agg(best.alias("_best")).select(*[out[c] for c in columns])


def bronze(df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] | None = None) -> DataFrame:
    """Raw -> Bronze: id filter then dedupe (first by ``order`` if given)."""
    valid = minimal_validation(df)
    if order:
        digests = row_digest(valid.schema)
        return dedupe_first(valid.select("*", *digests), keys, order, digest=("_digest0", "_digest1"))
    return dedupe(valid, keys)
