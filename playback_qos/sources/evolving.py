"""Parquet files whose schemas differ: one frame of the widest types, and the history of that schema.

Spark unites the columns of files (``mergeSchema``) but refuses two types of
one column. Here types meet in a lattice (int -> long -> double -> string), so a
column that was added, widened or retyped in some files neither stops a reader
nor loses a value.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each holds all values of those before it.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType)


def _rank(t: T.DataType) -> int | None:
    if isinstance(t, T.FloatType):
        return len(_NUMBERS) - 1
    return _NUMBERS.index(type(t)) if type(t) in _NUMBERS else None


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text if nothing else does (of structured values: their JSON)."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return unite(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        if a.keyType == b.keyType:
            return T.MapType(a.keyType, widest(a.valueType, b.valueType))
        return T.StringType()
    ranks = _rank(a), _rank(b)
    if None not in ranks:
        return _NUMBERS[max(ranks)]()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def unite(a: T.StructType, b: T.StructType) -> T.StructType:
    """All fields of ``a`` and then the others of ``b``, each of the widest type; all may be null."""
    have = {f.name: f.dataType for f in b.fields}
    fields = [T.StructField(f.name, widest(f.dataType, have.pop(f.name, f.dataType))) for f in a.fields]
    return T.StructType(fields + [T.StructField(n, t) for n, t in have.items()])


def widened(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` of type ``have`` as the wider type ``want``; missing fields are null."""
    if have == want:
        return c
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        names = have.fieldNames()
        fields = [(widened(c.getField(f.name), have[f.name].dataType, f.dataType) if f.name in names
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: widened(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(c, lambda _, v: widened(v, have.valueType, want.valueType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, which is as wide as its own or wider."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (widened(df[_quoted(f.name)], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _read(spark: SparkSession, table: str, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("mergeSchema", "true").option("basePath", table).parquet(*paths)


def _groups(spark: SparkSession, table: str, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files by a schema that Spark can unite: footers are read in parallel, and halves apart where two types collide."""
    try:
        return [(_read(spark, table, paths).schema, paths)]
    except (PySparkException, Py4JJavaError) as e:  # a failed footer task is raised as it is
        if len(paths) == 1 or "CANNOT_MERGE" not in str(e):
            raise
    half = len(paths) // 2
    found: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, own in _groups(spark, table, paths[:half]) + _groups(spark, table, paths[half:]):
        found.setdefault(schema.json(), (schema, []))[1].extend(own)
    return list(found.values())


def read_files(
    spark: SparkSession, table: str, paths: Sequence[str], declared: T.StructType | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Rows of some Parquet files of a table, directory columns included, whatever types each file has.

    Columns differ in type only where files do: they get the widest one. A
    directory column has the type that ``declared`` gives it, also where all its
    values are null. Columns in ``drop`` are left out.
    """
    frames = []
    for schema, own in _groups(spark, table, list(paths)):
        df = _read(spark, table, own).drop(*drop)
        for f in declared.fields if declared is not None else ():
            if f.name in df.columns and f"/{f.name}=" in own[0] and df.schema[f.name].dataType != f.dataType:
                df = df.withColumn(f.name, F.col(_quoted(f.name)).cast(f.dataType))
        frames.append(df)
    schema = frames[0].schema
    for df in frames[1:]:
        schema = unite(schema, df.schema)
    out = frames[0] if len(frames) == 1 else conform(frames[0], schema)
    for df in frames[1:]:
        out = out.unionAll(conform(df, schema))
    return out


def try_contract(df: DataFrame, declared: T.StructType) -> DataFrame:
    """``df`` with the declared columns in their declared types: a value that does not fit is null; other columns stay.

    Of a structured column with another type only what it shares with the
    declared one is kept, by field names.
    """

    def fitted(c: Column, have: T.DataType, want: T.DataType) -> Column:
        if have == want:
            return c
        if isinstance(have, T.StructType) and isinstance(want, T.StructType):
            names = have.fieldNames()
            fields = [(fitted(c.getField(f.name), have[f.name].dataType, f.dataType) if f.name in names
                       else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
            fields += [c.getField(n).alias(n) for n in names if n not in want.fieldNames()]
            return F.when(c.isNotNull(), F.struct(*fields))
        if isinstance(have, T.MapType) and isinstance(want, T.MapType) and have.keyType == want.keyType:
            return F.transform_values(c, lambda _, v: fitted(v, have.valueType, want.valueType))
        structured = (T.StructType, T.MapType, T.ArrayType)
        if isinstance(want, structured):
            if isinstance(have, T.StringType) and isinstance(want, (T.StructType, T.MapType)):
                return F.from_json(c, want)
            return F.lit(None).cast(want)
        if isinstance(have, structured):
            return F.to_json(c) if isinstance(want, T.StringType) else F.lit(None).cast(want)
        if isinstance(have, T.StringType) and _rank(want) is not None and not isinstance(want, T.DoubleType):
            return F.coalesce(c.try_cast(want), c.try_cast("double").try_cast(want))
        return c.try_cast(want)

    have = {f.name: f.dataType for f in df.schema.fields}
    changed = {f.name: fitted(F.col(_quoted(f.name)), have[f.name], f.dataType)
               for f in declared.fields if f.name in have and have[f.name] != f.dataType}
    return df.withColumns(changed) if changed else df


@dataclass
class SchemaHistory:
    """Versions of a table's schema, one small file each beside a query's checkpoint.

    Each micro-batch adds what its files bring: a version is written before any
    row of it, so a replay and a restart go on with the same columns and types.
    """

    spark: SparkSession
    folder: str

    def _fs(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[T.StructType]:
        path, fs = self._fs()
        if not fs.exists(path):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("v"))
        return [T.StructType.fromJson(json.loads(self._text(fs, name))) for name in names]

    def _text(self, fs, name: str) -> str:
        jvm = self.spark.sparkContext._jvm
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}"))
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def extend(self, found: T.StructType) -> T.StructType:
        """The schema that holds all versions and ``found``; a new version if that is wider than the last."""
        known = self.versions()
        schema = unite(known[-1], found) if known else unite(found, found)
        if not known or schema != known[-1]:
            path, fs = self._fs()
            jvm = self.spark.sparkContext._jvm
            part, whole = (jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{p}{len(known):06d}.json") for p in (".new-", "v"))
            out = fs.create(part, True)
            out.write(schema.json().encode())
            out.close()
            fs.rename(part, whole)
        return schema
