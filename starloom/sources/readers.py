"""Schema-enforced reads."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str


def _struct(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_json(spark: SparkSession, path: str | list[str], schema: Schema | None = None, glob: str | None = None) -> DataFrame:
    """JSON lines from a directory tree or a wildcard path.

    Without a schema Spark reads the data twice to infer one.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    wildcard = any(set("*?[{") & set(p) for p in ([path] if isinstance(path, str) else path))
    if not wildcard:
        reader = reader.option("recursiveFileLookup", True)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: Schema | None = None, **options: str) -> DataFrame:
    """CSV with a header; all strings unless a schema is given."""
    reader = spark.read.option("header", True).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def _path_parts(path: str) -> list[str]:
    parts = re.findall(r"\['([^']+)'\]|\.([^.\[\]]+)", path)
    if not path.startswith("$") or not parts:
        raise ValueError(f"not a JSON field path: {path!r}")
    return [quoted or plain for quoted, plain in parts]


def _nested_schema(leaves: Mapping[tuple[str, ...], T.DataType]) -> T.StructType:
    heads: dict[str, dict[tuple[str, ...], T.DataType]] = {}
    for parts, kind in leaves.items():
        heads.setdefault(parts[0], {})[parts[1:]] = kind
    return T.StructType([
        T.StructField(head, rest[()] if () in rest else _nested_schema(rest)) for head, rest in heads.items()
    ])


def _by_paths(paths: Mapping[str, str], kinds: T.StructType) -> tuple[T.StructType, dict[str, list[str]]]:
    parts = {name: _path_parts(path) for name, path in paths.items()}
    return _nested_schema({tuple(p): kinds[name].dataType for name, p in parts.items()}), parts


def _descend(root: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda c, part: c.getField(part), parts, root)


def json_fields(df: DataFrame, text: str, paths: Mapping[str, str], schema: Schema) -> DataFrame:
    """``df`` with columns picked out of a JSON text column by field paths, with a single parse per row.

    The parsed record is a generator's output, which the optimiser does not copy
    into every picked column.
    """
    nested, parts = _by_paths(paths, _struct(schema))
    parsed = df.select("*", F.explode(F.array(F.from_json(text, nested))).alias("_json"))
    return parsed.select(*df.columns, *[_descend(F.col("_json"), p).alias(name) for name, p in parts.items()])


def stage_json(spark: SparkSession, path: str | list[str], schema: Schema, paths: Mapping[str, str] | str = "auto") -> DataFrame:
    """Load JSON records into the columns of ``schema``.

    ``paths`` maps a column to a field path such as ``$['userId']`` or
    ``$.user.id``. With ``"auto"`` a column takes the key of its own name,
    whatever the letter case. A record is parsed once in both modes; text that
    does not fit a column's type becomes null.
    """
    kinds = _struct(schema)
    if paths != "auto":
        nested, parts = _by_paths(paths, kinds)
        records = read_json(spark, path, nested)
        return records.select(*[_descend(F.col(f"`{p[0]}`"), p[1:]).alias(name) for name, p in parts.items()])
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    fields = lines.select(F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v"))).alias("f"))

    def pick(field: T.StructField) -> Column:
        hits = F.filter("f", lambda e: e["k"] == F.lit(field.name.lower()))
        return F.try_element_at(hits, F.lit(1))["v"].try_cast(field.dataType).alias(field.name)

    return fields.select(*[pick(field) for field in kinds])


def consolidate_csv(spark: SparkSession, path: str | list[str], keep: Mapping[int, str], require: int) -> DataFrame:
    """Many headed CSV files as one frame of the columns at the given positions.

    Rows whose ``require`` position is empty are dropped. Files are matched by
    position, so their header texts may differ.
    """
    width = max(*keep, require) + 1
    positional = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    raw = read_csv(spark, path, positional, recursiveFileLookup="true")
    return keep_required(raw, f"_c{require}").select(*[F.col(f"_c{i}").alias(name) for i, name in keep.items()])


def keep_required(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text column is neither null nor empty."""
    return df.where(F.col(column) != "")


def _first_line(spark: SparkSession, path: str) -> str:
    """First line of a stored file, through Hadoop's readers, so that any store and compression will do."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).open(file)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def _by_header(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """CSV files below the paths, grouped by their header lines."""
    groups: dict[str, list[str]] = {}
    for path in sorted(spark.read.option("recursiveFileLookup", True).text(list(paths)).inputFiles()):
        groups.setdefault(_first_line(spark, path), []).append(path)
    return groups


def read_union(spark: SparkSession, paths: Sequence[str], schema: Schema, fmt: str = "parquet") -> DataFrame:
    """Files that share columns but differ in extra ones, projected to ``schema``.

    CSV is positional: files are grouped by header, one reader for each distinct
    header, and a file that breaks its group's header fails. The driver reads
    one line a file. A column that no file has is an error, in CSV and Parquet.
    """
    kinds = _struct(schema)
    if fmt == "parquet":
        present = set(spark.read.option("mergeSchema", True).parquet(*paths).columns)
        if absent := [f.name for f in kinds if f.name not in present]:
            raise ValueError(f"columns {absent} are in no file of {list(paths)}")
    if fmt != "csv":
        return spark.read.schema(kinds).format(fmt).load(list(paths))
    frames, present = [], set()
    for files in _by_header(spark, paths).values():
        frame = read_csv(spark, files, enforceSchema="false")
        present.update(frame.columns)
        at = {c: F.col(f"`{c}`") for c in frame.columns}
        frames.append(frame.select(*[at.get(f.name, F.lit(None)).try_cast(f.dataType).alias(f.name) for f in kinds]))
    if absent := [f.name for f in kinds if f.name not in present]:
        raise ValueError(f"columns {absent} are in no file of {list(paths)}")
    return reduce(DataFrame.unionByName, frames)


def union_frames(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Frames reduced to common columns, stacked with their duplicates."""
    return reduce(DataFrame.unionByName, [f.select(*columns) for f in frames])


def register(spark: SparkSession, views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
