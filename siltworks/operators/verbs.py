"""Query verbs over JSON-lines documents: select, where, merge, split, drop, sorting, plain functions, and the pipeline's filters."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.text import escape_newlines

_FIELD = re.compile(r"\{(\w+)\}")


def expression(text: str) -> Column:
    """A Spark SQL expression in which ``{field}`` names a column; nothing is evaluated in Python."""
    return F.expr(_FIELD.sub(r"`\1`", text))


def column_text(df: DataFrame, column: str, newline: str | None = None) -> Column:
    """A field, ``*`` (the whole document as JSON) or an expression, as text; a missing field reads as empty."""
    if column == "*":
        value = F.to_json(F.struct("*"))
    elif re.fullmatch(r"\w+", column):
        value = df[column].cast("string") if column in df.columns else F.lit("")
    else:
        value = expression(column).cast("string")
    return escape_newlines(value, newline) if newline else value


def select(df: DataFrame, columns: list[str], skip_empty: bool = False, separator: str = "\t", newline: str | None = None) -> DataFrame:
    """One ``line`` per document; nulls print as ``None``, or drop the document with ``skip_empty``."""
    values = [column_text(df, c, newline) for c in columns]
    if skip_empty:
        for v in values:
            df = df.filter(v.isNotNull())
    return df.select(F.concat_ws(separator, *[F.coalesce(v, F.lit("None")) for v in values]).alias("line"))


def where(df: DataFrame, clauses: list[str]) -> DataFrame:
    """Documents for which all clauses hold; null does not hold."""
    for clause in clauses:
        df = df.filter(F.coalesce(expression(clause).cast("boolean"), F.lit(False)))
    return df


_TYPES = {"f": "double", "i": "bigint", "b": "boolean", "s": "string"}


def merge(lines: DataFrame, columns: list[str], separator: str = "\t", line: str = "line") -> DataFrame:
    """Fields from separated text: ``name%type`` with f, i, b or s (default s); a bad value is null.

    ``_`` is a JSON object, whose schema follows as in ``_%a int, b string``: its fields join the row, and those of the same name before it. Without a
    schema it stays a map from names to texts, ``merged``.
    """
    parts = F.split(lines[line], re.escape(separator))
    out: dict[str, Column] = {}
    for i, spec in enumerate(columns):
        name, _, kind = spec.partition("%")
        value = F.get(parts, F.lit(i))
        if name != "_":
            out[name] = value.try_cast(_TYPES[kind or "s"])
        elif not kind:
            out["merged"] = F.from_json(value, "map<string,string>")
        else:
            parsed = F.from_json(value, kind)
            out |= {field.name: parsed[field.name] for field in T._parse_datatype_string(kind).fields}
    return lines.select(*[c.alias(name) for name, c in out.items()])


def map_documents(df: DataFrame, fn: Callable[[dict], dict | None], schema: str) -> DataFrame:
    """``fn`` of every document as a dictionary, an Arrow batch at a time; None drops it. What has no expression goes here."""
    return map_stream(df, lambda docs: (x for x in map(fn, docs) if x is not None), schema)


def map_stream(df: DataFrame, fn: Callable[[Iterator[dict]], Iterable[dict]], schema: str) -> DataFrame:
    """``fn`` from the documents of a partition to any number of documents, as a stream."""
    fields = T._parse_datatype_string(schema)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, rows = to_arrow_schema(fields), []
        for doc in fn(x for b in batches for x in b.to_pylist()):
            rows.append({name: doc.get(name) for name in arrow.names})
            if len(rows) >= 5_000:
                yield pa.RecordBatch.from_pylist(rows, arrow)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, arrow)

    return df.mapInArrow(run, fields)


def sorted_head(df: DataFrame, column: str, n: int, descending: bool = False, numeric: bool = True) -> DataFrame:
    """The first ``n`` documents by a column read as a number (or as it is): a limit on a sort, which keeps ``n`` rows a task."""
    value = df[column].try_cast("double") if numeric else df[column]
    others = [c for c in df.columns if c != column]
    return df.orderBy(value.desc_nulls_last() if descending else value.asc_nulls_last(), *others).limit(n)


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``row``, from 0 in the given order: a sort by ranges, of which only the sizes come together."""
    from siltworks.session import materialize

    ranged = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", 33)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # a row a partition
    starts, total = {}, 0
    for r in sizes:
        starts[r["part"]], total = total, total + r["n"]
    before = df.sparkSession.createDataFrame(list(starts.items()) or [(0, 0)], "part bigint, before bigint")
    rows = ranged.withColumn("part", part).join(F.broadcast(before), "part")
    return rows.withColumn("row", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "before", "at")


def grouped(df: DataFrame, n: int, *order: str) -> DataFrame:
    """``df`` with ``group``: every ``n`` consecutive rows in the given order are one."""
    return numbered(df, *order).withColumn("group", F.floor(F.col("row") / n)).drop("row")


def drop_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.drop(*keys)


def remove_small(df: DataFrame, field: str, min_len: int) -> DataFrame:
    """Documents whose ``field`` has ``min_len`` characters or more; null is empty."""
    return df.filter((F.length(F.coalesce(df[field], F.lit(""))) >= min_len) & (F.length(F.coalesce(df[field], F.lit(""))) > 0))


def keep_lang(df: DataFrame, language: str = "language", whitelist: tuple[str, ...] = (), blacklist: tuple[str, ...] = ()) -> DataFrame:
    """A blacklist takes priority over a whitelist; without either all documents stay. Null is in no list."""
    if blacklist:
        return df.filter(~F.coalesce(df[language].isin(*blacklist), F.lit(False)))
    return df.filter(df[language].isin(*whitelist)) if whitelist else df


def keep_bucket(df: DataFrame, buckets: tuple[str, ...], bucket: str = "bucket") -> DataFrame:
    return df.filter(F.coalesce(df[bucket], F.lit("all")).isin(*buckets)) if buckets else df


def split_name(df: DataFrame, pattern: str) -> Column:
    """The name of a document's split from a pattern with ``{field}``; null (dropped on writing) if a field is null or empty."""
    parts, at = [], 0
    for m in _FIELD.finditer(pattern):
        if m.group(1) not in df.columns:
            raise KeyError(m.group(1))
        value = df[m.group(1)].cast("string")
        parts += [F.lit(pattern[at : m.start()]), F.when(value != "", value)]
        at = m.end()
    return F.concat(*parts, F.lit(pattern[at:]))


def split_counts(df: DataFrame, pattern: str) -> DataFrame:
    """``split, docs`` of what ``split_name`` would write."""
    return df.select(split_name(df, pattern).alias("split")).filter("split is not null").groupBy("split").agg(F.count("*").alias("docs"))
