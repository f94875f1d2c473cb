"""JSON-lines files: one document per line, one file or folder per collection."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimeter import constants as K
from perimeter.functions.scalars import parsed, struct
from perimeter.schemas import (
    CORRUPT_COLUMN,
    INGRESS_RULE,
    PARSED_LIST,
    PARTIAL_COLUMN,
    ROUTE_RULE,
    document_schema,
    reading_schema,
)

REGION_COLUMN = "region"
# Lists whose elements are documents themselves, and the elements' schema.
_LISTS = {
    "routes": ("routeRules", ROUTE_RULE),
    "securitylists": ("ingressSecurityRules", INGRESS_RULE),
}
_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT_COLUMN}
_OPTIONS_SQL = f"map('columnNameOfCorruptRecord', '{CORRUPT_COLUMN}')"
# Key under which a line is parsed with its lists; new in every process, so that no document can hold it.
_LINE_KEY = f"line-{uuid.uuid4().hex}"


def read_lines(
    spark: SparkSession,
    collection: str,
    paths: str | list[str],
    file_column: str | None = None,
    with_lists: bool = False,
) -> DataFrame:
    """Every non-blank line of the files as a document row, readable or not.

    A path that isn't there raises; an empty list gives an empty collection. ``file_column``
    names a column that receives the path of each line's file. ``with_lists`` adds the parsed list
    of routes and security lists as ``PARSED_LIST``, for ``typed``, in place of the list's text.
    """
    lines = spark.read.text(paths) if paths else spark.createDataFrame([], "value string")
    file_path = F.col("_metadata.file_path") if paths else F.lit(None).cast("string")
    kept = [file_path.alias(file_column)] if file_column else []
    lines = lines.where(F.trim("value") != "")
    if with_lists and collection in _LISTS:
        return _parsed_with_lists(collection, lines, kept, [file_column] if file_column else [])
    # Being generated, the document is parsed once for the filter and the fields above it.
    parsed_line = F.from_json("value", reading_schema(collection), _OPTIONS)
    rows = lines.select("value", *kept, F.explode(F.array(parsed_line)).alias("_document"))
    columns = ["_document.*", PARTIAL_COLUMN, *([file_column] if file_column else [])]
    broken = _broken(collection, "_document", _list_of("_document", collection) if collection in _LISTS else None)
    return rows.withColumn(PARTIAL_COLUMN, F.expr(broken)).select(*columns)


def _ddl(schema: T.DataType) -> str:
    """A schema as text, names quoted at every depth."""
    if isinstance(schema, T.ArrayType):
        return f"array<{_ddl(schema.elementType)}>"
    if isinstance(schema, T.StructType):
        return f"struct<{', '.join(f'`{f.name}`:{_ddl(f.dataType)}' for f in schema)}>"
    return schema.simpleString()


def _list_of(document: str, collection: str) -> str:
    field, schema = _LISTS[collection]
    return parsed(f"{document}.additional_details.{field}", schema)


def _objects(schema: T.StructType, document: str) -> list[str]:
    """Conditions that tell which objects of a document were found, at any depth."""
    found = []
    for f in schema:
        if isinstance(f.dataType, T.StructType):
            found += [f"{document}.`{f.name}` IS NOT NULL", *_objects(f.dataType, f"{document}.`{f.name}`")]
    return found


def _broken(collection: str, document: str, found: str | None) -> str:
    """Whether ``value``, parsed as ``document`` and its list as ``found``, lost a part."""
    # Text after the document: within brackets it must be a list of one. Lines of plain JSON are only counted
    # through; any other is parsed. The fields are skipped: a line that is no object shows in the document itself.
    within = "concat('[', value, ']')"
    whole = f"size(from_json({within}, 'array<struct<_:string>>')) = 1"
    # Where a sound document holds as many objects as the line has closing braces, its own is the last: if that ends
    # the line, nothing follows.
    objects = " + ".join(["1", *(f"IF({o}, 1, 0)" for o in _objects(document_schema(collection), document))])
    braces = "octet_length(value) - octet_length(replace(value, '}', ''))"
    ends = f"startswith(value, '{{') AND endswith(value, '}}') AND {braces} = {objects}"
    more = f"""CASE WHEN {ends} THEN false WHEN json_array_length({within}) = 1 THEN false
        ELSE NOT coalesce({whole}, false) END"""
    broken = [f"{document}.{CORRUPT_COLUMN} IS NOT NULL", more]
    if found:
        broken.append(f"coalesce(exists({found}, r -> r.{CORRUPT_COLUMN} IS NOT NULL), false)")
    return " OR ".join(broken)


def _parsed_with_lists(collection: str, lines: DataFrame, kept: list[Column], names: list[str]) -> DataFrame:
    """The rows of ``read_lines`` with ``PARSED_LIST``; a line without fault is gone through once.

    Within brackets, and its lists as what they hold, such a line is a list of one document and nothing in it
    is broken. Any other line is parsed as ``read_lines`` does without lists.
    """
    whole, (field, element) = reading_schema(collection), _LISTS[collection]
    alone = f"from_json(value, '{_ddl(whole)}', {_OPTIONS_SQL})"
    details = whole["additional_details"].dataType
    inside = {f.name: f"d.additional_details.{f.name}" for f in details} | {field: _list_of("d", collection)}
    outside = {f.name: f"d.`{f.name}`" for f in whole}
    outside["additional_details"] = f"IF(d.additional_details IS NULL, NULL, {struct(inside)})"
    alone = f"transform(array({alone}), d -> {struct(outside)})[0]"
    details[field].dataType = T.ArrayType(T.StructType.fromDDL(element))
    lists = T.StructType().add(_LINE_KEY, T.ArrayType(whole)).add(CORRUPT_COLUMN, T.StringType())
    within = f"""concat('{{"{_LINE_KEY}":[', value, ']}}')"""
    once = f"_whole.`{_LINE_KEY}`[0]"
    in_list = f"exists({once}.additional_details.{field}, r -> r.{CORRUPT_COLUMN} IS NOT NULL)"
    sound = f"""coalesce(_whole.{CORRUPT_COLUMN} IS NULL AND size(_whole.`{_LINE_KEY}`) = 1 AND {once} IS NOT NULL
        AND {once}.{CORRUPT_COLUMN} IS NULL AND NOT coalesce({in_list}, false), false)"""
    broken = _broken(collection, "r.document", f"r.document.additional_details.{field}")
    read = struct({"sound": sound, "document": f"IF({sound}, {once}, {alone})"})
    parts = struct({"document": "r.document", "partial": f"IF(r.sound, false, {broken})"})
    # One generated column, as each further one would copy what it is made of; the text goes no further.
    one = f"""transform(transform(array(from_json({within}, '{_ddl(lists)}', {_OPTIONS_SQL})),
        _whole -> {read}), r -> {parts})"""
    rows = lines.select("value", *kept).select(*names, F.explode(F.expr(one)).alias("_read"))
    found = F.col(f"_read.document.additional_details.{field}").alias(PARSED_LIST)
    return rows.select("_read.document.*", F.col("_read.partial").alias(PARTIAL_COLUMN), *names, found)


def is_unreadable(collection: str):
    """True for lines that gave no field at all."""
    no_field = [F.col(f"`{f.name}`").isNull() for f in document_schema(collection)]
    # The fields come first: where one is there, nobody needs to know whether the line is sound.
    return reduce(and_, no_field) & F.col(PARTIAL_COLUMN)


def is_partial(collection: str):
    """True for documents that lost a part: a field or list element of the wrong shape, or text
    after the first document of the line."""
    return F.col(PARTIAL_COLUMN) & ~is_unreadable(collection)


def readable(collection: str, lines: DataFrame) -> DataFrame:
    """Documents without the lines that could not be read."""
    return lines.where(~is_unreadable(collection)).drop(CORRUPT_COLUMN, PARTIAL_COLUMN)


def load_collections(
    spark: SparkSession, directory: str, allow_missing: bool = False
) -> dict[str, DataFrame]:
    """The nine consolidated collections ``<directory>/<name>.jsonl``.

    A collection whose file isn't there raises, or is empty with ``allow_missing``: without
    routes, for one, every subnet looks private.
    """

    def rows(name: str) -> DataFrame:
        try:
            return readable(name, read_lines(spark, name, f"{directory}/{name}.jsonl"))
        except AnalysisException as error:
            if not allow_missing or error.getCondition() != "PATH_NOT_FOUND":
                raise
            return readable(name, read_lines(spark, name, []))

    return {name: rows(name) for name in K.COLLECTIONS}


def write_jsonl(documents: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """Append documents as UTF-8 JSON lines, keeping explicit nulls."""
    documents.write.mode(mode).option("ignoreNullFields", "false").option("encoding", "UTF-8").options(
        **packed(compression)
    ).json(path)


def packed(compression: str) -> dict[str, str]:
    """Writer options of a compression; field names repeat in every line, so the fastest level will do."""
    return {"compression": compression, "zlib.compress.level": "BEST_SPEED"}
