"""Extraction records: JSON-Schema parsing, distributed extraction, text of parse results."""

from __future__ import annotations

import html
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .variant import is_array, is_object


def struct_from_json_schema(schema: dict) -> T.StructType:
    """The object's properties as a StructType (strings, numbers, booleans, arrays, objects)."""
    plain = {
        "string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(),
        "boolean": T.BooleanType(),
    }

    def spark_type(node: dict) -> T.DataType:
        kind = node.get("type", "string")
        if isinstance(kind, list):
            kind = next((k for k in kind if k != "null"), "string")
        if kind == "array":
            return T.ArrayType(spark_type(node.get("items", {})))
        if kind == "object":
            return struct_from_json_schema(node)
        return plain[kind]

    return T.StructType(
        [T.StructField(name, spark_type(node)) for name, node in schema.get("properties", {}).items()]
    )


#: JSON types as ``schema_of_variant`` names them, by the schema's word.
_KINDS = {
    "string": r"STRING", "integer": r"BIGINT|DECIMAL\(\d+,0\)", "number": r"BIGINT|DOUBLE|DECIMAL\(\d+,\d+\)", "boolean": r"BOOLEAN",
    "array": r"ARRAY<.*>", "object": r"OBJECT(<.*>)?", "null": r"VOID",
}


def _wrong_type(value: Column, node: dict) -> Column:
    """Whether a JSON value (a VARIANT) is not of the type its schema node names; elements of arrays as well."""
    if "type" not in node:
        return F.lit(False)
    kinds = node["type"] if isinstance(node["type"], list) else [node["type"]]
    wrong = ~F.schema_of_variant(value).rlike(f"^(?:{'|'.join(_KINDS[k] for k in kinds)})$")
    item = node.get("items", {})
    if "array" in kinds and "type" in item:
        inside = F.exists(F.try_variant_get(value, "$", "array<variant>"), lambda v: _wrong_type(v, item))
        wrong = wrong | F.coalesce(is_array(value) & inside, F.lit(False))
    return wrong


def parse_by_json_schema(df: DataFrame, schema: dict | str, column: str = "extracted_json") -> DataFrame:
    """Add ``record`` (the typed struct), ``missing_required``, ``extra_properties``, ``wrong_types``, ``valid``.

    ``wrong_types`` lists the properties whose JSON value is not of the schema's type; it and
    the other two must be empty for a valid record.
    """
    spec = json.loads(schema) if isinstance(schema, str) else schema
    struct = struct_from_json_schema(spec)
    keys = F.json_object_keys(F.col(column))
    required = F.array(*[F.lit(c) for c in spec.get("required", [])]).cast("array<string>")
    known = F.array(*[F.lit(f.name) for f in struct.fields]).cast("array<string>")
    extra_allowed = spec.get("additionalProperties", True) is not False
    return (
        df.withColumn("record", F.from_json(F.col(column), struct))
        .withColumn("missing_required", F.array_except(required, F.coalesce(keys, F.array().cast("array<string>"))))
        .withColumn("extra_properties", F.array_except(keys, known))
        .withColumn("_json", F.try_parse_json(F.col(column)))
        .withColumn("wrong_types", F.array_compact(F.array(*[
            F.when(F.coalesce(_wrong_type(F.try_variant_get("_json", f"$['{name}']", "variant"), node), F.lit(False)), name)
            for name, node in spec.get("properties", {}).items()
        ]).cast("array<string>")))
        .drop("_json")
        .withColumn(
            "valid",
            keys.isNotNull()
            & (F.size("missing_required") == 0)
            & (F.size("wrong_types") == 0)
            & (F.lit(extra_allowed) | (F.size("extra_properties") == 0)),
        )
    )


RESULT_SCHEMA = "ok boolean, filename string, extracted_json string, error string"


def extract_documents(files: DataFrame, fn: Callable[[str, bytes], dict | str], suffix: str = ".pdf") -> DataFrame:
    """Apply ``fn(filename, content)`` to every file in parallel.

    ``files`` has ``path`` and ``content`` (a binaryFile read). A failing file gives
    a row with its error, never a failed job; other suffixes are refused the same way.
    """

    def one(path: str, content) -> tuple:
        name = path.rsplit("/", 1)[-1]
        if not name.lower().endswith(suffix):
            return (False, name, None, f"unsupported file type: {name}")
        try:
            result = fn(name, bytes(content))
            text = result if isinstance(result, str) else json.dumps(result, ensure_ascii=False)
            return (True, name, text, None)
        except Exception as error:  # noqa: BLE001 - the error is the row's result
            return (False, name, None, str(error))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [one(p, c) for p, c in zip(batch["path"], batch["content"])]
            yield pd.DataFrame(rows, columns=["ok", "filename", "extracted_json", "error"])

    return files.select("path", "content").mapInPandas(run, RESULT_SCHEMA)


def run_summary(results: DataFrame) -> DataFrame:
    """One row: total, ok, failed."""
    return results.agg(
        F.count("*").alias("total"),
        F.coalesce(F.sum(F.when(F.col("ok"), 1).otherwise(0)), F.lit(0)).cast("bigint").alias("ok"),
        F.coalesce(F.sum(F.when(F.col("ok"), 0).otherwise(1)), F.lit(0)).cast("bigint").alias("failed"),
    )


def first_failures(results: DataFrame, n: int = 10) -> DataFrame:
    """The report's list of failed files: the first ``n`` by name."""
    return results.filter(~F.col("ok")).orderBy("filename", "error").limit(n).select("filename", "error")


def _string_at(v: Column, path: str) -> Column:
    """The value at a path when it is a JSON string."""
    found = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(v, path, "string"))


def _not_blank(col: Column) -> Column:
    return F.when(F.regexp_replace(col, r"(?U)\s", "") != "", col)


def _array_at(v: Column, path: str) -> Column:
    found = F.try_variant_get(v, path, "variant")
    return F.when(is_array(found), F.try_variant_get(v, path, "array<variant>"))


def _page_texts(page: Column) -> Column:
    """text, else content, else the texts of blocks, else of lines."""

    def texts(part: str) -> Column:
        items = _array_at(page, f"$.{part}")
        return F.transform(items, lambda item: _string_at(item, "$.text"))

    own = F.coalesce(_string_at(page, "$.text"), _string_at(page, "$.content"))
    nested = F.coalesce(texts("blocks"), texts("lines"), F.array().cast("array<string>"))
    return F.when(own.isNotNull(), F.array(own)).otherwise(nested)


def _nested_texts(document) -> list[str]:
    """The non-blank strings under a "text" key anywhere below, in document order.

    What is still to be read waits on a stack, so depth does not matter.
    """
    found: list[str] = []
    waiting: list[tuple[str, object]] = [("", document)]
    while waiting:
        name, value = waiting.pop()
        if name == "text" and isinstance(value, str):
            found += [value] if value.strip() else []
        elif isinstance(value, dict):
            waiting += reversed(value.items())
        elif isinstance(value, list):
            waiting += [("", item) for item in reversed(value)]
    return found


@F.pandas_udf(T.StringType())
def _any_text(parsed: pd.Series) -> pd.Series:
    """The nested texts of the unknown shapes, a line each; without any, the JSON itself, indented."""

    def read(raw: str) -> str:
        try:
            document = json.loads(raw)
            found = _nested_texts(document)
            return "\n".join(found) if found else json.dumps(document, ensure_ascii=False, indent=2)
        except RecursionError:  # too deep for the JSON reader: the row keeps its source
            return raw

    return parsed.map(read, na_action="ignore")


def text_from_parse_json(col) -> Column:
    """The text of a parse response, whatever shape it came in."""
    raw = F.col(col) if isinstance(col, str) else col
    v = F.try_parse_json(raw)
    direct = F.coalesce(*[_not_blank(_string_at(v, f"$.{k}")) for k in ("text", "document_text", "content")])
    pages = F.filter(_array_at(v, "$.pages"), is_object)
    chunks = F.filter(
        F.flatten(F.transform(pages, _page_texts)), lambda t: _not_blank(t).isNotNull()
    )
    paged = _not_blank(F.array_join(chunks, "\n\n"))
    known = F.coalesce(direct, paged)
    # Only rows of unknown shape carry a value into Python.
    return F.coalesce(known, _any_text(F.when(known.isNull() & v.isNotNull(), raw)))


def markdown_pick(job, large=None) -> Column:
    """data.markdown of the job, else markdown or data.markdown of its large result."""
    v = F.try_parse_json(F.col(job) if isinstance(job, str) else job)
    options = [_not_blank(_string_at(v, "$.data.markdown"))]
    if large is not None:
        big = F.try_parse_json(F.col(large) if isinstance(large, str) else large)
        first = F.coalesce(
            F.nullif(_string_at(big, "$.markdown"), F.lit("")), _string_at(big, "$.data.markdown")
        )
        options.append(_not_blank(first))
    return F.coalesce(*options)


# An anchor with its attributes and inner markup; a link in double, single or no quotes.
ANCHOR = r"(?is)<a(?=[\s>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>(.*?)</a\s*>"
HREF = r"""(?is)(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


@F.pandas_udf(T.StringType())
def _decoded(texts: pd.Series) -> pd.Series:
    """Character references in their place."""
    return texts.map(html.unescape, na_action="ignore")


def page_links(pages: DataFrame, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """One row per anchor: position, url ('' without a link) and the text without tags, both decoded."""
    anchors = F.regexp_extract_all(html_column, F.lit(ANCHOR), F.lit(0))
    found = pages.select(*(keep or []), F.posexplode(anchors).alias("position", "anchor"))
    attributes, inner = F.regexp_extract("anchor", ANCHOR, 1), F.regexp_extract("anchor", ANCHOR, 2)
    link = F.concat(*[F.regexp_extract(attributes, HREF, i) for i in (1, 2, 3)])
    return found.select(
        *(keep or []),
        "position",
        F.trim(_decoded(link)).alias("url"),
        F.trim(_decoded(F.regexp_replace(inner, "<[^>]*>", ""))).alias("name"),
    )
