"""Names, tokens, links and phone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def snake_to_pascal(col) -> Column:
    """core_approvals -> CoreApprovals; whitespace separates words as well."""
    words = F.split(F.trim(_c(col)), r"[_\s]+")
    return F.array_join(F.transform(words, lambda w: F.initcap(w)), "")


def model_namespace(module, table, doubled: bool = False) -> Column:
    """Ignite\\<Module>\\Entities\\<Model>; a '<module>_' prefix of the table is dropped.

    ``doubled`` puts the module name in front of the model once more.
    """
    mod = F.lower(F.trim(_c(module)))
    tab = F.lower(F.trim(_c(table)))
    prefix = F.concat(mod, F.lit("_"))
    model = F.when(
        F.startswith(tab, prefix), F.substring(tab, F.length(prefix) + 1, F.length(tab))
    ).otherwise(tab)
    head = snake_to_pascal(module)
    tail = snake_to_pascal(model)
    if doubled:
        tail = F.concat(head, tail)
    return F.concat(F.lit("Ignite\\"), head, F.lit("\\Entities\\"), tail)


def safe_token(col) -> Column:
    """A path segment: runs of other characters become one underscore."""
    # Fixed value: the characters a landing key keeps.
    return F.regexp_replace(F.trim(F.coalesce(_c(col), F.lit(""))), r"[^a-zA-Z0-9_\-=.+]+", "_")


def safe_filename(col) -> Column:
    return F.translate(_c(col), "/\\", "__")


def file_stem(received, filename, job_id) -> Column:
    """yyyyMMdd_HHmmss_<name>; without a name the job id stands in."""
    name = F.coalesce(F.nullif(_c(filename), F.lit("")), F.concat(F.lit("job_"), _c(job_id)))
    return F.concat(F.date_format(_c(received), "yyyyMMdd_HHmmss"), F.lit("_"), safe_filename(name))


def place_name(url) -> Column:
    """Business name from '/place/<name>/…' in a map link, '' when there is none."""
    raw = F.regexp_extract(_c(url), r"/place/([^/]+)", 1)
    decoded = F.coalesce(F.try_url_decode(raw), raw)
    return F.coalesce(F.replace(decoded, F.lit("+"), F.lit(" ")), F.lit(""))


def phone_suffix(col) -> Column:
    """The text after the last colon."""
    return F.element_at(F.split(_c(col), ":"), -1)
