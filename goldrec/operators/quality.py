"""Data-quality violations (V1-V3).

Rules are Column expressions that yield an array of (path, message) structs
per row; the report is one narrow ``explode`` - no shuffle, the job never
fails because of bad data.  Messages follow the JSON-Schema validator wording
(``<path>: <message>``, path ``root`` for the record itself).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.schemas import GOLDEN

V = "struct<path:string,message:string>"
_NONE_T = "None is not of type '{t}'"


def _v(cond: Column, path, message) -> Column:
    p = path if isinstance(path, Column) else F.lit(path)
    m = message if isinstance(message, Column) else F.lit(message)
    return F.when(cond, F.array(F.struct(p.alias("path"), m.alias("message")))).otherwise(F.array().cast(f"array<{V}>"))


def _num(c: Column) -> Column:
    return c.cast("string")


def _range(c: Column, path) -> list[Column]:
    return [
        _v(c > 1, path, F.concat(_num(c), F.lit(" is greater than the maximum of 1"))),
        _v(c < 0, path, F.concat(_num(c), F.lit(" is less than the minimum of 0"))),
    ]


def _items(arr: str | Column, check) -> Column:
    """Violations of every item of array column ``arr``: check(item, index) -> array<V>."""
    per = F.transform(F.coalesce(arr if isinstance(arr, Column) else F.col(arr), F.array()), lambda x, i: check(x, i))
    return F.flatten(per)


def _ip(arr: str, i: Column, sub: str | None = None) -> Column:
    parts = [F.lit(f"{arr}."), i.cast("string")] + ([F.lit(f".{sub}")] if sub else [])
    return F.concat(*parts)


def canonical_rules(df: DataFrame) -> list[Column]:
    """V1: the canonical golden schema's constraints as Columns; those of absent columns are left to the shape check."""
    rules = {
        "candidate_id": lambda: [_v(F.col("candidate_id").isNull(), "candidate_id", _NONE_T.format(t="string"))],
        "emails": lambda: _list_of("emails", "string"),
        "phones": lambda: _list_of("phones", "string"),
        "provenance": lambda: [
            _v(F.col("provenance").isNull(), "provenance", _NONE_T.format(t="array")),
            _items("provenance", lambda x, i: F.concat(
                _v(x.isNull(), _ip("provenance", i), _NONE_T.format(t="object")),
                *[_v(x.isNotNull() & x[k].isNull(), _ip("provenance", i, k), _NONE_T.format(t="string"))
                  for k in ("field", "source", "method")],
            )),
        ],
        "overall_confidence": lambda: [
            _v(F.col("overall_confidence").isNull(), "overall_confidence", _NONE_T.format(t="number")),
            *_range(F.col("overall_confidence"), "overall_confidence"),
        ],
        "links": lambda: [
            _items("links.other", lambda x, i: _v(x.isNull(), _ip("links.other", i), _NONE_T.format(t="string"))),
            _v(F.col("links").isNotNull() & F.col("links.other").isNull(), "links.other", _NONE_T.format(t="array")),
        ],
        "experience": lambda: [_v(F.col("experience").isNull(), "experience", _NONE_T.format(t="array"))],
        "education": lambda: [_v(F.col("education").isNull(), "education", _NONE_T.format(t="array"))],
        "skills": lambda: [
            _v(F.col("skills").isNull(), "skills", _NONE_T.format(t="array")),
            _items("skills", lambda x, i: F.concat(
                _v(x.isNull(), _ip("skills", i), _NONE_T.format(t="object")),
                _v(x.isNotNull() & x["name"].isNull(), _ip("skills", i, "name"), _NONE_T.format(t="string")),
                _v(x.isNotNull() & x["confidence"].isNull(), _ip("skills", i, "confidence"), _NONE_T.format(t="number")),
                _v(x["confidence"] > 1, _ip("skills", i, "confidence"), F.concat(_num(x["confidence"]), F.lit(" is greater than the maximum of 1"))),
                _v(x["confidence"] < 0, _ip("skills", i, "confidence"), F.concat(_num(x["confidence"]), F.lit(" is less than the minimum of 0"))),
                _v(x.isNotNull() & x["sources"].isNull(), _ip("skills", i, "sources"), _NONE_T.format(t="array")),
            )),
        ],
    }
    shape = [_v(F.lit(True), path, message) for path, message in schema_violations(df)]
    return shape + [rule for column, make in rules.items() if column in df.columns for rule in make()]


def _list_of(column: str, kind: str) -> list[Column]:
    return [
        _v(F.col(column).isNull(), column, _NONE_T.format(t="array")),
        _items(column, lambda x, i: _v(x.isNull(), _ip(column, i), _NONE_T.format(t=kind))),
    ]


def schema_violations(df: DataFrame, schema: T.StructType = GOLDEN) -> list[tuple[str, str]]:
    """Closed-shape check on the DataFrame's schema (driver-side, no data touched)."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns and f.name in ("candidate_id", "full_name", "emails", "phones", "provenance", "overall_confidence"):
            out.append(("root", f"'{f.name}' is a required property"))
    extra = [c for c in df.columns if c not in schema.fieldNames() and c != "entity_key" and not c.startswith("conf_")]
    if extra:
        out.append(("root", f"Additional properties are not allowed ({', '.join(repr(c) for c in extra)} "
                            f"{'was' if len(extra) == 1 else 'were'} unexpected)"))
    return out


def config_rules(df: DataFrame, config: dict) -> list[Column]:
    """V2: rules derived from a projection config (types are fixed by coercion; nulls checked)."""
    rules = []
    on_missing = config.get("on_missing", "null")
    for spec in config.get("fields", []):
        path = spec.get("path")
        if not path or path not in df.columns:
            continue
        value = F.col(f"`{path}`")
        if spec.get("required") and on_missing == "error":
            t = {"string[]": "array", "number": "number", "boolean": "boolean"}.get(spec.get("type", "string"), "string")
            rules.append(_v(value.isNull(), path, _NONE_T.format(t=t)))
            if t == "array":
                rules.append(_items(value, lambda x, i: _v(x.isNull(), _ip(path, i), _NONE_T.format(t="string"))))
    if config.get("include_confidence") and "overall_confidence" in df.columns:
        rules.append(_v(F.col("overall_confidence").isNull(), "overall_confidence", _NONE_T.format(t="number")))
    return rules


def violations(df: DataFrame, rules: list[Column], key: str = "entity_key") -> DataFrame:
    """V3: one row per violation (key, path, message); empty when valid."""
    allv = F.concat(*rules) if len(rules) > 1 else rules[0]
    return df.select(F.col(key), F.explode(allv).alias("v")).select(
        key, F.col("v.path").alias("path"), F.col("v.message").alias("message")
    )


def validate(df: DataFrame, config: dict | None = None, key: str = "entity_key") -> DataFrame:
    """Violations of golden rows (V1) or of projected rows (V2)."""
    if config and config.get("fields"):
        rules = config_rules(df, config)
        if not rules:
            return df.select(F.col(key), F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("message")).where(F.lit(False))
        return violations(df, rules, key)
    return violations(df, canonical_rules(df), key)


def violation_counts(v: DataFrame) -> DataFrame:
    """V3: (path, message, n, n_entities), items of a list under one path (``emails.0`` as ``emails.*``)."""
    path = F.regexp_replace("path", r"\.[0-9]+", ".*")
    return v.groupBy(path.alias("path"), "message").agg(F.count("*").alias("n"), F.count_distinct("entity_key").alias("n_entities"))


def sort_violations(v: DataFrame) -> DataFrame:
    """S3: report order."""
    return v.orderBy("entity_key", "path", "message")
