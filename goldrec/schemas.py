"""StructTypes of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()

EXPERIENCE_ITEM = T.StructType(
    [T.StructField(n, S) for n in ("company", "title", "start", "end", "summary")]
)
EDUCATION_RAW_ITEM = T.StructType(
    [T.StructField(n, S) for n in ("institution", "degree", "field", "end_year")]
)
EDUCATION_ITEM = T.StructType(
    [T.StructField(n, S) for n in ("institution", "degree", "field")]
    + [T.StructField("end_year", T.IntegerType())]
)

SCALAR_FIELDS = [
    "full_name", "headline", "current_company", "linkedin", "github", "portfolio",
    "summary", "notes_raw", "location_raw", "city", "region", "country",
]

FIELDS = T.StructType(
    [T.StructField(n, S) for n in SCALAR_FIELDS]
    + [
        T.StructField("years_experience", D),
        T.StructField("emails", T.ArrayType(S)),
        T.StructField("phones", T.ArrayType(S)),
        T.StructField("skills_raw", T.ArrayType(S)),
        T.StructField("experience_raw", T.ArrayType(EXPERIENCE_ITEM)),
        T.StructField("education_raw", T.ArrayType(EDUCATION_RAW_ITEM)),
        T.StructField("education_text", S),
    ]
)

SOURCE_RECORDS = T.StructType(
    [
        T.StructField("record_id", S),
        T.StructField("source", S),
        T.StructField("extraction_confidence", D),
        T.StructField("fields", FIELDS),
    ]
)

LOCATION = T.StructType([T.StructField(n, S) for n in ("city", "region", "country")])
LINKS = T.StructType(
    [T.StructField(n, S) for n in ("linkedin", "github", "portfolio")]
    + [T.StructField("other", T.ArrayType(S))]
)
SKILL = T.StructType(
    [T.StructField("name", S), T.StructField("confidence", D), T.StructField("sources", T.ArrayType(S))]
)
PROVENANCE_ITEM = T.StructType([T.StructField(n, S) for n in ("field", "source", "method")])

GOLDEN = T.StructType(
    [
        T.StructField("candidate_id", S),
        T.StructField("full_name", S),
        T.StructField("emails", T.ArrayType(S)),
        T.StructField("phones", T.ArrayType(S)),
        T.StructField("location", LOCATION),
        T.StructField("links", LINKS),
        T.StructField("headline", S),
        T.StructField("years_experience", D),
        T.StructField("skills", T.ArrayType(SKILL)),
        T.StructField("experience", T.ArrayType(EXPERIENCE_ITEM)),
        T.StructField("education", T.ArrayType(EDUCATION_ITEM)),
        T.StructField("provenance", T.ArrayType(PROVENANCE_ITEM)),
        T.StructField("overall_confidence", D),
    ]
)


def fields_struct(**cols):
    """Build the ``fields`` struct from keyword Columns; absent keys are null."""
    from pyspark.sql import functions as F

    unknown = set(cols) - set(FIELDS.fieldNames())
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    return F.struct(
        *[
            (cols[f.name].cast(f.dataType) if f.name in cols else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in FIELDS.fields
        ]
    )
