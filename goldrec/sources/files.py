"""File sources (A1-A7, B1-B8, F1-F4) producing ``source_records``.

* CSV exports: header aliases, ``;``-lists, identity gate.
* ATS JSON: one object (or an array of objects) per file, optional envelope,
  key aliases, scalar-or-list values, nested histories - via VARIANT.
* Resume / notes text: one document per file (``wholetext``), regex extraction.

Every reader is a plain Spark scan; a missing path yields an empty DataFrame
and a ``source_status`` row instead of an error.
"""

from __future__ import annotations

import csv
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.functions import text as X
from goldrec.functions.patterns import WS_CLASS
from goldrec.functions.strings import blank_to_null, compose_name, py_strip, split_cell, to_double
from goldrec.schemas import EDUCATION_RAW_ITEM, EXPERIENCE_ITEM, SOURCE_RECORDS, fields_struct
from goldrec.session import broadcast_if_few
from goldrec.sources.csv_lines import csv_records, numbered_lines
from goldrec.sources.dims import SOURCE_CONSTANTS, literal_map
from goldrec.sources.json_arrays import array_elements

CERTAINTY = {s: c for s, _, c in SOURCE_CONSTANTS}

# CSV header (trimmed, lower-cased, space -> '_') -> canonical field.
CSV_FIELD_MAP = [
    ("name", "full_name"), ("full_name", "full_name"),
    ("email", "emails"), ("emails", "emails"),
    ("phone", "phones"), ("phones", "phones"),
    ("current_company", "current_company"), ("company", "current_company"),
    ("title", "headline"), ("job_title", "headline"), ("headline", "headline"),
    ("location", "location_raw"), ("city", "city"), ("country", "country"),
    ("linkedin", "linkedin"), ("linkedin_url", "linkedin"),
    ("github", "github"), ("github_url", "github"),
    ("portfolio", "portfolio"),
    ("skills", "skills_raw"),
    ("years_experience", "years_experience"), ("years_exp", "years_experience"),
    ("education", "education_text"),
    ("summary", "summary"),
    ("notes", "notes_raw"),
]

# ATS key -> canonical field, in alias priority order.
ATS_FIELD_MAP = [
    ("applicant_name", "full_name"), ("candidate_name", "full_name"),
    ("firstName", "_first_name"), ("lastName", "_last_name"),
    ("first_name", "_first_name"), ("last_name", "_last_name"),
    ("name", "full_name"),
    ("email_address", "emails"), ("applicant_email", "emails"), ("contact_email", "emails"), ("email", "emails"),
    ("mobile", "phones"), ("phone_number", "phones"), ("contact_phone", "phones"), ("phone", "phones"),
    ("current_location", "location_raw"), ("address", "location_raw"), ("city", "city"),
    ("state", "region"), ("country", "country"), ("location", "location_raw"),
    ("current_title", "headline"), ("job_title", "headline"), ("position", "headline"),
    ("current_employer", "current_company"), ("employer", "current_company"), ("company", "current_company"),
    ("linkedin_profile", "linkedin"), ("linkedin_url", "linkedin"),
    ("github_profile", "github"), ("github_url", "github"),
    ("portfolio_url", "portfolio"), ("website", "portfolio"),
    ("skill_set", "skills_raw"), ("skills", "skills_raw"),
    ("years_of_experience", "years_experience"), ("experience_years", "years_experience"),
    ("work_history", "experience_raw"), ("employment_history", "experience_raw"), ("experience", "experience_raw"),
    ("education_history", "education_raw"), ("education", "education_raw"), ("academic", "education_raw"),
    ("summary", "summary"), ("bio", "summary"), ("about", "summary"),
    ("notes", "notes_raw"),
]
# Envelope keys tried in order.
ATS_ENVELOPES = ["candidate", "applicant", "data", "record", "profile"]


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SOURCE_RECORDS)


def _empty_read(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], READ.format(fields=SOURCE_RECORDS["fields"].dataType.simpleString()))


def _exists(spark: SparkSession, path: str) -> bool:
    if not path:
        return False
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p))


# --- CSV (A1, A2, B1, B2, B8, F1) ----------------------------------------------


def header_key(h: str) -> str:
    return h.strip().lower().replace(" ", "_")


def map_csv_fields(cells: list[tuple[str, Column]] | DataFrame) -> Column:
    """B1: the ``fields`` struct from cells by header; for repeated aliases the last non-blank wins."""
    pairs = [(c, F.col(f"`{c}`")) for c in cells.columns] if isinstance(cells, DataFrame) else list(cells)
    mapping = dict(CSV_FIELD_MAP)
    by_field: dict[str, list[Column]] = {}
    for name, cell in pairs:
        canon = mapping.get(header_key(name))
        if canon:
            by_field.setdefault(canon, []).append(cell)
    vals = {f: F.coalesce(*[blank_to_null(c) for c in reversed(cells_)]) for f, cells_ in by_field.items()}
    out = {}
    for f, v in vals.items():
        if f in ("emails", "phones"):
            out[f] = split_cell(v, ";")
        elif f == "skills_raw":
            out[f] = split_cell(v, ";,")
        elif f == "years_experience":
            out[f] = to_double(v)
        else:
            out[f] = v
    return fields_struct(**out)


def _identified() -> Column:
    f = F.col("fields")
    return f["full_name"].isNotNull() | (F.coalesce(F.size(f["emails"]), F.lit(0)) > 0)


def identity_gate(records: DataFrame) -> DataFrame:
    """structured records need a name or at least one e-mail."""
    return records.where(_identified())


# Why a row is left out.
NO_IDENTITY = "neither name nor e-mail"
NO_JSON = "not valid JSON"
NO_OBJECT = "not a JSON object"
NO_TEXT = "no text"
NOTHING_READ = "unreadable or empty file"

SOURCE_COLUMNS = ("record_id", "source", "extraction_confidence", "fields")
#: Rows as the readers see them: source_records, the place in the file, and why the row is left out (null: kept) with its text.
READ = "record_id string, source string, extraction_confidence double, fields {fields}, file string, place long, reason string, raw string"


def _read(rows: DataFrame, source: str, record_id: Column, file: Column, place: Column, reason: Column, raw: Column) -> DataFrame:
    return rows.select(
        record_id.alias("record_id"), F.lit(source).alias("source"), F.lit(CERTAINTY[source]).alias("extraction_confidence"), "fields",
        file.alias("file"), place.cast("long").alias("place"), reason.alias("reason"), F.when(reason.isNotNull(), raw).alias("raw"),
    )


def kept(read: DataFrame) -> DataFrame:
    return read.where("reason is null")


def csv_rows(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """All rows of CSV files, each read by its own header: _file, _pos (the row's line in it), fields, raw (its text).

    A row's place does not depend on what other files there are, nor on how Spark
    splits the file.  Rows are read once for their places and once for their
    cells; of the files only the distinct headers reach the driver.
    """
    kind = SOURCE_RECORDS["fields"].dataType
    if not _exists(spark, path):
        return spark.createDataFrame([], f"_file string, _pos bigint, fields {kind.simpleString()}, raw string")
    records, heads = csv_records(spark, path, multiline)
    headers = {r["header"]: next(csv.reader([r["header"]], strict=False), []) for r in heads.select("header").distinct().collect()}
    width = max([1, *map(len, headers.values())])
    cells = F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(width))), {"escape": '"', "mode": "PERMISSIVE"})
    rows = records.join(broadcast_if_few(heads), "file").select("file", "line", "header", "value", cells.alias("cells"))
    fields = F.lit(None).cast(kind)
    for header, names in sorted(headers.items()):
        fields = F.when(F.col("header") == header, map_csv_fields([(n, F.col(f"cells.c{i}")) for i, n in enumerate(names)])).otherwise(fields)
    return rows.select(F.col("file").alias("_file"), F.col("line").alias("_pos"), fields.alias("fields"), F.col("value").alias("raw")).where("fields is not null")


def read_csv_source(spark: SparkSession, path: str, first_per_file: bool = False, multiline: bool = True) -> DataFrame:
    """A1 (+A2 when ``first_per_file``): recruiter CSV exports -> source_records.

    Large files are split, also where cells hold line breaks; ``multiline=False``
    takes every line for a record and so saves the search for open quotes.
    """
    rec = kept(_csv_read(spark, path, multiline))
    if first_per_file:
        first = rec.groupBy("file").agg(F.min_by(F.struct(*SOURCE_COLUMNS), "place").alias("r"))
        return first.select("r.*")
    return rec.select(*SOURCE_COLUMNS)


def _csv_read(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    rows = csv_rows(spark, path, multiline)
    record_id = F.concat_ws("#", "_file", F.col("_pos").cast("string"))
    return _read(rows, "csv", record_id, F.col("_file"), F.col("_pos"), F.when(~_identified(), NO_IDENTITY), F.col("raw"))


# --- ATS JSON (A3, A4, B3-B7) ----------------------------------------------------


def _vget(v: Column, path: str, typ: str) -> Column:
    return F.try_variant_get(v, path, typ)


def _object(v: Column) -> Column:
    return F.when(_vget(v, "$", "map<string,variant>").isNotNull(), v)


def unwrap(v: Column) -> Column:
    """A4: first envelope key whose value is an object, else the value itself."""
    return F.coalesce(*[_object(_vget(v, f"$['{k}']", "variant")) for k in ATS_ENVELOPES], v)


def _string_list(v: Column) -> Column:
    """A string or a list of values -> stripped strings, blanks dropped."""
    as_list = _vget(v, "$", "array<variant>")
    items = F.coalesce(
        F.transform(as_list, lambda x: F.coalesce(_vget(x, "$", "string"), F.to_json(x))),
        F.array(_vget(v, "$", "string")),
    )
    kept = F.filter(F.transform(items, py_strip), lambda x: x.isNotNull() & (x != ""))
    return F.when(v.isNotNull(), kept)


def _skills(v: Column) -> Column:
    """List of strings or of {name|skill}; or a delimited string."""
    as_list = _vget(v, "$", "array<variant>")
    from_list = F.transform(
        as_list,
        lambda x: F.coalesce(
            _vget(x, "$.name", "string"), _vget(x, "$.skill", "string"), _vget(x, "$", "string"), F.to_json(x)
        ),
    )
    lst = F.filter(F.transform(from_list, py_strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(lst, split_cell(_vget(v, "$", "string"), ";,"))


_ATS_CANON = sorted({c for _, c in ATS_FIELD_MAP})


def ats_entries(obj: Column) -> Column:
    """Object entries as (canonical field, alias rank, value); unknown keys get a null field.

    A key matches an alias exactly, lower-cased, or lower-cased with spaces as '_'.
    """
    m = _vget(obj, "$", "map<string,variant>")
    canon_of = literal_map([(k, c) for k, c in ATS_FIELD_MAP])
    rank_of = literal_map([(k, str(i)) for i, (k, _) in enumerate(ATS_FIELD_MAP)])

    def entry(e):
        k = e["key"]
        lk = F.lower(k)
        uk = F.replace(lk, F.lit(" "), F.lit("_"))
        key = F.coalesce(
            F.when(F.try_element_at(canon_of, k).isNotNull(), k),
            F.when(F.try_element_at(canon_of, lk).isNotNull(), lk),
            F.when(F.try_element_at(canon_of, uk).isNotNull(), uk),
        )
        return F.struct(F.try_element_at(canon_of, key).alias("c"),
                        F.try_element_at(rank_of, key).cast("int").alias("r"), e["value"].alias("v"))

    known = F.filter(F.transform(F.map_entries(m), entry), lambda e: e["c"].isNotNull())
    return F.array_sort(known, lambda a, b: a["r"] - b["r"])


def _nonblank(v: Column) -> Column:
    txt = F.coalesce(_vget(v, "$", "string"), F.to_json(v))
    return F.coalesce(F.length(py_strip(txt)) > 0, F.lit(False))


def pick_columns(entries: Column) -> list[Column]:
    """One variant column ``p_<field>`` per canonical field: the first non-blank value by alias priority."""
    return [
        F.get(F.filter(entries, lambda e: (e["c"] == f) & _nonblank(e["v"])), 0)["v"].alias(f"p_{f}")
        for f in _ATS_CANON
    ]


def map_ats_fields() -> Column:
    """The ``fields`` struct from the ``p_<field>`` pick columns."""
    def s(f):
        v = F.col(f"p_{f}")
        return blank_to_null(F.coalesce(_vget(v, "$", "string"), F.to_json(v)))

    fields = {
        f: s(f)
        for f in ("headline", "current_company", "linkedin", "github", "portfolio", "summary", "notes_raw",
                  "location_raw", "city", "region", "country")
    }
    fields["full_name"] = compose_name(s("full_name"), s("_first_name"), s("_last_name"))
    fields["emails"] = _string_list(F.col("p_emails"))
    fields["phones"] = _string_list(F.col("p_phones"))
    fields["skills_raw"] = _skills(F.col("p_skills_raw"))
    y = F.col("p_years_experience")
    fields["years_experience"] = F.coalesce(_vget(y, "$", "double"), to_double(_vget(y, "$", "string")))
    exp_t, edu_t = EXPERIENCE_ITEM.simpleString(), EDUCATION_RAW_ITEM.simpleString()
    fields["experience_raw"] = F.when(F.col("p_experience_raw").isNotNull(), F.coalesce(
        _vget(F.col("p_experience_raw"), "$", f"array<{exp_t}>"), F.array().cast(f"array<{exp_t}>")))
    fields["education_raw"] = F.when(F.col("p_education_raw").isNotNull(), F.coalesce(
        _vget(F.col("p_education_raw"), "$", f"array<{edu_t}>"), F.array().cast(f"array<{edu_t}>")))
    return fields_struct(**fields)


def ats_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A3 core: JSON text column -> (record_id, fields, _id, _i, _reason, _raw), a row a document or an array's element.

    Staged projections (entries -> picks -> fields) keep each step's expression small.
    """
    parsed = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_t"), F.try_parse_json(F.col(text_col)).alias("_v"))
    items = F.coalesce(_vget(F.col("_v"), "$", "array<variant>"), F.array(F.col("_v")))
    elems = parsed.select("_id", F.when(F.col("_v").isNull(), F.col("_t")).alias("_t"), F.posexplode(items).alias("_i", "_e"))
    objs = elems.select("_id", "_i", "_t", "_e", unwrap(F.col("_e")).alias("_o"))
    whole = _vget(F.col("_o"), "$", "map<string,variant>").isNotNull()
    ent = objs.select("_id", "_i", "_t", "_e", F.when(F.col("_t").isNotNull(), NO_JSON).when(~whole, NO_OBJECT).alias("_reason"), ats_entries(F.col("_o")).alias("_entries"))
    picks = ent.select("_id", "_i", "_t", "_e", "_reason", *pick_columns(F.col("_entries")))
    return picks.select(
        F.concat(F.col("_id"), F.lit("#"), F.col("_i").cast("string")).alias("record_id"), map_ats_fields().alias("fields"),
        "_id", "_i", "_reason", F.coalesce("_t", F.to_json("_e")).alias("_raw"),
    )


def ats_records_from_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """JSON text column -> source_records (bad JSON and non-objects dropped; arrays exploded)."""
    rec = ats_rows(docs, id_col, text_col).where("_reason is null")
    rec = rec.select("record_id", F.lit("ats").alias("source"), F.lit(CERTAINTY["ats"]).alias("extraction_confidence"), "fields")
    return identity_gate(rec)


JSON_LINES = "*.{jsonl,ndjson,jsonl.gz,ndjson.gz}"
JSON_LINES_RX = r"(?i)\.(?:jsonl|ndjson)(?:\.gz)?$"


def _ats_read(spark: SparkSession, path: str, lines: bool | str | None = None) -> DataFrame:
    if not _exists(spark, path):
        return _empty_read(spark)
    if lines == "arrays":
        return _ats_documents(array_elements(spark, path))
    whole = _read_text(spark, path, F.lit(False) if lines else F.lit(True) if lines is False else ~F.col("_metadata.file_name").rlike(JSON_LINES_RX))
    docs = whole.select("file", F.lit(None).cast("long").alias("line"), "value")
    if lines is not False:
        docs = docs.unionByName(numbered_lines(spark, path, "*" if lines else JSON_LINES).where(F.col("value").rlike(r"\S")))
    return _ats_documents(docs)


def _ats_documents(docs: DataFrame) -> DataFrame:
    """READ rows of documents (file, line or null, value)."""
    docs = docs.withColumn("id", F.concat_ws("#", "file", F.col("line").cast("string")))
    rows = ats_rows(docs, "id", "value")
    where = F.regexp_extract("_id", r"^(.*?)(?:#([0-9]+))?$", 1), F.regexp_extract("_id", r"#([0-9]+)$", 1).try_cast("long")
    reason = F.coalesce("_reason", F.when(~_identified(), NO_IDENTITY))
    return _read(rows, "ats", F.col("record_id"), where[0], F.coalesce(where[1], F.col("_i")), reason, F.col("_raw"))


def read_ats_source(spark: SparkSession, path: str, lines: bool | str | None = None) -> DataFrame:
    """A3: one JSON document per file, or one a line, which Spark splits.

    ``lines`` says which; None: by name, lines in files named .jsonl or .ndjson;
    "arrays": every file is one array, which is split too (``json_arrays.py``).
    """
    return kept(_ats_read(spark, path, lines)).select(*SOURCE_COLUMNS)


# --- resume / notes text (A5, A6, F3, C-operators) --------------------------------


def normalise_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def drop_empty_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """F3."""
    return df.where(_has_text(F.col(text_col)))


def _has_text(c: Column) -> Column:
    return c.rlike(f"[^{WS_CLASS[1:-1]}]")


def extract_resume(df: DataFrame, id_col: str, text_col: str, as_of_year: int) -> DataFrame:
    """A5: resume text -> source_records (all C-operators in one projection)."""
    t = normalise_newlines(F.col(text_col))
    base = drop_empty_text(df.select(F.col(id_col).cast("string").alias("record_id"), t.alias("text")))
    # columns by steps, each of which names costly columns of the step before, so that Spark keeps them apart
    marks = base.select("record_id", "text", *[c.alias(f"m_{n}") for n, c in X.resume_marks(F.col("text")).items()])
    found = marks.select(
        "record_id",
        X.name_in(F.col("m_head")).alias("full_name"),
        F.col("m_head"),
        _nonempty("m_emails").alias("emails"),
        _nonempty("m_phones").alias("phones"),
        F.col("m_linkedin").alias("linkedin"),
        F.col("m_github").alias("github"),
        X.skills_in(F.col("m_skills")).alias("skills_raw"),
        X.experience_in(F.col("m_experience")).alias("experience_raw"),
        X.education_in(F.col("m_education")).alias("education_raw"),
        X.sum_year_ranges(F.col("text"), as_of_year).alias("years_experience"),
    )
    found = found.withColumn("headline", X.headline_in(F.col("m_head"), F.col("full_name")))
    return _records(found.drop("m_head"), "resume")


def extract_notes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Recruiter-notes text -> source_records."""
    t = normalise_newlines(F.col(text_col))
    base = drop_empty_text(df.select(F.col(id_col).cast("string").alias("record_id"), t.alias("text")))
    t = F.col("text")
    marks = base.select("record_id", "text", *[c.alias(f"m_{n}") for n, c in X.notes_marks(t).items()])
    found = marks.select(
        "record_id",
        X.name_from_label(t).alias("full_name"),
        _nonempty("m_emails").alias("emails"),
        _nonempty("m_phones").alias("phones"),
        X.linkedin(t).alias("linkedin"),
        X.github(t).alias("github"),
        X.stated_years(t).alias("years_experience"),
        F.col("m_skills").alias("skills_raw"),
        X.company_mention(t).alias("current_company"),
        X.snippet(t, 500).alias("notes_raw"),
    )
    return _records(found, "notes")


def _nonempty(column: str) -> Column:
    return F.when(F.size(column) > 0, F.col(column))


def _records(found: DataFrame, source: str) -> DataFrame:
    """source_records of rows with a record_id and a column a field."""
    fields = fields_struct(**{c: F.col(c) for c in found.columns if c != "record_id"})
    return found.select("record_id", F.lit(source).alias("source"), F.lit(CERTAINTY[source]).alias("extraction_confidence"), fields.alias("fields"))


def drop_null_records(records: DataFrame) -> DataFrame:
    """records without a ``fields`` struct carry nothing to merge."""
    return records.where(F.col("fields").isNotNull())


def _read_text(spark: SparkSession, path: str, files: Column | None = None) -> DataFrame | None:
    if not _exists(spark, path):
        return None
    docs = spark.read.option("ignoreCorruptFiles", "true").text(path, wholetext=True)
    if files is not None:  # on a file's name: the others are not opened
        docs = docs.where(files)
    return docs.select(F.col("_metadata.file_path").alias("file"), "value")


def _text_read(spark: SparkSession, path: str, source: str, extract) -> DataFrame:
    docs = _read_text(spark, path)
    if docs is None:
        return _empty_read(spark)
    found = extract(docs).select("record_id", "fields")
    rows = _read(found, source, F.col("record_id"), F.col("record_id"), F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("string"))
    blank = docs.where(~_has_text(F.col("value"))).withColumn("fields", F.lit(None).cast(SOURCE_RECORDS["fields"].dataType))
    return rows.unionByName(_read(blank, source, F.col("file"), F.col("file"), F.lit(0), F.lit(NO_TEXT), F.col("value")))


def _resume_read(spark: SparkSession, path: str, as_of_year: int) -> DataFrame:
    return _text_read(spark, path, "resume", lambda docs: extract_resume(docs, "file", "value", as_of_year))


def _notes_read(spark: SparkSession, path: str) -> DataFrame:
    return _text_read(spark, path, "notes", lambda docs: extract_notes(docs, "file", "value"))


def read_resume_source(spark: SparkSession, path: str, as_of_year: int) -> DataFrame:
    docs = _read_text(spark, path)
    return _empty(spark) if docs is None else extract_resume(docs, "file", "value", as_of_year)


def read_notes_source(spark: SparkSession, path: str) -> DataFrame:
    docs = _read_text(spark, path)
    return _empty(spark) if docs is None else extract_notes(docs, "file", "value")


# --- multi-source load (A7, U1) ------------------------------------------------------


def _status(spark: SparkSession, name: str, path: str, kept: DataFrame) -> DataFrame:
    """One row: what was found under ``path``, what could be read, what was kept."""
    found = _exists(spark, path)
    nothing = F.lit(None).cast("string")

    def counted(df: DataFrame, one: str, file: Column = nothing) -> DataFrame:
        return df.select(*[F.lit(int(c == one)).alias(c) for c in ("files", "rows_in", "rows_kept")], file.alias("file"))

    rows = counted(kept, "rows_kept")
    if found:
        read = csv_rows(spark, path).withColumnRenamed("_file", "file") if name == "csv" else _read_text(spark, path)
        rows = rows.union(counted(spark.read.format("binaryFile").load(path), "files")).union(counted(read, "rows_in", F.col("file")))
    sums = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("files", "rows_in", "rows_kept")}
    out = rows.agg(*[v.alias(c) for c, v in sums.items()], F.count_distinct("file").alias("read"))
    return out.select(
        F.lit(name).alias("source"), F.lit(path).alias("path"), F.lit(found).alias("found"), "files", (F.col("files") - F.col("read")).alias("files_bad"),
        "rows_in", "rows_kept", F.greatest(F.col("rows_in") - F.col("rows_kept"), F.lit(0)).alias("rows_bad"),
    )


def load_sources(spark: SparkSession, csv=None, ats=None, resume=None, notes=None, as_of_year: int = 2026, ats_lines: bool | str | None = None):
    """A7 + U1: all given sources as one ``source_records`` DataFrame, plus ``source_status``.

    A missing path or an unreadable file is skipped and the rest goes on;
    ``source_status`` (lazy) counts files found and unreadable or empty, rows
    read, kept and dropped.
    """
    readers = [
        ("csv", csv, lambda p: read_csv_source(spark, p)),
        ("ats", ats, lambda p: read_ats_source(spark, p, ats_lines)),
        ("resume", resume, lambda p: read_resume_source(spark, p, as_of_year)),
        ("notes", notes, lambda p: read_notes_source(spark, p)),
    ]
    read = [(name, path, drop_null_records(reader(path))) for name, path, reader in readers if path]
    records = functools.reduce(DataFrame.unionByName, [df for *_, df in read], _empty(spark))
    kind = "source string, path string, found boolean, files bigint, files_bad bigint, rows_in bigint, rows_kept bigint, rows_bad bigint"
    status = functools.reduce(DataFrame.unionByName, [_status(spark, n, p, df) for n, p, df in read], spark.createDataFrame([], kind))
    return records, status


# --- one pass over the sources, with what is left out (A7) --------------------------


def read_sources(spark: SparkSession, csv=None, ats=None, resume=None, notes=None, as_of_year: int = 2026, ats_lines: bool | str | None = None) -> DataFrame:
    """Every row of the given sources: source_records, its file and place, and why it is left out (null: kept) with its text."""
    readers = [
        (csv, lambda: _csv_read(spark, csv)),
        (ats, lambda: _ats_read(spark, ats, ats_lines)),
        (resume, lambda: _resume_read(spark, resume, as_of_year)),
        (notes, lambda: _notes_read(spark, notes)),
    ]
    return functools.reduce(DataFrame.unionByName, [read() for path, read in readers if path], _empty_read(spark))


def write_sources(spark: SparkSession, out: str, csv=None, ats=None, resume=None, notes=None, as_of_year: int = 2026, ats_lines: bool | str | None = None) -> tuple[DataFrame, DataFrame]:
    """Read the sources once and write records and rejects side by side; returns (source_records, rejects).

    ``rejects``: source, file, place (line of a CSV or JSON Lines file, element of an array),
    reason, raw text.  Files of which nothing could be read have one row without a place.
    """
    paths = {"csv": csv, "ats": ats, "resume": resume, "notes": notes}
    rows = read_sources(spark, **paths, as_of_year=as_of_year, ats_lines=ats_lines)
    rows.withColumn("kept", F.col("reason").isNull()).write.partitionBy("kept").parquet(out)
    kind = READ.format(fields=SOURCE_RECORDS["fields"].dataType.simpleString()) + ", kept boolean"
    read = spark.read.schema(kind).parquet(out)
    rejects = read.where(~F.col("kept")).select("source", "file", "place", "reason", "raw")
    listed = [
        spark.read.format("binaryFile").load(path).select(F.lit(name).alias("source"), F.col("_metadata.file_path").alias("file"))
        for name, path in paths.items()
        if path and _exists(spark, path)
    ]
    if listed:
        files = functools.reduce(DataFrame.unionByName, listed)
        silent = files.join(read.select("source", "file").distinct(), ["source", "file"], "left_anti")
        rejects = rejects.unionByName(silent.select("source", "file", F.lit(None).cast("long").alias("place"), F.lit(NOTHING_READ).alias("reason"), F.lit(None).cast("string").alias("raw")))
    return read.where("kept").select(*SOURCE_COLUMNS), rejects
