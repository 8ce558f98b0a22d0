"""Free-text extraction Column builders.

Every builder maps a text Column to a Column; a job adds them all over one scan
of a partitioned text table, and no row ever leaves its task.

A pattern meets a text once.  What several fields need - the first lines, the
sections' texts, the ranges of years - is a column of its own (``resume_marks``),
and what several parts of a block need is a stage of ``transform`` of its own, as
Spark evaluates an expression inside a lambda wherever it is named.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldrec.functions import patterns as P
from goldrec.functions.strings import let, py_strip

# Python's str.splitlines() boundaries.
LINE_BREAK = r"\r\n|[\n\r\x{0B}\f\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"

EMAIL_RX = P.EMAIL
PHONE_RX = P.portable(P.PHONE)
LINKEDIN_RX = "(?i)" + P.portable(P.LINKEDIN)
GITHUB_RX = "(?i)" + P.portable(P.GITHUB)
YEAR_RANGE_RX = "(?iu)" + P.portable(P.YEAR_RANGE)
YEARS_STATED_RX = "(?iu)" + P.portable(P.YEARS_STATED)
SKILLS_LABEL_RX = "(?iud)" + P.portable(P.SKILLS_LABEL)
COMPANY_RX = "(?d)" + P.portable(P.COMPANY_MENTION)
NAME_LABEL_RX = "(?iud)" + P.portable(P.NAME_LABEL)
SKILLS_SECTION_RX = "(?ius)" + P.portable(P.SKILLS_SECTION).replace(r"\Z", r"\z")
EDUCATION_SECTION_RX = "(?ius)" + P.portable(P.EDUCATION_SECTION).replace(r"\Z", r"\z")
EXPERIENCE_SECTION_RX = "(?ius)" + P.portable(P.EXPERIENCE_SECTION).replace(r"\Z", r"\z")
# Java's \b knows ASCII words only; this edge knows all letters and digits.
_W = r"[\p{L}\p{N}_]"
WORD_EDGE = rf"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"
DEGREE_RX = "(?iu)" + P.portable(P.DEGREE).replace(r"\b", WORD_EDGE)
EDU_YEAR_RX = P.portable(r"\b((?:19|20)\d{2})\b").replace(r"\b", WORD_EDGE)


def _nz(c: Column) -> Column:
    return F.when(c != "", c)


def lines_of(text: Column) -> Column:
    """Stripped non-blank lines, like ``[l.strip() for l in splitlines() if l.strip()]``."""
    return F.filter(F.transform(F.split(text, LINE_BREAK), py_strip), lambda x: x != "")


def words_of(line: Column) -> Column:
    return F.filter(F.split(line, P.WS_CLASS + "+"), lambda x: x != "")


# --- C1-C3 -----------------------------------------------------------------


def emails(text: Column) -> Column:
    """All distinct e-mail addresses in first-seen order (empty when none)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(EMAIL_RX), 0))


def phone_spans(text: Column) -> Column:
    """All distinct phone-like spans (may cross lines); validity is D3's job."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PHONE_RX), 0), py_strip))


def _first_url(text: Column, rx: str) -> Column:
    m = F.regexp_extract(text, rx, 0)
    return _nz(F.regexp_replace(m, "/+$", ""))


def linkedin(text: Column) -> Column:
    """First LinkedIn profile URL, trailing slash removed."""
    return _first_url(text, LINKEDIN_RX)


def github(text: Column) -> Column:
    """First GitHub URL, trailing slash removed."""
    return _first_url(text, GITHUB_RX)


# --- names and headline (C4-C6, F5) ------------------------------------------


def looks_like_name(line: Column) -> Column:
    """2-4 words, no digit, no word starting with a lower-case letter."""
    return let(words_of(line), lambda w: F.size(w).between(2, 4) & ~F.exists(w, lambda x: x.rlike(r"^\p{Ll}|\p{Nd}")))


def head_lines(text: Column) -> Column:
    """The first six non-blank lines, stripped."""
    return F.slice(lines_of(text), 1, 6)


def name_in(head: Column) -> Column:
    """C4 from ``head_lines``."""
    return F.get(F.filter(F.slice(head, 1, 5), looks_like_name), 0)


def name_from_lines(text: Column) -> Column:
    """C4: first of the first five non-blank lines that looks like a name."""
    return name_in(head_lines(text))


def name_from_label(text: Column) -> Column:
    """Value after 'Name:' / 'Candidate -' to the end of its line."""
    return _nz(py_strip(F.regexp_extract(text, NAME_LABEL_RX, 1)))


def headline_in(head: Column, name: Column) -> Column:
    """C6 from ``head_lines``."""
    cand = F.filter(
        F.slice(head, 2, 5),
        lambda ln: (F.size(words_of(ln)) >= 3) & ~ln.rlike(EMAIL_RX) & ~ln.rlike(PHONE_RX) & ~ln.rlike(LINKEDIN_RX) & ~looks_like_name(ln),
    )
    return F.when(name.isNotNull(), F.get(cand, 0))


def headline(text: Column, name: Column) -> Column:
    """First of lines 2-6 with >= 3 words and no contact data, only when a name was found."""
    return headline_in(head_lines(text), name)


# --- skills (C7, C8) -----------------------------------------------------------


def section(text: Column, rx: str) -> Column:
    """The first section's body, null where there is none; one pass over the text."""
    return F.get(F.regexp_extract_all(text, F.lit(rx), 1), 0)


def skills_in(body: Column) -> Column:
    """C7 from the section's body."""
    items = F.transform(F.split(F.regexp_replace(body, r"\([^)]*\)", ""), P.SKILL_SPLIT), py_strip)
    return F.filter(items, lambda x: F.length(x) > 1)


def skills_section(text: Column) -> Column:
    """Items of the skills section; parentheses removed; 1-char items dropped."""
    return skills_in(section(text, SKILLS_SECTION_RX))


def skills_labels(text: Column) -> Column:
    """Items after every 'Skills:' / 'Proficient in -' style label."""
    lines = F.regexp_extract_all(text, F.lit(SKILLS_LABEL_RX), 1)
    items = F.flatten(F.transform(lines, lambda ln: F.transform(F.split(ln, P.NOTES_SKILL_SPLIT), py_strip)))
    return let(F.filter(items, lambda x: x != ""), lambda found: F.when(F.size(found) > 0, found))


# --- years (C11, C12) ----------------------------------------------------------


def _ends(span: Column, part: int) -> Column:
    """A range's start (1) or end (2), from the range alone."""
    return F.regexp_extract(span, YEAR_RANGE_RX, part)


def sum_year_ranges(text: Column, as_of_year: int | Column) -> Column:
    """C11: sum of 'YYYY - YYYY|present' ranges; open end = ``as_of_year``.

    Only ranges with 1980 <= start <= as_of and start <= end count; the sum is
    returned only when positive.
    """
    now = as_of_year if isinstance(as_of_year, Column) else F.lit(as_of_year)
    ranges = F.regexp_extract_all(text, F.lit(YEAR_RANGE_RX), 0)
    ends = F.transform(ranges, lambda r: F.struct(_ends(r, 1).try_cast("int").alias("s"), F.lower(_ends(r, 2)).alias("e")))
    ends = F.transform(ends, lambda x: F.struct(x["s"].alias("s"), F.when(x["e"].isin("present", "current"), now).otherwise(x["e"].try_cast("int")).alias("e")))

    def span(x: Column) -> Column:
        ok = x["s"].isNotNull() & x["e"].isNotNull() & (x["s"] >= 1980) & (x["s"] <= now) & (x["s"] <= x["e"])
        return F.when(ok, (x["e"] - x["s"]).cast("double")).otherwise(F.lit(0.0))

    total = F.aggregate(ends, F.lit(0.0), lambda a, x: a + span(x), lambda a: F.round(a, 1))
    return F.nullif(total, F.lit(0.0))


def stated_years(text: Column) -> Column:
    """C12: 'N years of experience' (decimals and '+' allowed)."""
    return _nz(F.regexp_extract(text, YEARS_STATED_RX, 1)).try_cast("double")


def company_mention(text: Column) -> Column:
    """First company after 'worked at', 'currently at', 'from', ... (case-sensitive)."""
    return _nz(py_strip(F.regexp_extract(text, COMPANY_RX, 1)))


def snippet(text: Column, n: int) -> Column:
    """C14: first ``n`` characters."""
    return F.substring(text, 1, n)


# --- sections (C9, C10) --------------------------------------------------------


def experience_in(body: Column) -> Column:
    """C9 from the section's body."""
    blocks = F.transform(F.split(py_strip(body), P.portable(r"\n\s*\n")), py_strip)
    blocks = F.transform(blocks, lambda s: F.struct(lines_of(s).alias("lines"), F.regexp_extract(s, YEAR_RANGE_RX, 0).alias("years")))
    blocks = F.transform(
        blocks,
        lambda b: F.struct(
            F.filter(b["lines"], lambda x: ~x.rlike(r"^[-•*\p{Nd}]")).alias("heads"),
            F.filter(b["lines"], lambda x: x.rlike(r"^[-•*]")).alias("bullets"),
            _nz(_ends(b["years"], 1)).alias("start"),
            _nz(_ends(b["years"], 2)).alias("end"),
        ),
    )
    dated = r"^\p{Nd}{4}"
    jobs = F.transform(
        blocks,
        lambda b: F.struct(
            F.get(b["heads"], 0).alias("company"),
            let(F.get(b["heads"], 1), lambda title: F.when(~title.rlike(dated), title)).alias("title"),
            F.concat(b["start"], F.lit("-01")).alias("start"),
            F.concat(F.when(~F.lower(b["end"]).isin("present", "current"), b["end"]), F.lit("-01")).alias("end"),
            F.when(F.size(b["bullets"]) > 0, F.substring(F.array_join(b["bullets"], " "), 1, 500)).alias("summary"),
        ),
    )
    return F.filter(jobs, lambda b: b["company"].isNotNull() & ~b["company"].rlike(dated))


def experience_blocks(text: Column) -> Column:
    """Jobs of the experience section as structs (company, title, start, end, summary)."""
    return experience_in(section(text, EXPERIENCE_SECTION_RX))


DEGREE_AT = "(?su)^.*?" + DEGREE_RX.replace("(?iu)", "(?iu:") + ")"


def education_in(body: Column) -> Column:
    """C10 from the section's body."""
    blocks = F.transform(F.split(py_strip(body), r"\n(?=[^" + P.WS_CLASS[1:-1] + "])"), py_strip)
    # all up to the degree, and the degree itself
    blocks = F.transform(
        blocks,
        lambda s: F.struct(
            s.alias("s"), F.length(F.regexp_extract(s, DEGREE_AT, 0)).alias("at"), _nz(F.regexp_extract(s, DEGREE_RX, 0)).alias("degree"),
            F.regexp_extract_all(s, F.lit(EDU_YEAR_RX), 1).alias("years"),
        ),
    )
    blocks = F.transform(
        blocks,
        lambda b: b.withField(
            "field", F.when(b["degree"].isNotNull(), F.slice(words_of(F.regexp_replace(py_strip(F.substring(b["s"], b["at"] + 1, 1 << 30)), "^[in]+", "")), 1, 4))
        ),
    )
    schools = F.transform(
        blocks,
        lambda b: F.struct(
            py_strip(F.get(F.split(b["s"], LINE_BREAK, 2), 0)).alias("institution"),
            b["degree"].alias("degree"),
            F.when(F.size(b["field"]) > 0, F.array_join(b["field"], " ")).alias("field"),
            F.when(F.size(b["years"]) > 0, F.element_at(b["years"], -1)).alias("end_year"),
        ),
    )
    return F.filter(schools, lambda b: b["institution"] != "")


def education_blocks(text: Column) -> Column:
    """Each line of the education section that starts a block (institution, degree, field, end_year).

    The end year is the last whole 4-digit year of the block.
    """
    return education_in(section(text, EDUCATION_SECTION_RX))


# --- whole texts ----------------------------------------------------------------


def resume_marks(text: Column) -> dict[str, Column]:
    """What one pass of each pattern finds in a resume, for ``resume_fields``."""
    return {
        "emails": emails(text),
        "phones": phone_spans(text),
        "linkedin": linkedin(text),
        "github": github(text),
        "head": head_lines(text),
        "skills": section(text, SKILLS_SECTION_RX),
        "experience": section(text, EXPERIENCE_SECTION_RX),
        "education": section(text, EDUCATION_SECTION_RX),
    }


def notes_marks(text: Column) -> dict[str, Column]:
    """The same of a recruiter's notes."""
    return {"emails": emails(text), "phones": phone_spans(text), "skills": skills_labels(text)}
