"""Regular expressions used by extraction and normalisation.

The fixed values below are written in Python ``re`` syntax, where ``\\d``,
``\\s`` and ``\\w`` are Unicode-aware.  Spark (Java) and DuckDB (RE2) read them
as ASCII classes, so :func:`portable` rewrites those three escapes into explicit
Unicode classes that both engines understand the same way.  Keeping one source
string per pattern keeps the Spark job and the SQL check in step.
"""

from __future__ import annotations

# Python's str.isspace() set, written as ranges understood by Java and RE2.
_WS_RANGES = (
    r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
_DIGIT = r"\p{Nd}"
_WORD = r"\p{L}\p{N}_"


def portable(pattern: str) -> str:
    """Rewrite ``\\d \\s \\w`` (Unicode in Python) as explicit Unicode classes."""
    out = []
    in_class = False
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt in "dsw":
                body = {"d": _DIGIT, "s": _WS_RANGES, "w": _WORD}[nxt]
                out.append(body if in_class else f"[{body}]")
            else:
                out.append(pattern[i : i + 2])
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


WS_CLASS = f"[{_WS_RANGES}]"
#: The same characters, written out.
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# ---------------------------------------------------------------------------
# Extraction patterns (Python syntax, as specified).
# ---------------------------------------------------------------------------
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE = r"(?:\+?\d[\d\s\-().]{7,}\d)"
LINKEDIN = r"(?:https?://)?(?:www\.)?linkedin\.com/in/[\w\-]+/?"  # case-insensitive
GITHUB = r"(?:https?://)?(?:www\.)?github\.com/[\w\-]+/?"  # case-insensitive
YEAR_RANGE = r"(\d{4})\s*[–\-—to]+\s*(\d{4}|present|current)"  # case-insensitive
DEGREE = r"\b(B\.?Tech|B\.?E\.?|Bachelor|B\.?S\.?|M\.?Tech|M\.?S\.?|Master|Ph\.?D|MBA|B\.?Sc|M\.?Sc)\b"  # case-insensitive
YEARS_STATED = r"(\d+(?:\.\d+)?)\s*(?:\+\s*)?years?\s+(?:of\s+)?(?:experience|exp)"  # case-insensitive
SKILLS_LABEL = r"(?:skills?|proficient\s+in|knows?|expertise|tech(?:nologies)?)\s*[:\-]\s*(.+)"  # case-insensitive
COMPANY_MENTION = r"(?:worked?\s+at|currently\s+at|formerly\s+at|joins?\s+from|from)\s+([A-Z][A-Za-z0-9\s&.,]+?)(?:[,.\n]|$)"
NAME_LABEL = r"(?:name|candidate)\s*[:\-]\s*(.+)"  # case-insensitive
SKILLS_SECTION = r"(?:technical\s+)?skills?\s*[:\-]?\s*\n(.*?)(?:\n\s*\n|\Z)"  # case-insensitive, dot-all
EDUCATION_SECTION = r"education\s*[:\-]?\s*\n(.*?)(?:\n\s*\n(?=[A-Z])|\Z)"  # case-insensitive, dot-all
EXPERIENCE_SECTION = r"(?:work\s+)?experience\s*[:\-]?\s*\n(.*?)(?:\n\s*\n(?=[A-Z])|\Z)"  # case-insensitive, dot-all
SKILL_SPLIT = r"[,|•·\n\t]+"
NOTES_SKILL_SPLIT = r"[,|•·\n]+"
# Date patterns.
ISO_DATE = r"^((?:19|20)\d{2})-(\d{2})"
QUARTER_DATE = r"(Q[1-4])\s*((?:19|20)\d{2})"  # case-insensitive
MONTH_YEAR = r"([A-Za-z]+)['\s,.-]+((?:19|20)\d{2})|((?:19|20)\d{2})['\s,.-]+([A-Za-z]+)"
NUMERIC_MONTH_YEAR = r"(\d{1,2})[/\-]((?:19|20)\d{2})|((?:19|20)\d{2})[/\-](\d{1,2})"
# ---------------------------------------------------------------------------
