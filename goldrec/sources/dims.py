"""Dimension tables.

All dimensions are small and of fixed size, so they are broadcast.  Sizes are
asserted at build time: nothing here grows with the data.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import functions as F

_DATA = os.path.join(os.path.dirname(os.path.dirname(__file__)), "data")

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------

# Source -> (priority weight, extraction certainty).
SOURCE_CONSTANTS = [
    ("csv", 0.90, 0.95),
    ("ats", 0.85, 0.90),
    ("resume", 0.75, 0.70),
    ("notes", 0.60, 0.55),
]
# Weight and certainty used for any other source name.
DEFAULT_WEIGHT = 0.5
DEFAULT_CERTAINTY = 0.5

# Field importance for the overall confidence.
FIELD_IMPORTANCE = [
    ("full_name", 1.0),
    ("emails", 1.0),
    ("phones", 0.8),
    ("headline", 0.7),
    ("location", 0.7),
    ("years_experience", 0.8),
    ("skills", 0.9),
    ("experience", 0.9),
    ("education", 0.8),
    ("links", 0.5),
]

# Country aliases (lower-case alias -> ISO alpha-2).
COUNTRY_ALIASES = [
    ("usa", "US"), ("us", "US"), ("united states", "US"), ("united states of america", "US"),
    ("uk", "GB"), ("united kingdom", "GB"), ("england", "GB"), ("britain", "GB"),
    ("uae", "AE"), ("emirates", "AE"),
    ("south korea", "KR"),
    ("north korea", "KP"),
    ("russia", "RU"),
    ("taiwan", "TW"),
    ("vietnam", "VN"),
    ("iran", "IR"),
    ("czech republic", "CZ"),
    ("slovakia", "SK"),
    ("hong kong", "HK"),
]

# US state and district codes.
US_STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV "
    "NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC"
).split()

# Month and quarter tokens -> two-digit month.
MONTHS = [
    ("jan", "01"), ("january", "01"),
    ("feb", "02"), ("february", "02"),
    ("mar", "03"), ("march", "03"),
    ("apr", "04"), ("april", "04"),
    ("may", "05"),
    ("jun", "06"), ("june", "06"),
    ("jul", "07"), ("july", "07"),
    ("aug", "08"), ("august", "08"),
    ("sep", "09"), ("sept", "09"), ("september", "09"),
    ("oct", "10"), ("october", "10"),
    ("nov", "11"), ("november", "11"),
    ("dec", "12"), ("december", "12"),
]
QUARTERS = [("q1", "03"), ("q2", "06"), ("q3", "09"), ("q4", "12")]

# The canonical skills dictionary, in its natural order.
SKILLS_DICTIONARY_TEXT = """\
Python
JavaScript
TypeScript
Java
C++
C#
Go
Rust
Ruby
Swift
Kotlin
Scala
R
MATLAB
SQL
NoSQL
PostgreSQL
MySQL
MongoDB
Redis
Elasticsearch
GraphQL
REST API
gRPC
React
Vue.js
Angular
Node.js
Express.js
Django
Flask
FastAPI
Spring Boot
.NET
Docker
Kubernetes
Terraform
Ansible
AWS
GCP
Azure
CI/CD
Git
GitHub
GitLab
Jenkins
Linux
Bash
PowerShell
Machine Learning
Deep Learning
Natural Language Processing
Computer Vision
Data Science
Data Engineering
Data Analysis
Pandas
NumPy
Scikit-learn
TensorFlow
PyTorch
Keras
Spark
Hadoop
Kafka
Airflow
dbt
Tableau
Power BI
Excel
Agile
Scrum
Kanban
Jira
Confluence
Product Management
System Design
Microservices
Distributed Systems
Cloud Computing
DevOps
MLOps
Security
Networking
HTML
CSS
Figma
"""

# Skill matching thresholds.
FUZZY_CUTOFF = 80
SOURCE_ATTRIBUTION_CUTOFF = 75

# ---------------------------------------------------------------------------


def parse_skill_lines(text: str) -> list[str]:
    """Blank lines and lines starting with '#' are skipped; others trimmed."""
    return [ln.strip() for ln in text.splitlines() if ln.strip() and not ln.startswith("#")]


SKILLS = parse_skill_lines(SKILLS_DICTIONARY_TEXT)


def source_rank_expr(source_col) -> "F.Column":
    """Ordering of sources by weight (csv=1 ... notes=4, others last)."""
    ranked = sorted(SOURCE_CONSTANTS, key=lambda r: -r[1])
    expr = F.when(F.lit(False), F.lit(0))
    for i, (name, _, _) in enumerate(ranked, start=1):
        expr = expr.when(source_col == name, F.lit(i))
    return expr.otherwise(F.lit(len(ranked) + 1))


def source_weight_expr(source_col) -> "F.Column":
    expr = F.when(F.lit(False), F.lit(0.0))
    for name, w, _ in SOURCE_CONSTANTS:
        expr = expr.when(source_col == name, F.lit(w))
    return expr.otherwise(F.lit(DEFAULT_WEIGHT))


def _read_rows(name: str) -> list[list[str]]:
    with open(os.path.join(_DATA, name), encoding="utf-8") as fh:
        return [ln.rstrip("\n").split("|") for ln in fh if ln.strip() and not ln.startswith("#")]


@functools.lru_cache(maxsize=None)
def country_rows() -> tuple[tuple[str, str], ...]:
    """ISO 3166-1 alpha-2 code and English short name (public standard)."""
    return tuple((r[0], r[1]) for r in _read_rows("iso3166_countries.psv"))


@functools.lru_cache(maxsize=None)
def subdivision_rows() -> tuple[tuple[str, str], ...]:
    """ISO alpha-2 code of the country and name of a subdivision (ISO 3166-2, public standard)."""
    return tuple((r[0], r[1]) for r in _read_rows("iso3166_2_subdivisions.psv"))


@functools.lru_cache(maxsize=None)
def numbering_plan_rows() -> tuple[tuple[str, str, int, int, str], ...]:
    """ITU E.164 country calling code, region, national length range, pattern."""
    return tuple((r[0], r[1], int(r[2]), int(r[3]), r[4]) for r in _read_rows("numbering_plan.psv"))


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs) -> "F.Column":
    """A small fixed lookup as one map literal (one SQL expression, stays in codegen)."""
    return _cached_map(tuple(pairs))


@functools.lru_cache(maxsize=None)
def _cached_map(pairs) -> "F.Column":
    body = ", ".join(f"{_sql_str(k)}, {_sql_str(v)}" for k, v in pairs)
    return F.expr(f"map({body})")


def literal_array(values) -> "F.Column":
    """A fixed list of strings as one array literal."""
    return _cached_array(tuple(values))


@functools.lru_cache(maxsize=None)
def _cached_array(values) -> "F.Column":
    return F.expr("array(" + ", ".join(_sql_str(v) for v in values) + ")")
