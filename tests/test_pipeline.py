"""End to end on four invented source files shaped like the reference samples."""

import os

import pytest
from conftest import FIXTURES

from goldrec.plans.golden import build_golden


@pytest.fixture(scope="module")
def result(spark):
    return build_golden(
        spark,
        csv=os.path.join(FIXTURES, "candidate.csv"), ats=os.path.join(FIXTURES, "ats.json"),
        resume=os.path.join(FIXTURES, "resume.txt"), notes=os.path.join(FIXTURES, "notes.txt"),
    )


def test_four_sources(result):
    rows = result.golden.collect()
    assert len(rows) == 1
    g = rows[0].asDict(recursive=True)
    assert g["full_name"] == "Maya Rodriguez"
    assert g["emails"] == ["maya.rodriguez@example.com"]
    assert g["phones"] == ["+14155552671"]
    assert g["overall_confidence"] == pytest.approx(0.9629, abs=1e-4)
    assert g["conf_experience"] == pytest.approx(0.815) and g["conf_location"] == pytest.approx(0.905)
    assert len(g["provenance"]) == 20
    assert len(g["experience"]) == 3 and len(g["education"]) == 4
    assert all(s["confidence"] <= 1.0 for s in g["skills"])
    assert g["candidate_id"].startswith("cand_") and len(g["candidate_id"]) == 17
    assert result.violations.count() == 0


def test_missing_and_malformed_sources(spark, tmp_path):
    bad = tmp_path / "bad.json"
    bad.write_text("{ invalid json !!!")
    r = build_golden(spark, csv=os.path.join(FIXTURES, "candidate.csv"), ats=str(bad), notes=str(tmp_path / "none.txt"))
    g = r.golden.collect()
    assert len(g) == 1 and g[0]["full_name"] == "Maya Rodriguez"
    status = {row["source"]: (row["found"], row["rows_kept"]) for row in r.source_status.collect()}
    assert status["ats"] == (True, 0) and status["notes"] == (False, 0)


def test_all_sources_missing(spark, tmp_path):
    r = build_golden(spark, csv=str(tmp_path / "bad.csv"), ats=str(tmp_path / "bad.json"))
    assert r.golden.count() == 0
    assert {row["source"]: row["found"] for row in r.source_status.collect()} == {"csv": False, "ats": False}


def test_deterministic(spark):
    a = build_golden(spark, csv=os.path.join(FIXTURES, "candidate.csv"), ats=os.path.join(FIXTURES, "ats.json"))
    b = build_golden(spark, csv=os.path.join(FIXTURES, "candidate.csv"), ats=os.path.join(FIXTURES, "ats.json"))
    ra, rb = a.golden.first(), b.golden.first()
    assert ra["candidate_id"] == rb["candidate_id"] and ra["overall_confidence"] == rb["overall_confidence"]
    assert ra["full_name"] == "Maya Rodriguez" and ra["phones"] == ["+14155552671"]


def test_custom_config_projection(spark):
    cfg = {
        "fields": [
            {"path": "full_name", "type": "string", "required": True},
            {"path": "primary_email", "from": "emails[0]", "type": "string", "required": True},
            {"path": "phone", "from": "phones[0]", "type": "string", "normalize": "E164"},
            {"path": "skill_names", "from": "skills[].name", "type": "string[]"},
        ],
        "include_confidence": True,
        "on_missing": "null",
    }
    r = build_golden(spark, csv=os.path.join(FIXTURES, "candidate.csv"), ats=os.path.join(FIXTURES, "ats.json"), config=cfg)
    row = r.golden.first().asDict()
    assert row["primary_email"] == "maya.rodriguez@example.com" and row["phone"] == "+14155552671"
    assert "candidate_id" not in row and "experience" not in row and "overall_confidence" in row
    assert r.violations.count() == 0
