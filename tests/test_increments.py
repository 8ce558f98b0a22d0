"""Ranks over skewed keys, and golden rows kept up to date by batches."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from goldrec.operators.incremental import BUCKETS, _own_states, _write, add_records, compact, golden_of
from goldrec.operators.merge import merge_records, record_values
from goldrec.operators.ranking import ranked
from goldrec.operators.resolve import resolve
from goldrec.plans.derive import customer_records
from goldrec.streaming.ingest import start_golden

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("ranges", [1, 7])
def test_ranks(spark, ranges):
    rng = random.Random(ranges)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), rng.choice(["x", None]), rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, f string, s int, id int").repartition(5)
    got = {r["id"]: r["rank"] for r in ranked(df, ["k", "f"], [F.desc("s"), F.asc("id")], ranges=ranges).collect()}
    want, seen = {}, {}
    for k, f, s, i in sorted(rows, key=lambda r: (-r[2], r[3])):
        seen[k, f] = want[i] = seen.get((k, f), 0) + 1
    assert got == want


def test_a_hot_key_is_spread(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), "id")
    plan = ranked(df, ["k"], [F.asc("id")], ranges=8)
    assert plan.count() == 20_000 and plan.agg(F.max("rank")).first()[0] == 20_000
    spread = df.repartitionByRange(8, "k", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 5000


def golden(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.select(sorted(df.columns)).collect())


def test_batches_give_one_full_run(spark, tmp_path):
    records = customer_records(spark, SF)
    whole = golden(merge_records(spark, resolve(records, fallback=False)))
    store = str(tmp_path / "store")
    parts = [records.where(F.pmod(F.xxhash64("record_id"), F.lit(3)) == i) for i in range(3)]
    for i, part in enumerate(parts):
        add_records(spark, store, part, i)
    add_records(spark, store, parts[1], 1)  # a batch that is repeated counts once
    assert golden(golden_of(spark, store)) == whole
    compact(spark, store, str(tmp_path / "packed"))
    assert golden(golden_of(spark, str(tmp_path / "packed"))) == whole


def test_only_touched_entities_are_rebuilt(spark, tmp_path):
    records, store = customer_records(spark, SF), str(tmp_path / "store")
    late = (F.col("source") == "resume") & F.col("record_id").isin("resume-3", "resume-9")
    add_records(spark, store, records.where(~late), 0)
    add_records(spark, store, records.where(late), 1)
    got = golden_of(spark, store, 1)
    assert {r["entity_key"] for r in got.collect()} == {"customer3@example.com", "customer9@example.com"}
    whole = merge_records(spark, resolve(records, fallback=False)).where(F.col("entity_key").isin("customer3@example.com", "customer9@example.com"))
    assert golden(got) == golden(whole)


def test_a_file_stream_updates_golden_rows(spark, tmp_path):
    landing, store, out = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "golden")
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps([{"name": "Ida Lang", "email": "ida@x.org"}, {"name": "Olaf Berg", "email": "olaf@x.org"}]))
    start_golden(spark, str(landing), "ats", store, out, available_now=True).awaitTermination()
    (landing / "b.json").write_text(json.dumps({"name": "Ida Lang", "email": "IDA@x.org", "skills": ["Go"]}))
    start_golden(spark, str(landing), "ats", store, out, available_now=True).awaitTermination()
    rows = spark.read.parquet(out)
    latest = {r["entity_key"]: (r["batch"], [s["name"] for s in r["skills"]]) for r in rows.orderBy("batch").collect()}
    assert latest == {"ida@x.org": (1, ["Go"]), "olaf@x.org": (0, [])}
    assert rows.where("batch = 1").count() == 1


def test_a_state_is_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    state = spark.range(1000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("entity_key")).repartition(3)
    _write(state.mapInArrow(pass_on, state.schema), str(tmp_path / "out"))
    assert seen.value == 1000  # ranges would be sampled first
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.select("entity_key").distinct().count() == out.count() == 1000
    assert out.where(f"bucket <> pmod(xxhash64(entity_key), {BUCKETS})").isEmpty()


def test_skills_list_no_other_value(spark, tmp_path):
    customer_records(spark, SF).write.parquet(str(tmp_path / "records"))
    keyed = resolve(spark.read.parquet(str(tmp_path / "records")), fallback=False)
    state = _own_states(keyed.drop("entity_key"), "US", None)["skills"]
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    assert set(re.findall(r"fields#\d+\.(\w+)", plan)) == {"emails", "skills_raw"}  # emails: the key
    rows = record_values(keyed, "US").where("part = 'skills'").select("entity_key", "raw", F.col("k1").alias("key"), "source").distinct()
    assert rows.count() == state.count() and rows.exceptAll(state).isEmpty()
