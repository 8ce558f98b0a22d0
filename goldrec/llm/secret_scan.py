"""Secret scans through an incremental ledger of blobs.

Every version of a text is named by the SHA-256 of its content (its *blob*).
The ledger says which rules, in which version, each blob has been scanned with
and what was found.  A scan keeps one text per blob, takes from the ledger what
has been done, runs only the unseen (blob, rule version) pairs, and joins the
findings back to every row (path) that holds the blob.

Matches become rows whose places are running sums, so the work is linear in a
text's length however much of it matches.

Offsets are code points, ends exclusive.  A kind's matches are its leftmost
non-overlapping ones; those under the rule's least length are dropped after
matching.

Defined results: a null text counts as empty; repeated rows each get the
findings of their blob, also where the ledger holds a blob twice (two scans at
once, or a rerun); rows keep their number; an empty table gives an empty
result; other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch, release


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # as Java reads it
    hint: str  # a cheaper pattern that every kept match satisfies
    match: str = ""  # a pattern with the same kept matches and fewer others
    group: int = 0  # the group whose length counts
    least: int = 0
    version: int = 1
    base: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in their order.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"""(?i)(?:password|passwd|secret|token|key)["']?\x20*[:=]""",
        group=2, least=12, base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{14}", match=r"AKIA[A-Z0-9]{14,}", least=18, base=True),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{16}", match=r"[0-9a-f]{16,}", least=16, base=True),
)
#: Kinds of this library.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?", "PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8,}\."),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "struct<start:int,rank:int,kind:string,end:int>"
STEP = "struct<rank:int,kind:string,gap:int,size:int,kept:boolean,i:int>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def steps_of(text: Column, rule: Rule, rank: int) -> Column:
    """Matches of one rule in order, each with the gap before it; texts without the hint are not matched.

    Places are not summed up here, as an array that grows by a match at a time is copied every time.
    """
    pattern = F.lit(rule.match or rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    between = F.transform(F.split(text, rule.match or rule.pattern, -1), F.length)
    sizes = F.zip_with(found, measured, lambda hit, part: F.struct(F.length(hit).alias("size"), (F.length(part) >= rule.least).alias("kept")))
    steps = F.zip_with(
        F.slice(between, 1, F.size(found)),
        sizes,
        lambda gap, x: F.struct(F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), gap.alias("gap"), x["size"].alias("size"), x["kept"].alias("kept")),
    )
    numbered = F.transform(steps, lambda x, i: x.withField("i", i))
    return F.when(text.rlike(rule.hint), numbered).otherwise(F.array().cast(f"array<{STEP}>"))


def scan_blobs(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, scanned, findings): unseen blobs, and seen ones with rules not yet run on them.

    ``scanned`` names the rule versions this scan ran on the blob.
    """
    names = F.array(*[F.lit(r.name) for r in rules])
    blobs = docs.select(blob_id(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        blobs = blobs.withColumn("scanned", names)
    else:
        done = ledger.select("blob", F.explode("scanned").alias("name")).groupBy("blob").agg(F.collect_set("name").alias("done"))
        blobs = blobs.join(done, "blob", "left")
        blobs = blobs.withColumn("scanned", F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))).where(F.size("scanned") > 0)
    nothing = F.array().cast(f"array<{STEP}>")
    steps = [F.when(F.array_contains("scanned", r.name), steps_of(F.col("text"), r, i)).otherwise(nothing) for i, r in enumerate(rules)]
    matches = blobs.select("blob", "scanned", F.explode_outer(F.concat(*steps)).alias("m")).select("blob", "scanned", "m.*")
    # a blob's rows stay in its partition: only sorts are added
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("blob", "rank").orderBy("i")).cast("int")
    matches = matches.withColumn("end", end)
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "rank", "kind", "end")
    return matches.groupBy("blob", "scanned").agg(F.array_sort(F.collect_list(F.when(F.col("kept"), span))).alias("findings"))


def findings_by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans, cuts, tail) of the blobs in which the current versions of ``rules`` found anything.

    ``cuts`` are the stretches of text before each run of overlapping spans,
    ``tail`` is where the last run ends.  Spans that the ledger holds twice count once.
    """
    current = ledger.where(F.arrays_overlap("scanned", F.array(*[F.lit(r.name) for r in rules]))).where(F.size("findings") > 0)
    wanted = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.name))])
    mine = F.filter("findings", lambda f: F.array_contains("scanned", F.element_at(wanted, f["kind"])))
    spans = current.select("blob", F.explode(mine).alias("s")).groupBy("blob", "s").agg(F.count("*").alias("times"))
    before = Window.partitionBy("blob").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reached", F.coalesce(F.max("s.end").over(before), F.lit(0)))
    cut = F.when((F.col("s.start") >= F.col("reached")) & (F.col("s.end") > F.col("reached")), F.struct(F.col("reached").alias("start"), F.col("s.start").alias("end")))
    return spans.groupBy("blob").agg(
        F.array_sort(F.collect_list("s")).alias("spans"), F.array_sort(F.collect_list(cut)).alias("cuts"), F.max("s.end").alias("tail")
    )


def scan_documents(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """(row, spans, cuts, tail) for every row of ``docs``: its columns ``keep`` (all), and all findings by start, then rule order.

    ``ledger_path``: a Parquet ledger in shared storage, read if it exists and
    appended to; without it the ledger lives as long as the run.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    ledger = None
    if ledger_path and _exists(spark, ledger_path):
        ledger = spark.read.parquet(ledger_path)
    new = scratch.save(scan_blobs(docs, ledger, rules), "scanned")
    release(spark)
    if ledger_path:
        new.write.mode("append").parquet(ledger_path)
        known = spark.read.schema(new.schema).parquet(ledger_path)
    else:
        known = new
    found = scratch.save(findings_by_blob(known, rules), "findings")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), blob_id(F.col("text")).alias("blob"))
    return rows.join(found, "blob", "left").select("row", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"), "cuts", "tail")


def _exists(spark, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def redacted(text: Column, cuts: Column, tail: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every maximal run of overlapping spans replaced by ``mask``; cuts and tail as ``findings_by_blob`` gives them.

    Four bytes a character make a place in the text a place in its bytes, so no
    piece is searched from the start.  A letter goes before each piece while it is
    read back, as a byte order mark at its start would be taken for one.
    """
    lead = F.lit(b"\0\0\0x")

    def piece(wide: Column, start: Column, size: Column) -> Column:
        return F.substring(F.decode(F.concat(lead, F.substring(wide, 4 * start + 1, 4 * size)), "UTF-32"), F.lit(2), size)

    def join(wide: Column) -> Column:
        kept = F.transform(cuts, lambda c: F.concat(piece(wide, c["start"], c["end"] - c["start"]), F.lit(mask)))
        return F.concat(F.array_join(kept, ""), piece(wide, tail, F.length(text) - tail))

    return F.when(tail.isNotNull(), F.transform(F.array(F.encode(text, "UTF-32")), join)[0]).otherwise(text)


def redact_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with its secrets masked; n_chars, where there is one, follows the text."""
    out = scan_documents(docs, rules=rules)
    text = redacted(F.col("row.text"), F.col("cuts"), F.col("tail"))
    out = out.select("row", "spans", text.alias("clean"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("clean").alias(c))
        elif c == "n_chars":
            changed = F.length("clean").cast(docs.schema[c].dataType)
            columns.append(F.when(F.size("spans") > 0, changed).otherwise(F.col("row").getField(c)).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return out.select(*columns)
