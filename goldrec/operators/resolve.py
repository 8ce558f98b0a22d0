"""Entity resolution.

E5 keys a record by its normalised primary e-mail.  E6 attaches records that
have no e-mail to an e-mail entity through a shared E.164 phone and a similar
name.  Of what stays unmatched, records with a phone in common and similar names
there are one entity, also over several phones and records; a record with neither
e-mail nor a phone and name stands alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.functions.phones import normalize_phones
from goldrec.functions.strings import canonical_emails, py_strip
from goldrec.operators.components import components
from goldrec.operators.simjoin import similar_links, similar_pairs
from goldrec.session import ensure_checkpoint_dir

NAME_MATCH_CUTOFF = 80


def assign_key(records: DataFrame) -> DataFrame:
    """E5: add ``entity_key`` = lower-cased, stripped first e-mail (null when none)."""
    primary = F.get(canonical_emails(F.col("fields.emails")), 0)
    return records.withColumn("entity_key", primary)


def _name_form(c):
    s = F.lower(py_strip(c))
    return F.when(s != "", s)


def match_fallback(keyed: DataFrame, cutoff: int = NAME_MATCH_CUTOFF) -> DataFrame:
    """Give every record without an e-mail key an ``entity_key``.

    One pass explodes (record, key, name, E.164 phone).  The distinct names of
    e-mail-less records meet the distinct names of keyed records at the same
    phone (``similar_pairs``); a pair is accepted at token-sort ratio >=
    ``cutoff`` and the best (ratio, then key) wins.  Unmatched records of one (first phone,
    name) are a group; groups are linked where they have a phone in common with names
    that reach the cutoff, and linked groups take their smallest key.  The rest stand
    alone.  Keyed rows pass through without a shuffle; only e-mail-less rows are
    joined to their new key.  The matches are checkpointed, as links are followed
    in rounds.
    """
    pn = keyed.select(
        "record_id", "entity_key", _name_form(F.col("fields.full_name")).alias("name"),
        F.posexplode_outer(normalize_phones(F.col("fields.phones"))).alias("pos", "phone"),
    )
    # of the entities with one name at one phone the smallest key is the only one that can win
    known = (
        pn.where(F.col("entity_key").isNotNull() & F.col("name").isNotNull() & F.col("phone").isNotNull())
        .groupBy("phone", F.col("name").alias("known_name")).agg(F.min("entity_key").alias("known_key"))
    )
    unkeyed = pn.where(F.col("entity_key").isNull())
    probes = unkeyed.where(F.col("name").isNotNull() & F.col("phone").isNotNull()).select("phone", F.col("name").alias("probe_name"))
    pairs = similar_pairs(probes, known, ["phone"], "probe_name", "known_name", cutoff).join(known, ["phone", "known_name"])
    best = pairs.groupBy("probe_name", F.col("phone").alias("probe_phone")).agg(
        F.min_by("known_key", F.struct(-F.col("ratio"), F.col("known_key"))).alias("match_key"),
        F.max("ratio").alias("match_ratio"),
    )
    matched = (
        unkeyed.join(best, (F.col("name") == F.col("probe_name")) & (F.col("phone") == F.col("probe_phone")), "left")
        .groupBy("record_id")
        .agg(
            F.min(F.when(F.col("match_key").isNotNull(), F.struct((-F.col("match_ratio")).alias("r"), F.col("match_key").alias("key"))))["key"].alias("match_key"),
            F.min_by("phone", F.col("pos")).alias("first_phone"),
            F.first("name").alias("name_form"),
            F.collect_set("phone").alias("phones"),
        )
    )
    own_key = F.when(
        F.col("first_phone").isNotNull() & F.col("name_form").isNotNull(),
        F.concat(F.lit("phone:"), F.col("first_phone"), F.lit("|"), F.col("name_form")),
    )
    ensure_checkpoint_dir(keyed.sparkSession)
    matched = matched.select("record_id", "match_key", own_key.alias("own_key"), "name_form", "phones").checkpoint()
    joined = linked_groups(matched.where("match_key is null and own_key is not null"), cutoff)
    matched = matched.join(joined, "own_key", "left")
    fallback_key = F.coalesce("match_key", "joint_key", "own_key", F.concat(F.lit("record:"), F.col("record_id")))
    keyed_part = keyed.where(F.col("entity_key").isNotNull())
    unkeyed_part = (
        keyed.where(F.col("entity_key").isNull())
        .drop("entity_key")
        .join(matched.select("record_id", fallback_key.alias("entity_key")), "record_id", "left")
    )
    return keyed_part.unionByName(unkeyed_part)


def linked_groups(groups: DataFrame, cutoff: int = NAME_MATCH_CUTOFF) -> DataFrame:
    """(own_key, joint_key) of the groups that a phone and a similar name link with others: the smallest key of all linked.

    ``groups``: own_key, name_form, phones; rows may repeat a key.
    """
    spots = groups.select("own_key", F.explode("phones").alias("phone"), F.col("name_form").alias("name")).distinct().checkpoint()
    links = similar_links(spots, ["phone"], "name", cutoff).select("phone", "l", "r").checkpoint()

    def spot(name: str):
        return F.concat(F.lit("spot:"), F.col("phone"), F.lit("|"), F.col(name))

    # spots that link anything: alike with another name, or held by several groups
    ends = links.select(spot("l").alias("spot")).unionByName(links.select(spot("r").alias("spot")))
    held = spots.select("own_key", spot("name").alias("spot"))
    shared = held.groupBy("spot").agg(F.count("*").alias("n")).where("n > 1").select("spot")
    held = held.join(ends.unionByName(shared).distinct(), "spot", "left_semi")
    edges = links.select(spot("l").alias("a"), spot("r").alias("b")).unionByName(held.select(F.col("own_key").alias("a"), F.col("spot").alias("b")))
    found = components(edges)
    keys = found.where(F.col("node").startswith("phone:"))
    joint = keys.groupBy("root").agg(F.min("node").alias("joint_key"))
    return keys.join(joint, "root").select(F.col("node").alias("own_key"), "joint_key")


def resolve(records: DataFrame, fallback: bool = True, materialize: bool = False) -> DataFrame:
    """E5 then (optionally) E6; records without any key stand alone.

    E6 reads the e-mail-keyed records three times (phones/names, keyed rows,
    e-mail-less rows).  With ``materialize`` they are checkpointed first into
    the shared ``spark.checkpoint.dir``, so source extraction runs once.
    """
    keyed = assign_key(records)
    if fallback:
        if materialize:
            from goldrec.session import ensure_checkpoint_dir

            ensure_checkpoint_dir(keyed.sparkSession)
            keyed = keyed.checkpoint(eager=True)
        return match_fallback(keyed)
    return keyed.withColumn(
        "entity_key", F.coalesce("entity_key", F.concat(F.lit("record:"), F.col("record_id")))
    )
