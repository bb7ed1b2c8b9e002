r"""Similar sets by a prefix join of groups, closed to components.

The sets are ordered by rarity of their elements among each other. Of n elements,
only so many of the rarest are a prefix as one of which every similar set must
have in its own. Sets with the same prefix and size are collapsed into one group,
and an element's list holds groups, not sets.

First the members of each group meet its first member. Then, for ``ROUNDS``
rounds, the groups of a list meet one group of the list's largest component, so
that a large family of similar sets becomes one component without being compared
pair by pair. What is left, groups of different components, is joined completely:
pairs must meet in a list within bounds of length and position, their common
prefix elements are counted and bound what the rest can add, and what passes is
expanded to members and verified. No list is cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from castledger.llm.common import Tables
from castledger.llm.components import components

#: Rounds in which a list's groups meet one group of its largest component.
ROUNDS = 4
#: Pairs with the same set that one task compares.
PER_SALT = 2_000


def with_longs(sets: DataFrame) -> DataFrame:
    """(set_id, members) with the members as an array instead of bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = [np.frombuffer(m, np.int64) for m in part.column(1).to_pylist()]
                edges = np.cumsum([0, *map(len, own)]).astype(np.int32)
                yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(own)))],
                                      names=["set_id", "members"])

    return sets.select("set_id", "members").mapInArrow(run, "set_id binary, members array<long>")


def least_overlap(n: Column, percent: int) -> Column:
    """Shingles that a set of n has in common with any similar one, at least."""
    return F.ceil(n * percent / F.lit(100))


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(set_id, n, skipped, weight, prefix) of the sets that can link: the shingles of
    the prefix that others have too, rarest first, after ``skipped`` that none has;
    ``weight`` is how many sets have one of its shingles, on average."""
    rows = sets.select("set_id", F.size("members").alias("n"), F.explode("members").alias("member")).repartition("member")
    common = rows.groupBy("member").agg(F.count("*").alias("f")).where("f > 1")
    ordered = (rows.join(common, "member").groupBy("set_id", "n")
               .agg(F.sort_array(F.collect_list(F.struct("f", "member"))).alias("common")))  # of one text, no more
    least, skipped = least_overlap(F.col("n"), percent), F.col("n") - F.size("common")
    weight = F.aggregate("common.f", F.lit(0).cast("long"), lambda x, f: x + f) / F.col("n")
    return ordered.where(F.size("common") >= least).select(
        "set_id", "n", skipped.alias("skipped"), weight.alias("weight"),
        F.slice("common.member", F.lit(1), (F.col("n") - least + 1 - skipped).cast("int")).alias("prefix"))


def grouped(prefixed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups (group, n, skipped, weight, prefix) and their members (set_id, group). A set
    with shingles of its own in the prefix has no other of the same prefix."""
    alone = F.when(F.col("skipped") > 0, F.col("set_id"))
    keyed = prefixed.withColumn("key", F.sha2(F.concat(
        F.coalesce(F.hex(alone), F.lit("")), F.lit(":"), F.col("n").cast("string"), F.lit(":"),
        F.array_join(F.col("prefix").cast("array<string>"), ",")), 256))
    groups = keyed.groupBy("key").agg(F.min("set_id").alias("group"), F.max("weight").alias("weight"),
                                      *(F.first(c).alias(c) for c in ("n", "skipped", "prefix")))
    members = keyed.select("key", "set_id").join(groups.select("key", "group"), "key").select("set_id", "group")
    return groups.drop("key"), members


# -- links -----------------------------------------------------------------------------------

def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough. A set that is
    in very many pairs is dealt to several tasks."""
    salts = pairs.groupBy("b").agg(F.ceil(F.count("*") / F.lit(PER_SALT)).alias("salts"))
    dealt = pairs.join(salts, "b").withColumn("salt", F.pmod(F.xxhash64("a"), "salts"))
    second = (sets.join(salts, F.col("set_id") == F.col("b"))
              .select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                      F.col("members").alias("members_b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (s.values.to_numpy() for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                held.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(held, pa.bool_()))

    return (dealt.join(second, ["b", "salt"]).join(sets.select(F.col("set_id").alias("a"), F.col("members").alias("members_a")), "a")
            .select("a", "b", "members_a", "members_b").mapInArrow(run, "a binary, b binary"))


def relabelled(labels: DataFrame, links: DataFrame, tables: Tables) -> DataFrame:
    """(set_id, label) after the components of linked sets have been joined."""
    links = tables.keep(links)
    if links.isEmpty():
        return labels
    ends = (links.join(labels.toDF("a", "u"), "a").join(labels.toDF("b", "v"), "b").select("u", "v"))
    joined = components(ends, tables).toDF("label", "joined")
    return tables.keep(labels.join(joined, "label", "left").select("set_id", F.coalesce("joined", "label").alias("label")))


def _entries(groups: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Lists: each shingle's groups, one entry for each label among their members."""
    units = members.join(labels, "set_id").groupBy("group", "label").agg(F.min("set_id").alias("first"), F.count("*").alias("size"))
    return units.join(groups, "group").select(
        "group", "label", "first", "size", "weight", "n", F.posexplode("prefix").alias("at", "token"), "skipped").withColumn(
        "rank", F.col("skipped") + F.col("at") + 1).drop("at", "skipped")


def _within(n_a, rank_a, n_b, rank_b, percent: int) -> Column:
    """Bounds of length and position on what two sets can have in common."""
    left = 1 + F.least(n_a - rank_a, n_b - rank_b)
    return ((100 * n_a >= percent * n_b) & (100 * n_b >= percent * n_a)
            & ((100 + percent) * left >= percent * (n_a + n_b)))


def hub_pairs(entries: DataFrame, step: int, compared: DataFrame | None) -> DataFrame:
    """Pairs (a, b), not ``compared`` yet, of a list's groups with one group of the
    label that most sets of the list have: at first the one whose shingles are most
    frequent, the middle of a family, in later rounds any other. Found by
    aggregations that combine map-side. Bounds are left to the complete join: what
    a pair lacks for one list's bound it may have over all."""
    order = F.col("weight") if step < 2 else F.xxhash64("first", F.lit(step)).cast("double")
    sizes = entries.groupBy("token", "label").agg(
        F.sum("size").alias("size"), F.max(F.struct(order.alias("o"), "first")).alias("hub"))
    hubs = (sizes.groupBy("token").agg(F.max(F.struct("size", "label", "hub")).alias("best"), F.count("*").alias("labels"))
            .where("labels > 1").select("token", F.col("best.label").alias("hub_label"), F.col("best.hub.first").alias("b")))
    pairs = entries.join(hubs, "token").where("label <> hub_label").select(F.col("first").alias("a"), "b").distinct()
    return pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti")


def group_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups of different labels that can hold similar sets. Entries are
    joined within a list and a range of sizes; then the common prefix shingles of
    a pair and what can follow the last one bound the overlap."""
    mixed = entries.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    # a little wider than the length bound, so that rounding loses nothing
    width = math.log(100 / percent) * (1 + 1e-6) if percent < 100 else 1e-6
    sized = entries.join(mixed, "token", "left_semi").select(
        "token", "group", "label", "n", "rank", F.floor(F.log("n") / width).alias("bucket"))
    small = sized.select(*(F.col(c).alias(f"{c}_a") for c in ("group", "label", "n", "rank")), "token",
                         F.explode(F.array("bucket", F.col("bucket") + 1)).alias("bucket"))
    large = sized.select("token", "bucket", *(F.col(c).alias(f"{c}_b") for c in ("group", "label", "n", "rank")))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (
        (F.col("group_a") < F.col("group_b")) | ((F.col("group_a") == F.col("group_b")) & (F.col("label_a") < F.col("label_b")))))
    met = (small.join(large, ["token", "bucket"]).where(ordered & (F.col("label_a") != F.col("label_b")))
           .where(_within(F.col("n_a"), F.col("rank_a"), F.col("n_b"), F.col("rank_b"), percent)))
    bound = F.count("*") + F.least(F.first("n_a") - F.max("rank_a"), F.first("n_b") - F.max("rank_b"))
    return (met.groupBy("group_a", "label_a", "group_b", "label_b")
            .agg(bound.alias("bound"), (F.first("n_a") + F.first("n_b")).alias("both"))
            .where((100 + percent) * F.col("bound") >= percent * F.col("both")).drop("bound", "both"))


def expanded(pairs: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members (a, b) of paired groups, those with the pair's labels."""
    held = members.join(labels, "set_id")
    for side in "ab":
        pairs = pairs.join(held.select(F.col("group").alias(f"group_{side}"), F.col("label").alias(f"label_{side}"),
                                       F.col("set_id").alias(side)), [f"group_{side}", f"label_{side}"])
    return pairs.select("a", "b")


def connected(sets: DataFrame, percent: int, tables: Tables, known: DataFrame | None = None) -> DataFrame:
    """(set_id, label) of the sets (set_id, members as arrays) that can be similar to
    another one at all: sets of equal labels are connected by similar ones, or were
    by the ``known`` labels. Sets that can't be similar to any have no row."""
    groups, members = grouped(tables.keep(prefixes(sets, percent)))
    groups, members = tables.keep(groups), tables.keep(members)
    labels = members.select("set_id") if known is None else known.join(members.select("set_id"), "set_id", "left_semi")
    labels = tables.keep(labels.withColumn("label", F.col("set_id")) if known is None else labels)

    # the members of a group meet its first one
    pairs = tables.keep(members.where("set_id <> group").select(F.col("set_id").alias("a"), F.col("group").alias("b")))
    if not pairs.isEmpty():
        labels = relabelled(labels, verified(pairs, sets, percent), tables)
    compared = None
    for step in range(ROUNDS):
        pairs = tables.keep(hub_pairs(_entries(groups, members, labels), step, compared))
        labels = relabelled(labels, verified(pairs, sets, percent), tables)
        compared = pairs if compared is None else compared.union(pairs)
    pairs = tables.keep(expanded(group_pairs(_entries(groups, members, labels), percent), members, labels))
    return relabelled(labels, verified(pairs, sets, percent), tables)
