"""Exact dedup with an extendible-hash index on shared files (DataFrame only).

Every text gets a 64-bit hash. A directory over the leading bits of the hash is grown
by doubling: a bucket with more than `capacity` distinct keys splits on the next bit,
and the directory doubles when that bucket already used all its bits. It has at most
2**MAX_DEPTH entries whatever the input, so it is broadcast; at the greatest depth a
bucket may hold more, and is then still one range of keys of one task.

Only a hash that several documents hold can belong to equal texts. The texts of those
documents are compared by their bytes: partial aggregation folds copies before anything
moves, so that a group of any size sends one row a task, and different texts with one
hash become links of one chain. Every key is entered in the index: its bucket's owner
task sorts the bucket's keys, numbers the links of each chain, and writes them to the
shared folder, each bucket in one file. A document finds its group by probing the bucket
that the directory names for its hash, and there the chain's link with its digest.

Defined results: null text counts as empty; empty texts form one group; rows that
repeat a doc_id count as members each and share the verdict of their id; a null doc_id
stays only where its group has no other; an empty table gives no rows. Only doc_id and
text are read, so other columns may have any name.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, release, texts_of, written

#: Most bits of a hash that the directory uses: at most 65,536 entries.
MAX_DEPTH = 16
#: Distinct keys of a bucket.
CAPACITY = 256
#: Groups, and ids or hashes, that are broadcast at most.
FEW, FEW_IDS = 1 << 17, 1 << 20


def grow_directory(counts: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH) -> list[tuple[int, int]]:
    """counts: distinct keys by the top `max_depth` bits of their hash. Returns for
    each of the 2**max_depth prefixes the (bucket, local depth) it lands in."""
    buckets, depth = [(0, 0, sorted(counts.items()))], 0
    done = []
    while buckets:
        prefix, local, keys = buckets.pop()
        if sum(n for _, n in keys) <= capacity or local == max_depth:
            done.append((prefix << (max_depth - local), local))
            continue
        depth = max(depth, local + 1)  # the directory doubles
        bit = 1 << (max_depth - local - 1)
        buckets.append((prefix * 2, local + 1, [k for k in keys if not k[0] & bit]))
        buckets.append((prefix * 2 + 1, local + 1, [k for k in keys if k[0] & bit]))
    out = [(0, 0)] * (1 << max_depth)
    for number, (first, local) in enumerate(sorted(done)):
        for slot in range(first, first + (1 << (max_depth - local))):
            out[slot] = (number, local)
    return out


def slot_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - MAX_DEPTH).cast("int")


class Directory:
    """The directory of a table of distinct keys (column h): slots and their buckets."""

    def __init__(self, keys: DataFrame, capacity: int):
        counts = keys.groupBy(slot_of(F.col("h")).alias("slot")).count().collect()  # at most 2**MAX_DEPTH rows
        self.entries = grow_directory({r["slot"]: r["count"] for r in counts}, capacity)
        starts: dict[int, list[int]] = {}
        for slot, (bucket, _) in enumerate(self.entries):
            starts.setdefault(bucket, [slot, slot])[1] = slot
        said = json.dumps([[bucket, *ends] for bucket, ends in starts.items()])
        one = keys.sparkSession.range(1).select(F.explode(F.from_json(F.lit(said), "array<array<int>>")).alias("x"))
        self.slots = one.select(F.col("x")[0].alias("bucket"), F.explode(F.sequence(F.col("x")[1], F.col("x")[2])).alias("slot"))

    def at_bucket(self, df: DataFrame) -> DataFrame:
        """df (h and others) with the bucket that each row's hash leads to."""
        return df.withColumn("slot", slot_of(F.col("h"))).join(F.broadcast(self.slots), "slot").drop("slot")


def keys_of(docs: DataFrame) -> DataFrame:
    """doc_id, hash and digest of every document, written once."""
    texts = texts_of(docs)
    return written(texts.select("doc_id", F.xxhash64("text").alias("h"), F.unhex(F.sha2("text", 256)).alias("sha")), "keys")


def distinct_texts(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """h, sha, keep_id and group_size of every distinct text. Texts whose hash several
    documents hold are told apart by their bytes; a lone hash needs no comparison."""
    shared = hashes.where("group_size > 1").select("h")
    few = shared.count() <= FEW_IDS
    texts = texts_of(docs).withColumn("h", F.xxhash64("text"))
    texts = texts.join(F.broadcast(shared), "h", "left_semi") if few else texts
    groups = texts.groupBy("h", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.select("h", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size")
    return groups.unionByName(hashes.where("group_size = 1")) if few else groups


def build_index(docs: DataFrame, keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, Directory]:
    """bucket, h, link, sha, keep_id, group_size of every distinct text, written by the
    buckets' owner tasks, and the directory that leads to the buckets."""
    per = keys.groupBy("h").agg(F.count("*").alias("group_size"), F.max("sha").alias("sha"), F.max("doc_id").alias("keep_id"))
    hashes = written(per, "hashes")
    directory = Directory(hashes, capacity)
    owned = directory.at_bucket(distinct_texts(docs, hashes)).repartition("bucket")
    chain = Window.partitionBy("bucket", "h").orderBy("sha")
    linked = owned.withColumn("link", F.row_number().over(chain)).sortWithinPartitions("bucket", "h", "link")
    index = written(linked, "index")
    release(hashes)
    return index, directory


def exact_groups(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket."""
    keys = keys_of(docs)
    index, directory = build_index(docs, keys, capacity)
    groups = index.where("group_size > 1").select("bucket", "h", "sha", "keep_id", "group_size")
    if groups.count() <= FEW:
        groups = F.broadcast(groups)
    probed = directory.at_bucket(keys).join(groups, ["bucket", "h", "sha"], "left")  # a key without a group is its own entry
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    found = probed.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), "sha", "bucket")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "bucket")


def dedup(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, all their columns unchanged. Few ids go as a rule, so
    they are what is sent to the documents, which then need not move."""
    verdicts = exact_groups(docs, capacity).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = verdicts.where(~F.col("kept")).select("doc_id")
    name = fresh(docs, "gone")
    ids = written(gone.select(F.col("doc_id").alias(name)), "gone")
    at = F.col("doc_id").cast("long").eqNullSafe(F.col(name))
    return docs.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, at, "left_anti")
