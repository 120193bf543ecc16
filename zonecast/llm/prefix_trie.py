"""The trie of conversation prefixes, from sorted shards around a skeleton.

A turn is named by 16 bytes of the sha256 of its role and text; a conversation
is the path of its turns' names. Paths are dealt to shards by ranges of (path,
conv_id), whose splitters come from a sample. A node whose conversations lie
in more than one shard is a prefix of a splitter's path: the trie of the
splitters' paths is the skeleton. The splitters are broadcast; each shard,
sorted, finishes every node outside the skeleton in one pass with a stack of
open nodes, and gives a partial aggregate for each skeleton node it meets.
The partial aggregates are reduced by node; what is summed over subtrees then
runs up the skeleton alone.

Scale. Texts are read once and leave the scan as 16 bytes a turn. A
conversation thousands share is many rows of one path, which splitters part by
conv_id; the ids that end at one node are joined in each shard, so its hash
reads one row a shard. The sample takes at most SAMPLE_ROWS rows a shard and
about SAMPLE_BYTES in all, which bounds the skeleton. A shard holds about
SHARD_BYTES; a conversation's names and sizes (24 bytes a turn) are one row.

Defined cases: rows without conv_id belong to no conversation; null role or
text is empty; null turns come first, equal ones are ordered by role and name;
repeated rows are turns of their own; a rebuilt conversation may have no turn
and ends at the root; an empty table gives no rows, not even a root; very long
texts count whole; columns are picked by position, others may have any names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.storage import bound_batches, picked, written
from zonecast.llm.text import whole

NAME = 16
SHARED_WITH = 5
LEAD = 9
SHARD_BYTES = 16 << 20
SAMPLE_ROWS = 64
SAMPLE_BYTES = 32 << 20

PARTS = ("skeleton boolean, shard int, node binary, parent binary, conv_id long, depth long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, last_bytes long, ends_sha256 string, ends binary")
FIELDS = [f.strip().split(" ")[0] for f in PARTS.split(",")]


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path (names of its turns, joined), sizes (bytes of their texts)."""
    role, text = whole(F.col("role")), whole(F.col("text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = picked(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", role.alias("role"), F.substring(F.sha2(told, 256), 1, 2 * NAME).alias("name"),
                 F.octet_length(text).cast("long").alias("size")).alias("t"))
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))       # one conversation's turns
    return turns.select("conv_id", F.unhex(F.array_join("ts.name", "")).alias("path"), F.col("ts.size").alias("sizes"))


def rebuilt(own: DataFrame, shared_with: int = SHARED_WITH, lead: int = LEAD) -> DataFrame:
    """Each conversation with its first turns taken from the one whose id is divisible by ``shared_with``."""
    base = own.select(F.col("conv_id").alias("_base"), F.col("path").alias("_path"), F.col("sizes").alias("_sizes"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lead).cast("int")
    rows = own.withColumns({"_h": h, "_at": F.col("conv_id") - F.col("conv_id") % shared_with}).join(
        base, F.col("_at") == F.col("_base"), "left")                                     # at most `shared_with` rows a base
    return rows.select(
        "conv_id",
        F.concat(F.coalesce(F.substring("_path", F.lit(1), F.col("_h") * NAME), F.lit(b"")),
                 F.substring("path", F.col("_h") * NAME + 1, F.octet_length("path"))).alias("path"),
        F.concat(F.coalesce(F.slice("_sizes", F.lit(1), F.col("_h")), F.array().cast("array<long>")),
                 F.slice("sizes", F.col("_h") + 1, F.size("sizes"))).alias("sizes"))


def splitters(rows: DataFrame, shard_bytes: int = SHARD_BYTES, least: int | None = None) -> list[tuple[bytes, int]]:
    """Ascending (path, conv_id) that part the rows into shards of near equal bytes."""
    weight = F.octet_length("path").cast("long") + 8 * F.size("sizes") + 32
    n, total = rows.agg(F.count("*"), F.sum(weight)).first()
    if not n:
        return []
    shards = max(least or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))
    part = min(1.0, SAMPLE_ROWS * shards / n, SAMPLE_BYTES / total)
    some = sorted((bytes(r[0]), r[1], r[2]) for r in rows.select("path", "conv_id", weight).sample(part, 11).collect())
    step, upto, cuts = sum(r[2] for r in some) / shards, 0, []
    for path, conv, size in some:
        if upto + size > (len(cuts) + 1) * step and len(cuts) < shards - 1:
            cuts.append((path, conv))
        upto += size
    return cuts


def _shared(a: bytes, b: bytes) -> int:
    """How many turns two paths have in common at their start."""
    most = min(len(a), len(b)) // NAME
    if a[:most * NAME] == b[:most * NAME]:
        return most
    low, high = 0, most                     # a[:low] equal, a[:high] not
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid * NAME] == b[:mid * NAME] else (low, mid)
    return low


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.sha256(path[:depth * NAME]).digest()[:NAME]


def _ids(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def finish(shard: int, rows: list[tuple[bytes, int, list[int]]], bounds: list[bytes]) -> list[dict]:
    """The nodes of one sorted shard; those that ``bounds`` (the splitters' paths beside it) share are partial."""
    out: list[dict] = []
    stack: list[tuple[dict, list[int], list[dict]]] = []        # node, ids that end there, children without a parent's id

    def close() -> None:
        node, ends, children = stack.pop()
        for child in children:
            child["parent_conv_id"] = node["conv_id"]
        if node["skeleton"]:
            node["ends"] = _ids(ends)
        else:
            node["n_leaves"] = max(node["n_leaves"], 1)
            node["saved_tokens"] += (node["n_convs"] - 1) * node["last_bytes"]
            node["ends_sha256"] = hashlib.sha256(_ids(ends)).hexdigest()
        out.append(node)
        if stack:
            up, _, waiting = stack[-1]
            up["n_convs"] += node["n_convs"]
            up["conv_id"] = min(up["conv_id"], node["conv_id"])
            if not node["skeleton"]:
                up["n_children"] += 1
                up["n_leaves"] += node["n_leaves"]
                up["saved_tokens"] += node["saved_tokens"]
                if not up["skeleton"]:
                    waiting.append(node)

    before = b""
    for path, conv, sizes in rows:
        keep = _shared(before, path)
        while len(stack) > keep + 1:
            close()
        common = max((_shared(b, path) for b in bounds), default=0)
        for depth in range(len(stack), len(path) // NAME + 1):
            inside = depth <= common                            # the root always is
            above = stack[-1][0]["skeleton"] if stack else False
            stack.append(({"skeleton": inside, "shard": shard, "node": _key(path, depth) if inside else None,
                           "parent": _key(path, depth - 1) if above else None, "conv_id": conv, "depth": depth,
                           "parent_conv_id": None, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0,
                           "last_bytes": sizes[depth - 1] if depth else 0, "ends_sha256": None, "ends": None}, [], []))
        stack[-1][1].append(conv)
        stack[-1][0]["n_convs"] += 1
        stack[-1][0]["conv_id"] = min(stack[-1][0]["conv_id"], conv)
        before = path
    while stack:
        close()
    return out


def _shards(rows: DataFrame, cuts: list[tuple[bytes, int]]) -> DataFrame:
    """PARTS: nodes finished in their shard, and partial aggregates of skeleton nodes."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(cuts)                 # about SAMPLE_BYTES / SAMPLE_ROWS

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(shared.value, (p, c)) for p, c in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], names=["shard", "conv_id", "path", "sizes"])

    kinds = {"boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(f, kinds[k]) for f, k in (part.strip().split(" ") for part in PARTS.split(","))])

    def nodes(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        rows_ = sorted(zip(*(table.column(c).to_pylist() for c in ("path", "conv_id", "sizes")), strict=True))
        bounds = [path for path, _ in shared.value[max(shard - 1, 0):shard + 1]]
        return pa.Table.from_pylist(finish(shard, rows_, bounds), schema=schema)

    bound_batches(spark)
    return rows.mapInArrow(deal, "shard int, conv_id long, path binary, sizes array<long>").groupBy("shard").applyInArrow(nodes, PARTS)


def _end_hashes(parts: DataFrame) -> DataFrame:
    """node, ends_sha256 of the skeleton nodes: their shards' ids in order, read as a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

        for node, of_node in groupby(pieces(), key=lambda r: r[0]):
            digest, more = hashlib.sha256(), False
            for _, ids in of_node:
                if ids:
                    digest.update(b"," + ids if more else ids)
                    more = True
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    dealt = parts.where("skeleton").select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard")
    return dealt.select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def _skeleton(parts: DataFrame) -> list[tuple]:
    """(node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens), partial sums reduced."""
    total = parts.where("skeleton").groupBy("node").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("last_bytes").alias("last_bytes"))
    found = {bytes(r["node"]): r.asDict() for r in total.collect()}      # the nodes on splitters' paths
    for node in sorted(found.values(), key=lambda r: -r["depth"]):
        node["n_leaves"] = max(node["n_leaves"], 1)
        node["saved_tokens"] += (node["n_convs"] - 1) * node["last_bytes"]
        if node["parent"] is not None:
            up = found[bytes(node["parent"])]
            up["n_children"] += 1
            up["n_leaves"] += node["n_leaves"]
            up["saved_tokens"] += node["saved_tokens"]
    return [(k, r["conv_id"], r["depth"], None if r["parent"] is None else found[bytes(r["parent"])]["conv_id"],
             r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for k, r in found.items()]


def prefix_trie(rows: DataFrame, shard_bytes: int = SHARD_BYTES, least: int | None = None) -> DataFrame:
    """One row a node of the trie of ``rows`` (conv_id, path, sizes).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    spark = rows.sparkSession
    rows = written(rows, "rebuilt")
    parts = written(_shards(rows, splitters(rows, shard_bytes, least)), "nodes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    skeleton = spark.createDataFrame(_skeleton(parts), "node binary, conv_id long, depth long, parent_conv_id long, "
                                     "n_convs long, n_children long, n_leaves long, saved_tokens long")
    above = skeleton.select(F.col("node").alias("parent"), F.col("conv_id").alias("_up"))
    local = parts.where("NOT skeleton").join(F.broadcast(above), "parent", "left")
    return local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up")).select(*columns).unionByName(
        skeleton.join(_end_hashes(parts), "node").select(*columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(rebuilt(written(paths(conversations), "paths")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: Ties of ``turn`` are ordered by text here; the given tables have none.
ORACLE = """
WITH RECURSIVE bits AS (
  SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS s FROM bits WHERE k = 8),
turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
leads AS (
  SELECT conv_id, ts, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, s[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM turns, steps),
rebuilt AS (
  SELECT l.conv_id, list_concat(coalesce(b.ts[1:l.h], []), l.ts[l.h + 1:]) AS path
  FROM leads l LEFT JOIN turns b ON b.conv_id = l.conv_id - l.conv_id % 5),
members AS (SELECT conv_id, unnest(range(len(path) + 1)) AS depth, path FROM rebuilt),
nodes AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM members GROUP BY ALL),
sized AS (
  SELECT *, node[1:depth - 1] AS parent, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(node[depth].text) END AS saved
  FROM nodes),
children AS (SELECT parent, count(*) AS n FROM sized WHERE depth > 0 GROUP BY parent),
above AS (
  SELECT s.node, s.saved, c.n IS NULL AS leaf, unnest(range(s.depth + 1)) AS upto
  FROM sized s LEFT JOIN children c ON c.parent = s.node),
subtrees AS (SELECT node[1:upto] AS node, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves FROM above GROUP BY ALL)
SELECT s.conv_id, s.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, s.n_convs, coalesce(c.n, 0) AS n_children,
       t.leaves AS n_leaves, t.saved::BIGINT AS saved_tokens, s.ends_sha256
FROM sized s JOIN subtrees t ON t.node = s.node LEFT JOIN children c ON c.parent = s.node
LEFT JOIN nodes p ON s.depth > 0 AND p.node = s.parent
"""
