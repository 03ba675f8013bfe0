"""A Merkle manifest of a document table by time-forward processing.

Every row is a leaf, every group (a language) a tree with fans of FAN, and the roots of the groups
are the leaves of one more tree. Nodes carry labels that grow from children to parents: the level
first (the levels of the upper tree follow on those of the groups), then tree and number. A node
sends its digest as a message to its parent's label. The messages wait in an external priority queue, a
table in the shared folder that is partitioned by level, and are taken out in order of labels: all
messages of the lowest level are due at once, the shuffle brings those of one label together, the node
digests them in order of their ports and sends its own digest ahead. A group's root may wait for many
levels, until the upper tree begins. Then the sweep is reversed: from the highest label down, a node sends
each child the part of the proof that lies above it (for every level what stands left and right
of the path), through a second queue, and the leaves fold what they get.

No task holds more than the FAN messages of a label, groups of any size are spread by range, and a
level is a table, so lost executors cost one level at most.

Edge cases: null columns are encoded as such; rows that agree in the order are ordered by their
digests, so equal rows are interchangeable; a null group comes first; a group of one row is its own root; a
table of one row is its own root with an empty proof; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.numbering import numbered
from tallyweave.llm.storage import shared_folder, stored

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The upper tree's key; keys of groups are empty (null) or begin with 1.
UPPER = "2"
_UP = "level int, tree string, height int, rank bigint, node bigint, port int, digest string"
_FAMILY = "level int, tree string, height int, rank bigint, node bigint, kids array<string>, digest string"
_DOWN = "level int, tree string, node bigint, subroot string, path array<struct<before:string,after:string>>"


def encoded(value: str) -> str:
    """A value as its UTF-8 byte count, a colon and the value, or - for null."""
    text = f"CAST({value} AS STRING)"
    return f"coalesce(concat(octet_length({text}), ':', {text}), '-')"


def leaf_digest(values: list[str]) -> str:
    return f"sha2(concat({', '.join(map(encoded, values))}), 256)"


def height(count: int) -> int:
    """Levels above the leaves of a tree of count leaves."""
    levels = 0
    while FAN**levels < count:
        levels += 1
    return levels


class Queue:
    """Messages that wait for a level, in a table of the shared folder; taking a level out reads it alone."""

    def __init__(self, df: DataFrame, schema: str):
        self.spark, self.schema = df.sparkSession, schema
        self.path = f"{shared_folder(df)}/queue-{uuid.uuid4().hex}"
        self.used = False

    def send(self, messages: DataFrame) -> None:
        messages.write.partitionBy("level").mode("append").parquet(self.path)
        self.used = True

    def due(self, level: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).where(f"level = {level}")


def _to_parent(upper: int) -> list[str]:
    """The columns of a message from node (level, tree, height, rank, node, digest) to its parent; group roots go to the upper tree."""
    root = f"level = height AND tree <> '{UPPER}'"
    return [
        f"IF({root}, {upper + 1}, level + 1) AS level",
        f"IF({root}, '{UPPER}', tree) AS tree",
        "height", "rank",
        f"IF({root}, rank, node) div {FAN} AS node",
        f"CAST(IF({root}, rank, node) % {FAN} AS INT) AS port",
        "digest",
    ]


def _ascended(leaves: DataFrame, upper: int, top: int) -> Queue:
    """The sweep from the leaves to the root: families (a node, its children's digests and its own) by level."""
    waiting, families = Queue(leaves, _UP), Queue(leaves, _FAMILY)
    waiting.send(leaves.selectExpr("0 AS level", "tree", "height", "rank", "node", "digest").selectExpr(*_to_parent(upper)))
    for level in range(1, top + 1):
        due = waiting.due(level)
        if level > upper:
            # Roots of groups come with their own height and rank; the upper tree has one of each.
            due = due.withColumn("height", F.lit(top)).withColumn("rank", F.lit(0).cast("bigint"))
        kids = due.groupBy("tree", "height", "rank", "node").agg(F.expr("array_sort(collect_list(struct(port, digest))).digest AS kids"))
        families.send(kids.selectExpr(f"{level} AS level", "tree", "height", "rank", "node", "kids", "sha2(array_join(kids, ''), 256) AS digest"))
        if level < top:
            waiting.send(families.due(level).selectExpr(*_to_parent(upper)))
    return families


def _beside(port: str) -> str:
    """What stands before and after a child in its family."""
    return f"named_struct('before', array_join(slice(kids, 1, {port}), ''), 'after', array_join(slice(kids, {port} + 2, {FAN}), ''))"


def _descended(families: Queue, trees: DataFrame, upper: int, top: int, root: str) -> Queue:
    """The reversed sweep: for every label the part of the proof above it."""
    waiting = Queue(trees, _DOWN)
    nothing = "CAST(array() AS array<struct<before:string,after:string>>) AS path"
    if top > upper:
        waiting.send(trees.sparkSession.range(1).selectExpr(f"{top} AS level", f"'{UPPER}' AS tree", "0L AS node", "CAST(NULL AS STRING) AS subroot", nothing))
    else:
        waiting.send(trees.selectExpr("height AS level", "tree", "0L AS node", f"'{root}' AS subroot", nothing))
    for level in range(top, 0, -1):
        if level == 1 and level <= upper:
            break
        met = families.due(level).select("tree", "node", "kids").join(waiting.due(level).drop("level"), ["tree", "node"])
        kids = met.selectExpr("*", "posexplode(kids) AS (port, kid)").selectExpr(
            "tree", f"node * {FAN} + port AS node", "kid", "subroot", f"concat(array({_beside('port')}), path) AS path"
        )
        if level == upper + 1:
            named = kids.withColumnRenamed("node", "rank").drop("tree").join(trees.select("rank", "tree", "height"), "rank")
            waiting.send(named.selectExpr("height AS level", "tree", "0L AS node", "kid AS subroot", "path"))
        else:
            waiting.send(kids.selectExpr(f"{level - 1} AS level", "tree", "node", "subroot", "path"))
    return waiting


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, tampered: str | None = None) -> DataFrame:
    """(key, leaf, subroot, root, path, found): every row's leaf, its roots, and for each level above it the digests beside its path.

    `found` is the leaf digest of the row as it is met again: that of the expression `tampered`, or the leaf itself where it is null.
    """
    tree = f"IF(`{group}` IS NULL, '', concat('1', CAST(`{group}` AS STRING)))"
    leaf = leaf_digest([f"`{f}`" for f in fields])
    found = f"coalesce({tampered}, {leaf})" if tampered else leaf
    # Text is digested here, once; only narrow rows are stored and sorted.
    narrow = stored(docs.selectExpr(f"`{key}` AS key", f"{tree} AS tree", f"{leaf} AS digest", f"{found} AS found"))
    placed = numbered(narrow, "tree", ["key", "digest"], "node", "leaves")
    counts = stored(narrow.groupBy("tree").agg(F.count("*").alias("leaves")).withColumn("all", F.lit("")))
    tall = f"CAST(array_position(transform(sequence(0, 20), h -> shiftleft(1L, 3 * h) >= leaves), true) - 1 AS INT) AS height"
    trees = stored(numbered(counts, "all", ["tree"], "rank", "trees").selectExpr("tree", "rank", "trees", tall))
    leaves = stored(placed.join(trees, "tree"))
    sizes = trees.agg(F.max("height").alias("upper"), F.max("trees").alias("trees")).first()
    if sizes["trees"] is None:
        nothing = "CAST(array() AS array<struct<before:string,after:string>>)"
        return narrow.selectExpr(f"key AS `{key}`", "digest AS leaf", "digest AS subroot", "digest AS root", f"{nothing} AS path", "found")
    upper, top = sizes["upper"], sizes["upper"] + height(sizes["trees"])
    families = _ascended(leaves, upper, top)
    root = (families.due(top) if top else leaves).first()["digest"]
    above = _descended(families, trees, upper, top, root)
    # What a leaf's parent knows, or what was sent to the leaf itself where it is a tree of its own.
    parents = above.due(0).selectExpr("tree", "node", "CAST(NULL AS array<string>) AS kids", "subroot", "path AS above")
    if upper:
        first = families.due(1).select("tree", "node", "kids").join(above.due(1).drop("level"), ["tree", "node"])
        parents = parents.union(first.selectExpr("tree", "node", "kids", "subroot", "path"))
    own = leaves.selectExpr("key", "digest AS leaf", "found", "tree", f"CAST(node % {FAN} AS INT) AS port", f"node div {FAN} AS node")
    path = f"IF(kids IS NULL, above, concat(array({_beside('port')}), above)) AS path"
    # A group of one row hands its leaf up: the leaf is the subroot, also where it is the root.
    return own.join(parents, ["tree", "node"]).selectExpr(f"key AS `{key}`", "leaf", "subroot", f"'{root}' AS root", path, "found")


#: What is checked of a proof: the digest of all siblings, and the root that the leaf as found leads to.
PROOF = "sha2(array_join(transform(path, p -> concat(p.before, p.after)), ''), 256)"
FOLDED = "aggregate(path, found, (d, p) -> sha2(concat(p.before, d, p.after), 256))"


def verified(entries: DataFrame) -> DataFrame:
    """entries of a manifest with proof_sha256, folded_root and verified instead of path and found."""
    folded = entries.withColumn("proof_sha256", F.expr(PROOF)).withColumn("folded_root", F.expr(FOLDED))
    return folded.withColumn("verified", F.expr("folded_root = root")).drop("path", "found")
