"""Merkle dataset manifest: a hash tree over all documents, a membership proof for each, and the check of every proof."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import LOWER, UPPER, numbered, saved, table

FANOUT = 16
# A superblock is a subtree of this many levels; its leaves are worked on together.
DEPTH = 2
TAMPER = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def leaf_of(fields: list[Column]) -> Column:
    """SHA-256 of all fields, each ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    texts = [c.cast("string") for c in fields]
    marked = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in texts]
    return F.sha2(F.concat(*marked), 256)


def _joined(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def _in_order(place: str, digest: str) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct(place, digest))), lambda x: x[digest])


def superblocks(leaves: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(tree, place, digest): the top node of every aligned run of ``FANOUT ** depth`` leaves (tree, position, leaf).

    A tree that fits into its first superblock ends as soon as one node is left; in a larger tree even a lone node is
    hashed up to the superblock's top.
    """
    wide = FANOUT**depth
    blocks = leaves.groupBy("tree", F.floor(F.col("position") / wide).alias("place")).agg(_in_order("position", "leaf").alias("nodes"))
    for _ in range(depth):
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size("nodes") - 1) / FANOUT).cast("int")),
            lambda r: _joined(F.slice("nodes", r * FANOUT + 1, F.lit(FANOUT))),
        )
        blocks = blocks.withColumn("nodes", F.when((F.size("nodes") > 1) | (F.col("place") > 0), runs).otherwise(F.col("nodes")))
    return blocks.select("tree", "place", F.col("nodes")[0].alias("digest"))


def climb(nodes: DataFrame) -> list[DataFrame]:
    """From (tree, place, digest) up: for each level the runs (tree, run, digests) of its nodes. A tree's last run is its single top node."""
    levels = []
    while True:
        runs = nodes.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("run")).agg(_in_order("place", "digest").alias("digests"))
        levels.append(saved(runs))
        above = levels[-1].where("run > 0 OR size(digests) > 1")
        if above.isEmpty():
            return levels
        nodes = above.select("tree", F.col("run").alias("place"), _joined(F.col("digests")).alias("digest"))


def _tops(runs: DataFrame) -> DataFrame:
    return runs.where("run = 0 AND size(digests) = 1").select("tree", F.col("digests")[0].alias("digest"))


def descend(levels: list[DataFrame], top_paths: DataFrame | None, inside: bool) -> DataFrame:
    """(tree, place, path) for the lowest nodes of ``levels``: the runs that lie on their way up, the lowest first.

    A step of a path has the node's own place in the run, the run's digests and ``inside``. Paths are handed down level
    by level, each parent to at most ``FANOUT`` children, and those of ``top_paths`` (tree, path) to the tops of the trees.
    """
    empty = F.array().cast("array<struct<at:int,digests:array<string>,inside:boolean>>")
    paths = None
    for runs in reversed(levels):
        tops = runs.where("run = 0 AND size(digests) = 1").select("tree", F.lit(0).cast("long").alias("place"))
        if top_paths is None:
            tops = tops.withColumn("path", empty)
        else:
            tops = tops.join(top_paths.withColumnRenamed("tree", "_tree"), F.col("tree") == F.col("_tree")).select("tree", "place", "path")
        if paths is not None:
            parents = paths.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("path").alias("_path"))
            step = F.struct(F.col("at").cast("int").alias("at"), F.col("digests"), F.lit(inside).alias("inside"))
            members = runs.select("tree", "run", "digests", F.explode(F.sequence(F.lit(0), F.size("digests") - 1)).alias("at"))
            members = members.join(parents, (F.col("tree") == F.col("_tree")) & (F.col("run") == F.col("_place")))
            below = members.select("tree", (F.col("run") * FANOUT + F.col("at")).alias("place"), F.concat(F.array(step), "_path").alias("path"))
            tops = tops.unionByName(below)
        paths = saved(tops)
    return paths


def finish(leaves: pd.DataFrame, outer: pd.DataFrame, depth: int = DEPTH) -> pd.DataFrame:
    """Proofs of one superblock's leaves: its subtree is reduced, joined to the runs above it, and every leaf folded to the root."""
    leaves = leaves.sort_values("position")
    first = int(leaves["position"].iloc[0]) == 0
    local = [leaves["leaf"].tolist()]
    for _ in range(depth):
        if first and len(local[-1]) == 1:
            break
        local.append([digest_of("".join(local[-1][k : k + FANOUT])) for k in range(0, len(local[-1]), FANOUT)])
    above, node, subroot = [], local[-1][0], local[-1][0]
    for step in outer.sort_values("step").itertuples():
        run = step.run.split(",")
        above.append(("".join(run[: step.at]), "".join(run[step.at + 1 :])))
        node = digest_of("".join(run))
        subroot = node if step.inside else subroot
    tail = "".join(left + right for left, right in above)
    proofs, folded = [], []
    for k, (leaf, other) in enumerate(zip(local[0], leaves["tampered"], strict=True)):
        proof, digest, at = [], other if isinstance(other, str) else leaf, k
        for nodes in local[:-1]:
            lo = at // FANOUT * FANOUT
            left, right = "".join(nodes[lo:at]), "".join(nodes[at + 1 : lo + FANOUT])
            proof += [left, right]
            digest, at = digest_of(left + digest + right), at // FANOUT
        for left, right in above:
            digest = digest_of(left + digest + right)
        proofs.append(digest_of("".join(proof) + tail))
        folded.append(digest)
    out = {"doc_id": leaves["doc_id"], "leaf": leaves["leaf"], "subroot": subroot, "root": node, "proof_sha256": proofs, "folded_root": folded}
    return pd.DataFrame(out).assign(verified=[f == node for f in folded])


def manifest(docs: DataFrame, depth: int = DEPTH, tamper: int = TAMPER) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves of a source ascend by doc_id and are hashed in runs of ``FANOUT`` until one node, its subroot, is left;
    subroots in order of source, null first, likewise give the root. Where ``tamper`` divides the CRC-32 of the decimal
    doc_id, the proof is checked against the document with its text's A-Z lower-cased, else against the document itself.

    Places are taken by a range partitioning, so a source of any size spreads over many tasks. A superblock, an aligned
    subtree of at most ``FANOUT ** depth`` leaves, is reduced to one node; only these nodes and the few above them form
    the outer tree, which is built level by level and handed down again as one path per superblock. Leaves and the
    outer runs they need then meet in a cogroup.

    Null fields count as ``-``. A null doc_id comes first in its source and is never tampered with; rows that repeat an id
    are leaves of their own, in order of their digest. An empty table gives an empty result; other columns are ignored.
    """
    text = docs["text"].cast("string")
    fields = [docs[c] for c in FIELDS]
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % tamper == 0
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        leaf_of(fields).alias("leaf"),
        F.when(chosen, leaf_of([*fields[:-1], F.translate(text, UPPER, LOWER)])).alias("tampered"),
    )
    leaves = numbered(rows, "source", ["doc_id", "leaf"]).select(
        F.col("group_no").alias("tree"), "position", F.col("doc_id").cast("string").alias("doc_id"), "leaf", "tampered"
    )
    leaves = saved(leaves)
    sources = climb(superblocks(leaves, depth))
    subroots = _tops(sources[0])
    for runs in sources[1:]:
        subroots = subroots.unionByName(_tops(runs))
    roots = climb(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest"))
    of_source = descend(roots, None, False).select(F.col("place").alias("tree"), "path")
    paths = descend(sources, of_source, True)
    steps = paths.select("tree", F.col("place").alias("block"), F.posexplode("path").alias("step", "on"))
    outer = steps.select("tree", "block", "step", F.col("on.inside").alias("inside"), F.col("on.at").alias("at"), F.array_join("on.digests", ",").alias("run"))
    blocks = leaves.withColumn("block", F.floor(F.col("position") / FANOUT**depth))
    found = (
        blocks.groupBy("tree", "block")
        .cogroup(outer.groupBy("tree", "block"))
        .applyInPandas(
            lambda left, right: finish(left, right, depth),
            "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        )
    )
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH RECURSIVE marked AS (
    SELECT doc_id, source,
           concat(coalesce(concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id), '-'), coalesce(concat(strlen(source), ':', source), '-'),
                  coalesce(concat(strlen(lang), ':', lang), '-'), coalesce(concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars), '-')) AS head,
           coalesce(concat(strlen(text), ':', text), '-') AS body,
           coalesce(concat(strlen(text), ':', translate(text, '{UPPER}', '{LOWER}')), '-') AS small,
           xor(4294967295, list_reduce(
               list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
               lambda crc, byte: list_reduce(range(8), lambda s, k: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END, xor(crc, byte)),
               CAST(4294967295 AS BIGINT))) AS crc
    FROM documents
), leaves AS (
    SELECT doc_id, source, sha256(concat(head, body)) AS leaf, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
           CASE WHEN coalesce(crc % 5 = 0, false) THEN sha256(concat(head, small)) ELSE sha256(concat(head, body)) END AS seen
    FROM marked
), up AS (
    SELECT source, CAST(0 AS BIGINT) AS level, CAST(pos AS BIGINT) AS pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
    UNION ALL
    SELECT source, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY source, level, pos // 16, n
), subroots AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM up WHERE n = 1
), above AS (
    SELECT CAST(0 AS BIGINT) AS level, CAST(place AS BIGINT) AS pos, subroot AS digest, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16 FROM above WHERE n > 1 GROUP BY level, pos // 16, n
), beside AS (
    SELECT source, level, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM up WHERE n > 1 WINDOW w AS (PARTITION BY source, level, pos // 16 ORDER BY pos)
), beside_above AS (
    SELECT level, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM above WHERE n > 1 WINDOW w AS (PARTITION BY level, pos // 16 ORDER BY pos)
), folded AS (
    SELECT doc_id, source, leaf, CAST(0 AS BIGINT) AS level, CAST(pos AS BIGINT) AS pos, seen AS digest, '' AS proof FROM leaves
    UNION ALL
    SELECT f.doc_id, f.source, f.leaf, f.level + 1, f.pos // 16, sha256(concat(b.before, f.digest, b.after)), concat(f.proof, b.before, b.after)
    FROM folded f JOIN beside b ON f.source IS NOT DISTINCT FROM b.source AND f.level = b.level AND f.pos = b.pos
), to_subroot AS (
    SELECT f.*, s.subroot, s.place FROM folded f JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source
    JOIN (SELECT source, max(level) AS top FROM up GROUP BY source) t ON f.source IS NOT DISTINCT FROM t.source AND f.level = t.top
), to_root AS (
    SELECT doc_id, source, leaf, subroot, CAST(0 AS BIGINT) AS level, CAST(place AS BIGINT) AS pos, digest, proof FROM to_subroot
    UNION ALL
    SELECT f.doc_id, f.source, f.leaf, f.subroot, f.level + 1, f.pos // 16, sha256(concat(b.before, f.digest, b.after)), concat(f.proof, b.before, b.after)
    FROM to_root f JOIN beside_above b ON f.level = b.level AND f.pos = b.pos
)
SELECT f.doc_id, f.leaf, f.subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root, f.digest = r.digest AS verified
FROM to_root f, (SELECT digest, level FROM above WHERE n = 1) r WHERE f.level = r.level
"""
