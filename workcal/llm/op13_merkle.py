"""Merkle manifest of a dataset: digests of rows, of runs of eight, and proofs by descent.

``build`` turns digested rows into a tree per group (a language, say) and one tree over
the groups' roots. Every inner node is kept as a record, digest to children, in a table
per height: a content-addressed store, in which equal runs are one record. ``proofs``
answers requests for leaves from that store alone, top down: a batch of requests begins
at the root, is split at each record by the next base-8 digit of the ranks, and takes the
children that were not selected with it as one segment of its path; at the leaves the
segments are turned round. Requests that share a prefix of digits descend together, so
height h holds one row for eight to the power of h leaves, whatever their number.

Ranks come from a range sort, so a group with most of the rows is spread over tasks, and
a height is one aggregation of at most eight rows per key. The driver sees counts only.

Defined cases: a null field is written ``-``; the null group comes first; null ids come
first in their group; rows with one id follow in the order of their digests, so repeated
rows are leaves side by side; an empty table has no root and no rows. A lone leaf is its
group's root, a lone group root the root, and its path is empty. Columns that
are not named are never read, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import stage
from .ordering import numbered
from .texts import table

#: Children of a node.
WIDTH = 8
_DIGIT = (WIDTH - 1).bit_length()
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Tree(NamedTuple):
    """Records by height, from 1, and the roots ``(part, root, height)``."""

    records: list[DataFrame]
    roots: DataFrame


class Manifest(NamedTuple):
    """``leaves`` (``part, key, leaf, _rank`` and what else was given), the tree of each
    part, the ranked ``parts`` and the tree over their roots."""

    leaves: DataFrame
    lower: Tree
    parts: DataFrame
    upper: Tree


def field_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 over fields, each ``-`` if null, else its byte count, ``:`` and itself."""
    shown = [c.cast("string") for c in fields]
    parts = [F.concat(F.octet_length(c).cast("string"), F.lit(":"), c) for c in shown]
    return F.sha2(F.concat(*(F.coalesce(p, F.lit("-")) for p in parts)), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def _tree(nodes: DataFrame, name: str) -> Tree:
    """The tree of each part over ``nodes`` (``part, place, width, digest``), where width
    is the number of nodes of the part."""
    records, roots, height = [], [], 0
    widest = nodes.agg(F.max("width")).first()[0] or 0
    while True:
        alone = nodes.filter("width = 1").select("part", F.col("digest").alias("root"), F.lit(height).alias("height"))
        roots.append(alone)
        if widest <= 1:
            break
        children = F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda c: c["digest"])
        above = (
            nodes.filter("width > 1")
            .groupBy("part", "width", F.shiftright("place", _DIGIT).alias("place"))
            .agg(children.alias("children"))
            .select("part", "place", F.shiftright(F.col("width") + WIDTH - 1, _DIGIT).alias("width"),
                    F.sha2(_joined(F.col("children")), 256).alias("digest"), "children")
        )
        height, widest = height + 1, (widest + WIDTH - 1) >> _DIGIT
        nodes = stage(above, f"{name}-{height}")
        records.append(nodes.select("digest", "children"))
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return Tree(records, found)


def build(leaves: DataFrame, name: str = "merkle") -> Manifest:
    """The manifest of ``leaves`` (``part, key, leaf``, and columns of the caller's):
    a part's leaves ascend by key, the parts' roots by part."""
    ranked = numbered(leaves, ["part"], ["key", "leaf"], f"{name}-leaves")
    counts = stage(ranked.groupBy("part").agg(F.count("*").alias("width")), f"{name}-counts")
    nodes = ranked.select("part", F.col("_rank").alias("place"), F.col("leaf").alias("digest"))
    sized = nodes.join(counts.withColumnRenamed("part", "_part"), F.col("part").eqNullSafe(F.col("_part")))
    lower = _tree(sized.drop("_part"), f"{name}-lower")
    parts = numbered(lower.roots, [], ["part"], f"{name}-parts")
    tops = parts.select(
        F.lit(0).alias("part"), F.col("_rank").alias("place"), F.lit(parts.count()).alias("width"), F.col("root").alias("digest")
    )
    upper = _tree(tops, f"{name}-upper")
    return Manifest(ranked, lower, parts, upper)


def root_of(manifest: Manifest) -> str | None:
    """The dataset's digest, or None for an empty table."""
    found = manifest.upper.roots.first()
    return found.root if found else None


def _segment(children: Column, digit: Column) -> Column:
    """The children left and right of the selected one, as text."""
    left = F.slice(children, 1, digit)
    right = F.slice(children, digit + 2, F.greatest(F.size(children) - digit - 1, F.lit(0)))
    return F.struct(_joined(left).alias("left"), _joined(right).alias("right"))


def _descend(batches: DataFrame, tree: Tree, down_to: int, wanted: DataFrame | None = None) -> DataFrame:
    """``batches`` (``part, height, place, digest, path``) taken down from record to record
    to the height ``down_to``; those that begin below it are left out.

    ``wanted`` (``part, _rank``) keeps only the branches that lead to these leaves.
    """
    reached = None
    for height in range(len(tree.records), down_to, -1):
        here = batches.filter(F.col("height") == height)
        here = here if reached is None else here.unionByName(reached)
        # Equal runs have one digest: the store answers with one record.
        store = tree.records[height - 1].dropDuplicates(["digest"])
        opened = here.join(store, "digest").select(
            "part", "place", "path", "children", F.posexplode("children").alias("digit", "child")
        )
        reached = opened.select(
            "part",
            F.lit(height - 1).alias("height"),
            (F.shiftleft("place", _DIGIT) + F.col("digit")).alias("place"),
            F.col("child").alias("digest"),
            F.array_append("path", _segment(F.col("children"), F.col("digit"))).alias("path"),
        )
        if wanted is not None:
            prefix = F.shiftright("_rank", _DIGIT * (height - 1)).alias("_prefix")
            on = wanted.select(F.col("part").alias("_part"), prefix).distinct()
            same = F.col("part").eqNullSafe(F.col("_part")) & (F.col("place") == F.col("_prefix"))
            reached = reached.join(on, same, "left_semi")
    here = batches.filter(F.col("height") == down_to)
    return here if reached is None else here.unionByName(reached)


_PATH = "array<struct<left:string,right:string>>"


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Each requested leaf with ``subroot``, ``root`` and ``path``, from the leaf upwards:
    per level the digests left and right of the selected node.

    ``requests`` are rows of ``manifest.leaves`` (default: all of them) and keep their
    columns.
    """
    top = manifest.upper.roots.select(
        "part", "height", F.lit(0).cast("bigint").alias("place"), F.col("root").alias("digest"),
        F.array().cast(_PATH).alias("path"),
    )
    subroots = _descend(top, manifest.upper, 0).select(F.col("place").alias("_rank"), "digest", "path")
    wanted = requests
    asked = manifest.leaves if requests is None else requests
    begun = manifest.parts.select("part", "height", "_rank").join(subroots, "_rank").select(
        "part", "height", F.lit(0).cast("bigint").alias("place"), "digest", "path"
    )
    # The last record is opened by the run's requests, so that paths are never shuffled per leaf.
    runs = _descend(begun, manifest.lower, 1, wanted).filter("height = 1").drop("height")
    extra = [c for c in asked.columns if c not in ("part", "_rank")]
    request = F.struct(F.col("_rank").bitwiseAND(F.lit(WIDTH - 1)).cast("int").alias("digit"), *extra)
    by_run = asked.groupBy("part", F.shiftright("_rank", _DIGIT).alias("place")).agg(F.collect_list(request).alias("asked"))
    by_run = by_run.withColumnsRenamed({"part": "_part", "place": "_place"})
    same_run = F.col("part").eqNullSafe(F.col("_part")) & (F.col("place") == F.col("_place"))
    several = (
        runs.join(by_run, same_run)
        .join(manifest.lower.records[0].dropDuplicates(["digest"]), "digest")
        .select("part", "path", "children", F.explode("asked").alias("r"))
        .select(
            "part",
            F.array_append("path", _segment(F.col("children"), F.col("r.digit"))).alias("path"),
            *(F.col(f"r.{c}").alias(c) for c in extra),
        )
        if manifest.lower.records
        else None
    )
    # A part of one leaf has no record: its root is the leaf.
    lone = begun.filter("height = 0").select(F.col("part").alias("_part"), "path")
    alone = asked.join(lone, F.col("part").eqNullSafe(F.col("_part"))).select("part", "path", *extra)
    found = alone if several is None else several.unionByName(alone)
    known = manifest.parts.select(F.col("part").alias("_part"), F.col("root").alias("subroot"))
    return (
        found.join(known, F.col("part").eqNullSafe(F.col("_part")))
        .drop("_part")
        .withColumns({"root": F.lit(root_of(manifest)).cast("string"), "path": F.reverse("path")})
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 over the siblings on a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """``part, key, leaf, forged``: the digest of each document and, for every third id by
    crc32, the one after its text was put in lower case (else null)."""
    text = F.col("text")

    def digest(body: Column) -> Column:
        return field_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), body])

    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    forged = F.when(third, digest(F.translate(text, _UPPER, _LOWER)))
    return docs.select(
        F.col("lang").alias("part"), F.col("doc_id").alias("key"), digest(text).alias("leaf"), forged.alias("forged")
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The texts are read once; the sort and all later steps have digests only.
    manifest = build(stage(document_leaves(table(spark, sf_dir, "documents")), "merkle-digests"))
    folded = fold(F.coalesce("forged", "leaf"), F.col("path"))
    return (
        proofs(manifest)
        .select(
            F.col("key").alias("doc_id"), "leaf", "subroot", "root",
            proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


# crc32 of the text x by its bits, since DuckDB has none: each byte is followed by seven zeros.
def crc32_sql(x: str) -> str:
    steps = f"flatten(list_transform(string_split({x}, ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0]))"
    turn = "xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))"
    bits = f"list_reduce(list_transform({steps}, lambda v: CAST(v AS BIGINT)), lambda a, b: {turn}, CAST(4294967295 AS BIGINT))"
    return f"xor({bits}, 4294967295)"


_COUNTED = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_SHOWN = " || ".join(_COUNTED.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
_TRANSLATED = f"translate(text, '{_UPPER}', '{_LOWER}')"

SQL = {
    "op13_merkle": f"""WITH RECURSIVE digested AS (
  SELECT doc_id, lang, sha256({_SHOWN.format(text="text")}) AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({_SHOWN.format(text=_TRANSLATED)}) END AS forged
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS width FROM digested),
lower_nodes AS (
  SELECT lang, 0 AS height, place, width, leaf AS digest FROM ranked
  UNION ALL
  SELECT lang, height + 1, place // 8, (any_value(width) + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM lower_nodes WHERE width > 1 GROUP BY lang, height, place // 8),
subroots AS (
  SELECT lang, height AS top, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS part,
    count(*) OVER () AS width FROM lower_nodes WHERE width = 1),
upper_nodes AS (
  SELECT 0 AS height, part AS place, width, subroot AS digest FROM subroots
  UNION ALL
  SELECT height + 1, place // 8, (any_value(width) + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM upper_nodes WHERE width > 1 GROUP BY height, place // 8),
levels AS (
  SELECT r.doc_id, r.leaf, r.lang, r.place AS rank, n.height AS level,
    coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place < r.place // pow(8, n.height)::BIGINT), '') AS l,
    coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place > r.place // pow(8, n.height)::BIGINT), '') AS r
  FROM ranked r JOIN lower_nodes n
    ON r.lang IS NOT DISTINCT FROM n.lang AND n.width > 1 AND n.place // 8 = r.place // pow(8, n.height + 1)::BIGINT
  GROUP BY ALL
  UNION ALL
  SELECT r.doc_id, r.leaf, r.lang, r.place, 1000 + n.height,
    coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place < s.part // pow(8, n.height)::BIGINT), ''),
    coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place > s.part // pow(8, n.height)::BIGINT), '')
  FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang
    JOIN upper_nodes n ON n.width > 1 AND n.place // 8 = s.part // pow(8, n.height + 1)::BIGINT
  GROUP BY r.doc_id, r.leaf, r.lang, r.place, n.height, s.part),
paths AS (
  SELECT lang, rank, string_agg(l || r, '' ORDER BY level) AS proof, list(l || '|' || r ORDER BY level) AS path
  FROM levels GROUP BY lang, rank)
SELECT r.doc_id, r.leaf, s.subroot, top.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  list_reduce(coalesce(path, []), lambda a, b: sha256(split_part(b, '|', 1) || a || split_part(b, '|', 2)),
    coalesce(r.forged, r.leaf)) AS folded_root, folded_root = root AS verified
FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang
  JOIN (SELECT digest FROM upper_nodes WHERE width = 1) top ON true
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM r.lang AND p.rank = r.place"""
}
QUERIES = {"op13_merkle": op13_merkle}
