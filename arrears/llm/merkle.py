"""Operator 11, Merkle dataset manifest: levels kept as concatenated hex strings, one per aligned block.

Leaves are ordered inside their group and cut into aligned blocks of
``fanout ** levels`` leaves. A block keeps each of its levels as one hex string
(64 characters a node); the next level is the hashes of that string's
fixed-width substrings, and a node's siblings are the substrings left and right
of its own inside its run. The tops of the blocks are the leaves of the next
round, until a group is one block; the groups' roots go through the same rounds
as one more group. Proofs come back down the rounds the same way: a block hands
the path above it to each of its children.

A position in a group is the row's number in a range-partitioned, written sort
plus the rows of the group before that partition, so no group is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import crc32_sql, documents, ranked
from arrears.session import materialize

FANOUT = 8
LEVELS = 3
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _parents(level: Column, width: int) -> Column:
    """Hashes of the fixed-width substrings of a level, as the next level's string."""
    raw = level.cast("binary")
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / width).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substr(raw, i * width + 1, F.lit(width)), 256)), "")


def _siblings(level: Column, at: Column, fanout: int) -> Column:
    """The substrings of a level before and after node ``at`` inside its run."""
    raw, own = level.cast("binary"), F.pmod(at, F.lit(fanout))
    left = F.substr(raw, ((at - own) * DIGEST + 1).cast("int"), (own * DIGEST).cast("int"))
    right = F.substr(raw, ((at + 1) * DIGEST + 1).cast("int"), ((fanout - 1 - own) * DIGEST).cast("int"))
    return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))


def _path(at: Column, fanout: int, levels: int) -> Column:
    """Siblings of child ``at`` of a block on all of the block's levels, lowest first."""
    steps = [F.when(F.col("height") > k, _siblings(F.col(f"l{k}"), F.floor(at / fanout**k), fanout)) for k in range(levels)]
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _blocks(nodes: DataFrame, extra: tuple, fanout: int, levels: int, name: str) -> DataFrame:
    """Written blocks of ``nodes`` (grp, pos, n, node and ``extra``): grp, block, n, rows, l0.., height, top."""
    size = fanout**levels
    rows = nodes.groupBy("grp", F.floor(F.col("pos") / size).alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "node", *extra))).alias("rows"))
    height = sum((F.col("n") > fanout**k).cast("int") for k in range(levels))  # a whole group in one block ends at its root
    rows = rows.withColumn("height", height).withColumn("l0", F.array_join(F.transform("rows", lambda r: r["node"]), ""))
    for k in range(levels):
        rows = rows.withColumn(f"l{k + 1}", F.when(F.col("height") > k, _parents(F.col(f"l{k}"), fanout * DIGEST)))
    top = F.get(F.array(*[F.col(f"l{k}") for k in range(levels + 1)]), F.col("height"))
    kept = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in ("pos", *extra)])) if extra else F.transform("rows", lambda r: F.struct(r["pos"].alias("pos")))
    rows = rows.withColumn("top", top).withColumn("rows", kept)
    return materialize(rows, name)


def _rounds(nodes: DataFrame, extra: tuple, fanout: int, levels: int, name: str) -> list[DataFrame]:
    """Blocks of every round; those of the last hold one block a group."""
    out = [_blocks(nodes, extra, fanout, levels, name)]
    size = fanout**levels
    while out[-1].filter(F.col("n") > size).limit(1).count():
        up = out[-1].filter(F.col("n") > size).select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("node"))
        out.append(_blocks(up, (), fanout, levels, name))
    return out


def _tops(rounds: list[DataFrame], size: int) -> DataFrame:
    """grp and root of every group: the top of its only block."""
    tops = [b.filter(F.col("n") <= size).select("grp", F.col("top").alias("root")) for b in rounds]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _paths_down(rounds: list[DataFrame], above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Lowest blocks with ``path``, the siblings above the block's top; ``above`` has grp, path of every group's root and columns to hand down."""
    size, path = fanout**levels, None
    down = [c for c in above.columns if c not in ("grp", "path")]
    for k in range(len(rounds) - 1, -1, -1):
        blocks = rounds[k]
        of_roots = blocks.filter(F.col("n") <= size).join(above, "grp")
        if path is not None:
            of_roots = of_roots.unionByName(blocks.filter(F.col("n") > size).join(path, ["grp", "block"]).select(*of_roots.columns))
        if k == 0:
            return of_roots
        children = of_roots.select("grp", *down, F.explode(F.transform("rows", lambda r: F.struct(
            r["pos"].alias("block"), F.concat(_path(F.pmod(r["pos"], F.lit(size)), fanout, levels), F.col("path")).alias("path")))).alias("c"))
        path = materialize(children.select("grp", *down, "c.*"), "merkle-paths")


def merkle_manifest(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Subroot, root and proof of every leaf.

    ``leaves`` needs grp (any text or null; groups are ordered null first, then
    bytewise), id (order inside a group), leaf (64 hex digits) and forged (a
    leaf to fold instead, or null); other columns are ignored. Returns one row
    per input row: grp, id, leaf, forged, subroot, root, proof (left and right
    siblings, level by level through the subroot to the root) and folded_root
    (the root recomputed from forged, else leaf, along the proof).

    Null ids come first in their group; equal ids are ordered by their leaves,
    and rows equal in all share neighbouring places. Empty table: no rows. Only
    digests move, so long texts cost their hashing alone.
    """
    # null first, then bytewise: an empty key for null, a prefix for the rest
    key = F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit(""))
    rows = leaves.select(key.alias("grp"), F.col("id").cast("long").alias("id"), F.col("leaf").alias("node"), "forged")
    rows = materialize(rows, "merkle-hashes")  # the sort reads its input twice: once for the bounds
    size = fanout**levels
    low = _rounds(ranked(rows, ["grp"], ["id", "node"], "merkle-leaves"), ("id", "forged"), fanout, levels, "merkle-blocks")
    subroots = materialize(_tops(low, size), "merkle-subroots")
    tops = ranked(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("node")), ["grp"], ["name"], "merkle-groups")
    high = _rounds(tops, ("name",), fanout, levels, "merkle-tree")
    root = _tops(high, size).first()
    whole = _tops(high, size).select("grp", F.array().cast(_PATH).alias("path"))
    named = _paths_down(high, whole, fanout, levels).select(F.explode(F.transform("rows", lambda r: F.struct(
        r["name"].alias("grp"), F.concat(_path(F.pmod(r["pos"], F.lit(size)), fanout, levels), F.col("path")).alias("path")))).alias("c")).select("c.*")
    above = named.join(subroots.withColumnRenamed("root", "subroot"), "grp")
    blocks = _paths_down(low, materialize(above, "merkle-above"), fanout, levels)
    its = F.transform("rows", lambda r: F.struct(
        r["id"].alias("id"), F.substr(F.col("l0").cast("binary"), (F.pmod(r["pos"], F.lit(size)) * DIGEST + 1).cast("int"), F.lit(DIGEST)).cast("string").alias("leaf"),
        r["forged"].alias("forged"), F.concat(_path(F.pmod(r["pos"], F.lit(size)), fanout, levels), F.col("path")).alias("proof")))
    out = blocks.select("grp", "subroot", F.explode(its).alias("r")).select("grp", "subroot", F.lit(root and root["root"]).alias("root"), "r.*")
    folded = F.aggregate("proof", F.coalesce("forged", "leaf"), lambda node, s: digest(s["left"], node, s["right"]))
    return out.select(F.expr("IF(grp = '', NULL, substr(grp, 2))").alias("grp"), "id", "leaf", "forged", "subroot", "root", "proof", folded.alias("folded_root"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents, grouped by lang; where 3 divides the id's crc32 the forged leaf has its text's A-Z lower-cased."""
    upper = "".join(map(chr, range(65, 91)))
    told = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    head = [field(F.col(c)) for c in FIELDS[:-1]]
    return docs.select(F.col("lang").alias("grp"), F.col("doc_id").alias("id"), digest(*head, field(F.col("text"))).alias("leaf"),
                       F.when(told, digest(*head, field(F.translate("text", upper, upper.lower())))).alias("forged"))


def op11_merkle(spark, sf_dir: str) -> DataFrame:
    out = merkle_manifest(document_leaves(documents(spark, sf_dir)))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    """Leaf of a row whose text reads as ``text``."""
    values = [f"CAST({c} AS VARCHAR)" if c != "text" else text for c in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_UPPER = "".join(map(chr, range(65, 91)))
OP11_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, leaf, if({crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0, forged, leaf) AS folded,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_leaf_sql("text")} AS leaf, {_leaf_sql(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} AS forged FROM documents)),
lv AS (SELECT 0 AS lvl, lang, pos AS idx, leaf AS node, n FROM d
  UNION ALL SELECT lvl + 1, lang, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (max(n) + 7) // 8 FROM lv WHERE n > 1 GROUP BY lvl, lang, idx // 8),
sub AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1),
tl AS (SELECT 0 AS lvl, pos AS idx, subroot AS node, n FROM sub
  UNION ALL SELECT lvl + 1, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (max(n) + 7) // 8 FROM tl WHERE n > 1 GROUP BY lvl, idx // 8),
steps AS (SELECT lang, pos, row_number() OVER (PARTITION BY lang, pos ORDER BY place) AS k, l, r FROM (
  SELECT d.lang, d.pos, lvl AS place, coalesce(string_agg(node, '' ORDER BY idx) FILTER (idx < d.pos >> (3 * lvl)), '') AS l,
    coalesce(string_agg(node, '' ORDER BY idx) FILTER (idx > d.pos >> (3 * lvl)), '') AS r
  FROM d JOIN lv ON lv.lang IS NOT DISTINCT FROM d.lang AND lv.n > 1 AND idx >> 3 = d.pos >> (3 * lvl + 3) GROUP BY d.lang, d.pos, lvl
  UNION ALL SELECT d.lang, d.pos, 100 + lvl, coalesce(string_agg(node, '' ORDER BY idx) FILTER (idx < sub.pos >> (3 * lvl)), ''),
    coalesce(string_agg(node, '' ORDER BY idx) FILTER (idx > sub.pos >> (3 * lvl)), '')
  FROM d JOIN sub ON sub.lang IS NOT DISTINCT FROM d.lang JOIN tl ON tl.n > 1 AND idx >> 3 = sub.pos >> (3 * lvl + 3) GROUP BY d.lang, d.pos, lvl)),
fold AS (SELECT lang, pos, 0 AS k, folded AS node FROM d
  UNION ALL SELECT f.lang, f.pos, s.k, sha256(s.l || f.node || s.r) FROM fold f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.k = f.k + 1),
proofs AS (SELECT lang, pos, max(k) AS depth, sha256(string_agg(l || r, '' ORDER BY k)) AS proof_sha256 FROM steps GROUP BY lang, pos)
SELECT d.doc_id, d.leaf, sub.subroot, (SELECT node FROM tl WHERE n = 1) AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
  f.node AS folded_root, f.node = (SELECT node FROM tl WHERE n = 1) AS verified
FROM d JOIN sub ON sub.lang IS NOT DISTINCT FROM d.lang LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM d.lang AND p.pos = d.pos
JOIN fold f ON f.lang IS NOT DISTINCT FROM d.lang AND f.pos = d.pos AND f.k = coalesce(p.depth, 0)
"""
