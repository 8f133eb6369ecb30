"""Merkle manifest of a dataset, kept as a persistent tree with path copying.

Leaves are digests of whole rows. The leaves of a language, by ascending id, form one tree;
the roots of the languages form the tree above. A tree is cut into aligned blocks of 2^10
nodes: a block is built in one task, its root is a node of the level above, and so on until
one node is left. No task holds more than a block, whatever the size of a language.

Nodes never change. A tampered leaf makes a version of its block: the nodes between the leaf
and the root are copied, all others are shared with the original. The version goes on above
its block with the path of the block's root, which all versions of the block have in common.

Order: languages and ids ascend, nulls first; rows of one id follow their leaves' digests.
Nulls: a null field is ``-``; a row without id is never tampered; a row without ``n_chars``
stays as it is. Empty and very long texts are fields like others. Repeated rows are a leaf
each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import code_on_workers, table
from callgrove.plans.lineage import cut, cut_and_observe
from callgrove.plans.ranking import number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a block; it holds 2^LEVELS nodes at most.
LEVELS = 10
#: Rows whose unsigned crc32 of the decimal id is divisible by this are tampered with.
TAMPER_EVERY = 7

_NODE = "tree string, at long, digest string"
_PLACED = "tree string, at long, proof array<string>, root string"


def digest_of(*digests: str) -> str:
    """Digest of the joined digests."""
    return sha256("".join(digests).encode("ascii")).hexdigest()


def folded(digest: str, proof: Sequence[str]) -> str:
    """Root that a node and its proof lead to.

    A step is ``L`` or ``R``, for a sibling on the left or right, and the sibling's digest;
    the empty step stands for a node without a sibling.
    """
    for step in proof:
        sibling = step[1:]
        if not step:
            digest = digest_of(digest)
        else:
            digest = digest_of(sibling, digest) if step[0] == "L" else digest_of(digest, sibling)
    return digest


class Nodes:
    """Store of nodes that never change. A tree in it is the number of its root."""

    def __init__(self) -> None:
        self.digest: list[str] = []
        self.children: list[tuple[int, ...]] = []

    def add(self, children: tuple[int, ...], digest: str | None = None) -> int:
        if digest is None:
            digest = digest_of(*(self.digest[child] for child in children))
        self.digest.append(digest)
        self.children.append(children)
        return len(self.digest) - 1

    def build(self, leaves: Sequence[str], height: int) -> int:
        level = [self.add((), leaf) for leaf in leaves]
        for _ in range(height):
            level = [self.add(tuple(level[i : i + 2])) for i in range(0, len(level), 2)]
        return level[0]

    def path(self, root: int, height: int, at: int) -> list[int]:
        """Nodes from the root down to leaf ``at``."""
        found = [root]
        for level in range(height - 1, -1, -1):
            found.append(self.children[found[-1]][at >> level & 1])
        return found

    def proof(self, root: int, height: int, at: int) -> list[str]:
        """Steps from leaf ``at`` up to the root."""
        steps = []
        path = self.path(root, height, at)
        for parent, node in zip(path[-2::-1], path[:0:-1], strict=True):
            pair = self.children[parent]
            if len(pair) == 1:
                steps.append("")
            elif pair[0] == node:
                steps.append("R" + self.digest[pair[1]])
            else:
                steps.append("L" + self.digest[pair[0]])
        return steps

    def replaced(self, root: int, height: int, at: int, digest: str) -> int:
        """Root of a version in which leaf ``at`` has another digest: copies of its ancestors."""
        path = self.path(root, height, at)
        copy = self.add((), digest)
        for parent, node in zip(path[-2::-1], path[:0:-1], strict=True):
            copy = self.add(tuple(copy if child == node else child for child in self.children[parent]))
        return copy


def block_height(first: int, size: int, levels: int = LEVELS) -> int:
    """Levels of the block that begins with node ``first``.

    All blocks of a tree are as high as a full one, unless the tree is a single block.
    """
    return levels if first else (size - 1).bit_length()


def _in_order(rows: pa.Table) -> pa.Table:
    return rows.sort_by("at").combine_chunks()


def _tops(rows: pa.Table) -> pa.Table:
    """The root of one block, as a node of the level above."""
    rows = _in_order(rows)
    first = rows["at"][0].as_py()
    nodes = Nodes()
    root = nodes.build(rows["digest"].to_pylist(), block_height(first, len(rows)))
    return pa.table({"tree": [rows["tree"][0]], "at": [first >> LEVELS], "digest": [nodes.digest[root]]})


def _placed(rows: pa.Table, upper: pa.Table) -> pa.Table:
    """Proofs of the nodes of one block: inside the block, then that of its root."""
    rows = _in_order(rows)
    first, size = rows["at"][0].as_py(), len(rows)
    height = block_height(first, size)
    above, top = upper["proof"][0].as_py(), upper["root"][0].as_py()
    nodes = Nodes()
    root = nodes.build(rows["digest"].to_pylist(), height)
    proofs = [nodes.proof(root, height, i) + above for i in range(size)]
    return pa.table(
        {
            "tree": rows["tree"], "at": rows["at"],
            "proof": pa.array(proofs, pa.list_(pa.string())), "root": [top] * size,
        }
    )


def _blocks(nodes: DataFrame):
    return nodes.groupBy("tree", F.shiftright("at", LEVELS).alias("block"))


def _raised(nodes: DataFrame) -> tuple[DataFrame, bool]:
    """Roots of all blocks, and whether every tree is down to one node."""
    tops, seen = cut_and_observe(_blocks(nodes).applyInArrow(_tops, _NODE), more=F.count_if(F.col("at") > 0))
    return tops, not seen.get("more")


def node_proofs(nodes: DataFrame) -> DataFrame:
    """(tree, at, proof, root) of the nodes (tree, at, digest), ``at`` counting from 0 in a tree."""
    levels, done = [nodes], False
    while not done:
        tops, done = _raised(levels[-1])
        levels.append(tops)
    placed = levels.pop().select(
        "tree", "at", F.array().cast("array<string>").alias("proof"), F.col("digest").alias("root")
    )
    for level in reversed(levels):
        placed = _blocks(level).cogroup(placed.groupBy("tree", F.col("at").alias("block"))).applyInArrow(
            _placed, _PLACED
        )
    return placed


def leaf_digest(n_chars: Column | None = None) -> Column:
    """Lowercase hex SHA-256 of a row; ``n_chars`` takes the place of that column."""

    def part(name: str) -> Column:
        text = (n_chars if name == "n_chars" and n_chars is not None else F.col(name)).cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        )

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def is_tampered() -> Column:
    """Rows that the check tampers with; those that lack an id or a length are left alone."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return F.coalesce(chosen, F.lit(False)) & F.col("n_chars").isNotNull()


def _versions(rows: pa.Table, upper: pa.Table) -> pa.Table:
    """Proof of every leaf of a block, and the root that the leaf, or its version, folds to."""
    rows = _in_order(rows)
    first, size = rows["at"][0].as_py(), len(rows)
    height = block_height(first, size)
    above, root, subroot = (upper[c][0].as_py() for c in ("proof", "root", "subroot"))
    nodes = Nodes()
    leaves, tampered = rows["digest"].to_pylist(), rows["tampered"].to_pylist()
    original = nodes.build(leaves, height)
    proofs, ends, copied = [], [], []
    for i in range(size):
        proof = nodes.proof(original, height, i)
        if tampered[i] is None:
            ends.append(folded(folded(leaves[i], proof), above))
            copied.append(0)
        else:
            version = nodes.replaced(original, height, i, tampered[i])
            ends.append(folded(nodes.digest[version], above))
            copied.append(height + len(above))
        proofs.append(proof + above)
    return pa.table(
        {
            "doc_id": rows["doc_id"], "leaf": rows["digest"], "subroot": [subroot] * size, "root": [root] * size,
            "proof": pa.array(proofs, pa.list_(pa.string())), "folded_root": ends,
            "copied_nodes": pa.array(copied, pa.int64()),
        }
    )


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, copied_nodes) of every row of ``docs``.

    ``proof`` has a step for each level, see :func:`folded`. ``folded_root`` is the root of
    the version in which the row is tampered with, or that of the original tree.
    """
    code_on_workers(docs.sparkSession)
    changed = leaf_digest(F.col("n_chars").cast("decimal(38,0)") + 1)
    # "=" keeps the order of names and puts the missing one before them.
    leaves = cut(
        docs.select(
            F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
            "doc_id",
            leaf_digest().alias("digest"),
            F.when(is_tampered(), changed).alias("tampered"),
        )
    )
    order = [F.asc_nulls_first("doc_id"), F.col("digest")]
    numbered = cut(number_rows(leaves, ["tree"], order, "at"))

    # Above the leaves: block roots of the languages, then the tree of the languages' roots.
    blocks, done = _raised(numbered)
    inside = cut(node_proofs(blocks))
    subroots = inside.where("at = 0").select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "root")
    named = cut(number_rows(subroots, ["tree"], [F.col("lang")], "at"))
    tops = node_proofs(named.select("tree", "at", F.col("root").alias("digest")))
    langs = named.join(tops.withColumnRenamed("root", "_top"), ["tree", "at"]).select(
        F.col("lang").alias("tree"), F.col("proof").alias("_above"), "_top"
    )
    upper = inside.join(langs, "tree").select(
        "tree", F.col("at").alias("block"), F.concat("proof", "_above").alias("proof"),
        F.col("root").alias("subroot"), F.col("_top").alias("root"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _blocks(numbered).cogroup(upper.groupBy("tree", "block")).applyInArrow(
        _versions,
        f"doc_id {kind}, leaf string, subroot string, root string, proof array<string>,"
        " folded_root string, copied_nodes long",
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(table(spark, sf_dir, "documents"))
    siblings = F.transform("proof", lambda step: F.substr(step, F.lit(2)))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql_crc32(text: str) -> str:
    """CRC-32 of a short ASCII text in DuckDB: eight shifts for each byte."""
    return f"""xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT),
        lambda state, byte: list_reduce([xor(state, byte)] || range(8),
          lambda s, k: CASE WHEN s % 2 = 1 THEN xor(3988292384, s >> 1) ELSE s >> 1 END)), 4294967295)"""


def _sql_field(name: str) -> str:
    text = f"({name})::VARCHAR"
    return f"CASE WHEN ({name}) IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(n_chars if f == "n_chars" else f) for f in FIELDS) + ")"


OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf("n_chars")} AS digest,
         CASE WHEN {_sql_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_sql_leaf("n_chars + 1")} END AS changed
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), lower_nodes AS (
  SELECT tree, 0 AS level, pos, n, digest FROM numbered
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(digest || coalesce(other, ''))
  FROM (SELECT *, lead(digest) OVER (PARTITION BY tree ORDER BY pos) AS other FROM lower_nodes WHERE n > 1)
  WHERE pos % 2 = 0
), subroots AS (
  SELECT tree AS lang, level AS height, digest AS subroot,
         row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM lower_nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(digest || coalesce(other, ''))
  FROM (SELECT *, lead(digest) OVER (ORDER BY pos) AS other FROM upper_nodes WHERE n > 1)
  WHERE pos % 2 = 0
), all_nodes AS (
  SELECT tree, level, pos, digest FROM lower_nodes WHERE n > 1
  UNION ALL
  SELECT s.lang, s.height + u.level, u.pos, u.digest
  FROM upper_nodes u, subroots s WHERE u.n > 1
), steps AS (
  SELECT d.tree, d.pos AS leaf_at, s.height, s.pos AS top_at, s.subroot, d.doc_id, d.digest AS leaf,
         coalesce(d.changed, d.digest) AS start
  FROM numbered d JOIN subroots s ON d.tree = s.lang
), folds AS (
  SELECT tree, leaf_at, height, top_at, subroot, doc_id, leaf, 0 AS level, start AS digest, '' AS proof FROM steps
  UNION ALL
  SELECT f.tree, f.leaf_at, f.height, f.top_at, f.subroot, f.doc_id, f.leaf, f.level + 1,
         CASE WHEN o.digest IS NULL THEN sha256(f.digest)
              WHEN o.pos % 2 = 0 THEN sha256(o.digest || f.digest) ELSE sha256(f.digest || o.digest) END,
         f.proof || coalesce(o.digest, '')
  FROM folds f
  JOIN all_nodes own ON own.tree = f.tree AND own.level = f.level
    AND own.pos = CASE WHEN f.level < f.height THEN f.leaf_at >> f.level ELSE f.top_at >> (f.level - f.height) END
  LEFT JOIN all_nodes o ON o.tree = f.tree AND o.level = f.level AND o.pos = xor(own.pos, 1)
)
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, f.digest AS folded_root,
       f.digest = r.digest AS verified
FROM folds f, (SELECT level, digest FROM upper_nodes WHERE n = 1) r
WHERE f.level = f.height + r.level
"""
