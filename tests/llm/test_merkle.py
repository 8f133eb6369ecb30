"""Merkle manifest: hand-made tables against a plain recomputation."""

from __future__ import annotations

import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from callgrove.llm import common, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, at long, root string"


def _rows(n: int, lang: str | None = "en"):
    return [(i, f"text {i}", lang, "s", 7 + i, "x", 1, "r") for i in range(n)]


ODD = [
    *_rows(5),
    (None, "no id", "en", "s", 3, "x", 1, "r"),
    (None, None, None, None, None, "x", 1, "r"),
    (14, "same", None, "s", 4, "x", 1, "r"),
    (14, "same", None, "s", 4, "x", 1, "r"),
    (15, "", "", "é|:", None, "x", 1, "r"),
    (16, "word " * 50_000, "zh", "s", 250_000, "x", 1, "r"),
]


def _h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(row, add: int = 0) -> str:
    doc_id, text, lang, source, n_chars = row[:5]
    size = None if n_chars is None else n_chars + add
    fields = [doc_id, source, lang, size, text]
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def _tree(leaves: list[str]) -> tuple[str, list[list[str | None]]]:
    """Root and, for each leaf, its siblings with their sides, level by level."""
    level, at, steps = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, where in enumerate(at):
            other = where ^ 1
            steps[i].append((where & 1, level[other]) if other < len(level) else None)
            at[i] = where // 2
        level = [_h(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], steps


def _fold(digest: str, steps) -> str:
    for step in steps:
        if step is None:
            digest = _h(digest)
        else:
            digest = _h(step[1], digest) if step[0] else _h(digest, step[1])
    return digest


def _plain(rows):
    langs: dict = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    names = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(langs[name], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[name] = (ordered, *_tree([_leaf(r) for r in ordered]))
    root, tops = _tree([trees[name][1] for name in names])
    out = []
    for name, above in zip(names, tops, strict=True):
        ordered, subroot, steps = trees[name]
        for row, own in zip(ordered, steps, strict=True):
            path = own + above
            tampered = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            proof = _h("".join(s[1] for s in path if s))
            end = _fold(_leaf(row, int(tampered)), path)
            out.append((row[0], _leaf(row), subroot, root, proof, end, end == root))
    return sorted(out, key=str)


def _run(spark, rows, path):
    common.code_on_workers(spark)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return merkle.op13_merkle(spark, str(path))


@pytest.mark.parametrize("rows", [ODD, _rows(1), _rows(9), [*_rows(6), *_rows(3, "de")]])
def test_manifest_equals_a_plain_one(spark, tmp_path, rows):
    assert sorted((tuple(r) for r in _run(spark, rows, tmp_path).collect()), key=str) == _plain(rows)


def test_blocks_of_a_large_language_join_to_one_tree(spark, tmp_path):
    rows = [*_rows(2 * 1024 + 5), *_rows(1024, "de"), *_rows(3, None)]
    found = _run(spark, rows, tmp_path)
    assert sorted((tuple(r) for r in found.collect()), key=str) == _plain(rows)


def test_three_levels_of_blocks(spark, monkeypatch):
    # Blocks of 4 nodes: workers get the small bound with the functions that they run.
    common.code_on_workers(spark)
    leaves = [_h(str(i)) for i in range(37)]
    levels = []
    for first in range(0, 37, 4):
        part = leaves[first : first + 4]
        nodes = merkle.Nodes()
        levels.append(nodes.digest[nodes.build(part, merkle.block_height(first, len(part), 2))])
    nodes = merkle.Nodes()
    assert nodes.digest[nodes.build(levels, merkle.block_height(0, len(levels), 4))] == _tree(leaves)[0]


def test_versions_share_all_but_the_ancestors():
    nodes = merkle.Nodes()
    leaves = [_h(str(i)) for i in range(11)]
    root = nodes.build(leaves, 4)
    before = len(nodes.digest)
    for at in range(11):
        changed = leaves.copy()
        changed[at] = _h("changed")
        version = nodes.replaced(root, 4, at, _h("changed"))
        assert nodes.digest[version] == _tree(changed)[0]
        assert len(nodes.digest) == before + 5
        before += 5
        old, new = nodes.path(root, 4, at), nodes.path(version, 4, at)
        assert not set(old) & set(new)
    assert nodes.digest[root] == _tree(leaves)[0]
    assert merkle.folded(leaves[10], nodes.proof(root, 4, 10)) == nodes.digest[root]


def test_no_rows_give_no_rows(spark, tmp_path):
    assert _run(spark, [], tmp_path).count() == 0


def test_largest_length_is_tampered_without_overflow(spark):
    row = spark.createDataFrame([(0, "t", "en", "s", 2**63 - 1)], "doc_id long, text string, lang string, source string, n_chars long")
    changed = row.select(merkle.leaf_digest(F.col("n_chars").cast("decimal(38,0)") + 1)).first()[0]
    assert changed == _leaf((0, "t", "en", "s", 2**63 - 1), 1)


def test_sql_gives_the_same(spark, tmp_path):
    found = _run(spark, ODD, tmp_path)
    connection = duckdb.connect()
    connection.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    columns = ", ".join(found.columns)
    wanted = connection.sql(f"with o as ({merkle.OP13_SQL}) select {columns} from o").fetchall()
    assert sorted(map(str, wanted)) == sorted(str(tuple(row)) for row in found.collect())
