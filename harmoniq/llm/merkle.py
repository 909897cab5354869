"""Merkle manifest of a dataset: checkpoint-and-recompute.

Leaves are digests of rows.  Within a run (a column's value, such as the
language) they ascend by an order; every ``arity`` consecutive nodes become
their digest (the last ones may be fewer, even one) until one is left, the
run's subroot.  The subroots, ordered by run, make the root in the same way.

Only every ``every``-th level is stored.  A proof needs the levels between as
well: they are regenerated for one aligned subtree of ``arity ** every`` stored
nodes at a time, their siblings are emitted, and the nodes are dropped.  Proofs
go from the top stored level down, each subtree receiving the siblings above it
with one row, so no task holds more than one subtree and one path.

Results: digests are lower-case hex sha256 over the concatenation of the hex
digests; a null in a leaf's columns is '-', any other value its UTF-8 length,
':' and its text, so no two rows are confused.  A null run is a run of its own
and comes first; null order values come first; ties of the order are settled by
the leaf, and repeated rows are leaves of their own with proofs of their own.
An empty table has no leaves, no root and no proofs.  Texts are hashed whole.
Columns that are not named take no part, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmoniq.llm.common import by_group, group_starts, numbered, record_batch, store

# levels between two stored ones: subtrees of 64 nodes at arity 2
EVERY = 6
PATH = "array<array<string>>"


def field_text(value: Column) -> Column:
    """'-' for null, else the UTF-8 length, ':' and the value's text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]).cast("binary"), 256)


def run_key(run: str) -> Column:
    """Sorts bytewise with null first and keeps null apart from every text."""
    return F.coalesce(F.concat(F.lit("1"), F.col(f"`{run}`").cast("string")), F.lit("0"))


def digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def height(n: int, arity: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def parents(nodes: list[str], arity: int) -> list[str]:
    return [digest(nodes[i:i + arity]) for i in range(0, len(nodes), arity)]


def subtree(nodes: list[str], arity: int, levels: int) -> list[list[str]]:
    """The nodes and the ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        out.append(parents(out[-1], arity))
    return out


# ---- building -----------------------------------------------------------------------
@dataclass
class Tree:
    """Stored levels 0, every, 2 * every, ...: (run, pos, total, node), where
    total is the run's number of nodes on that level; level 0 has ``row`` too."""
    levels: list[DataFrame]
    arity: int
    every: int
    tops: DataFrame                      # (run, node): one row per run


def _blocked(nodes: DataFrame, span: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / span).cast("bigint"))


def build(leaves: DataFrame, name: str, arity: int = 2, every: int = EVERY) -> Tree:
    """``leaves``: (run, pos, total, node, row), pos gapless from 0 in each run."""
    span = arity ** every
    names = ["run", "pos", "total", "node"]

    def lift(table: pa.Table) -> Iterator[pa.RecordBatch]:
        run, block, total, node = (table.column(c).to_pylist() for c in ("run", "block", "total", "node"))
        starts = group_starts(table, ["run", "block"])
        rows = []
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            steps = min(every, height(total[a], arity))
            top = subtree(node[a:b], arity, steps)[-1][0]
            rows.append((run[a], block[a], -(-total[a] // arity ** steps), top))
        yield record_batch(names, [pa.array(c, t) for c, t in zip(
            zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)])

    levels, tops = [leaves], []
    while True:
        level = levels[-1]
        tops.append(level.filter("total = 1").select("run", "node"))
        rest = level.filter("total > 1")
        if rest.isEmpty():
            break
        up = by_group(_blocked(rest.select(*names), span), ["run", "block"], ["pos"], lift,
                      "run string, pos bigint, total bigint, node string")
        levels.append(store(up, f"{name}-level"))
    out = tops[0]
    for t in tops[1:]:
        out = out.unionAll(t)
    return Tree(levels, arity, every, out)


# ---- proofs -------------------------------------------------------------------------
def paths(tree: Tree, above: DataFrame, name: str, row_type: str) -> DataFrame:
    """Every leaf's siblings from its own level to the root.  ``above`` gives
    each run's path beyond its top: (run, path, base), base being the index of
    the top among its siblings.  Returns (run, pos, total, row, path, above):
    ``path`` has one list of siblings per level, left to right; the leaf's
    place among them follows from pos and, beyond the run, from ``above``."""
    span = tree.arity ** tree.every
    # the path above each node of the stored level, from the top stored level down
    held: DataFrame | None = None
    for k in range(len(tree.levels) - 1, -1, -1):
        level = tree.levels[k]
        own = level.select("run", "pos", "total", "node",
                           *(["row"] if k == 0 else [F.lit(None).cast(row_type).alias("row")]))
        own = own.withColumn("path", F.lit(None).cast(PATH))
        # a run with one node here gets the path beyond the run, the others that of their subtree's top
        heads = above.join(level.filter("total = 1").select("run"), "run", "left_semi").select(
            "run", F.lit(0).cast("bigint").alias("block"), "path")
        if held is not None:
            heads = heads.unionAll(held.select("run", F.col("pos").alias("block"), "path"))
        heads = heads.select("run", F.lit(-1).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("total"),
                             F.lit(None).cast("string").alias("node"), F.lit(None).cast(row_type).alias("row"),
                             "path", "block")
        both = _blocked(own, span).unionByName(heads)
        out = by_group(both, ["run", "block"], ["pos"], _expand(tree.arity, tree.every, k == 0),
                       f"run string, pos bigint, total bigint, {f'row {row_type}, ' if k == 0 else ''}path {PATH}",
                       rows=4096)
        held = store(out, f"{name}-path") if k else out
    return held


def _expand(arity: int, every: int, leaf: bool):
    """Regenerate the levels of each aligned subtree and emit every node's
    siblings inside it, followed by the path above the subtree."""
    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key, pos, total, node = (table.column(c).to_pylist() for c in ("run", "pos", "total", "node"))
        upper = table.column("path")
        starts = group_starts(table, ["run", "block"])
        kept, found = [], []
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            beyond = upper[int(a)].as_py() or []     # the head row sorts first
            inside = subtree(node[a + 1:b], arity, min(every, height(total[a + 1], arity)))
            # a subtree's top is alone on its level: its siblings come from the path beyond
            runs = [[level[i:i + arity] for i in range(0, len(level), arity)] for level in inside[:-1]]
            for i in range(b - a - 1):
                at, path = i, []
                for level in runs:
                    at, here = divmod(at, arity)
                    path.append(level[at][:here] + level[at][here + 1:])
                found.append(path + beyond)
            kept.append(np.arange(a + 1, b))
        rows = pa.array(np.concatenate(kept))
        take = table.select(["run", "pos", "total", *(["row"] if leaf else [])]).take(rows)
        for at in range(0, len(found), 1024):
            part = take.slice(at, 1024).combine_chunks()
            names = [*part.column_names, "path"]
            cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in part.columns]
            yield record_batch(names, [*cols, pa.array(found[at:at + 1024], pa.list_(pa.list_(pa.string())))])
    return run


def fold(leaf: Column, pos: Column, path: Column, arity: int) -> Column:
    """Digest at the end of a path (a column expression): the node takes its
    place among its siblings, level by level."""
    start = F.struct(leaf.alias("node"), pos.cast("bigint").alias("at"))

    def up(acc: Column, siblings: Column) -> Column:
        here = (acc["at"] % arity).cast("int")
        joined = F.concat(F.array_join(F.slice(siblings, F.lit(1), here), ""), acc["node"],
                          F.array_join(F.slice(siblings, here + 1, F.lit(arity)), ""))
        return F.struct(F.sha2(joined.cast("binary"), 256).alias("node"),
                        F.floor(acc["at"] / arity).cast("bigint").alias("at"))
    return F.aggregate(path, start, up)["node"]


@dataclass
class Manifest:
    """Stored manifest.  ``runs``: (run, node, pos) of each run's subroot;
    ``root`` is None for an empty table."""
    tree: Tree
    over: Tree
    runs: DataFrame
    root: str | None
    row_type: str


def manifest(rows: DataFrame, run: str, order: str, leaf: Column, keep: Sequence[Column | str],
             arity: int = 2, every: int = EVERY) -> Manifest:
    """Build over ``rows``; ``keep`` are the columns that proofs carry."""
    if arity < 2 or every < 1:
        raise ValueError("a tree needs arity of at least 2 and stores at least every level")
    carried = [F.col(c) if isinstance(c, str) else c for c in keep]
    leaves = store(rows.select(run_key(run).alias("run"), F.col(f"`{order}`").alias("key"), leaf.alias("node"),
                               F.struct(*carried).alias("row")), "merkle-leaves")
    row_type = leaves.schema["row"].dataType.simpleString()
    placed = store(numbered(leaves, "merkle-sorted", "run", ["key", "node"], total="total")
                   .select("run", "pos", "total", "node", "row"), "merkle-level")
    tree = build(placed, "merkle", arity, every)
    runs = numbered(tree.tops.withColumn("all", F.lit("")), "merkle-runs", "all", ["run"], total="total")
    tops = store(runs.select(F.col("all").alias("run"), "pos", "total", "node",
                             F.struct(F.col("run").alias("run")).alias("row")), "merkle-subroots")
    over = build(tops, "merkle-over", arity, every)
    top = over.tops.first()
    return Manifest(tree, over, tops.select(F.col("row.run").alias("run"), "node", "pos"),
                    top["node"] if top else None, row_type)


def proofs(m: Manifest) -> DataFrame:
    """One row per leaf: run, the kept columns, pos (in its run), run_pos (the
    run's place), subroot, root, path (siblings within the run, level by
    level) and run_path (siblings from the subroot up)."""
    spark = m.runs.sparkSession
    alone = spark.range(1).select(F.lit("").alias("run"), F.lit(None).cast(PATH).alias("path"))
    run_paths = paths(m.over, alone, "merkle-over", "struct<run:string>").select(
        F.col("row.run").alias("run"), "path")
    of_run = store(run_paths.join(m.runs, "run").select(
        "run", F.col("path").alias("run_path"), F.col("node").alias("subroot"), F.col("pos").alias("run_pos")),
        "merkle-run-paths")
    nothing = of_run.select("run", F.lit(None).cast(PATH).alias("path"))
    own = paths(m.tree, nothing, "merkle", m.row_type)
    # one row per run, never more: its hot keys are split as any join's
    return own.join(of_run, "run").select("run", "row.*", "pos", "run_pos", "subroot",
                                          F.lit(m.root).alias("root"), "path", "run_path")
