"""Entropy trees and forests grown from class counts.

Values are placed once among cut points, a byte each. A job then brings, for every node
that waits in any tree, the class counts of its rows by (tree, node, column, cell); running sums over
the cells give the gain of every split, and one row a node reaches the driver. Nodes
are taken in the order of their gain, up to a limit of leaves if there is one; the children of all nodes
that may still be taken are looked at in the same job, so there are about as many jobs as
the tree is deep, and no limit on that depth. What bounds a tree without a limit of leaves is the least share of the rows a leaf holds.

A tree of a forest sees each row as often as a Poisson draw from the key and the tree says, so the rows
a tree did not see are known without being stored: the out-of-bag score counts them again. Trees have numbers, and
their draws depend on nothing else; a saved forest grows by further numbers.

Missing values go with the greatest. Equal gains go to the first column and the smallest cut.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepline.operators.cells import quantile_cuts
from prepline.operators.net import uniforms
from prepline.session import held

MOST_BINS = 256
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
_ROWS = 1_000_000  # counted together in a task


def multiplicities(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree sees each row."""
    return np.searchsorted(_POISSON, uniforms(keys, seed, tree), side="right")


@dataclass
class Node:
    path: str  # l and r from the root
    counts: tuple[int, int]
    column: int = -1
    cell: int = -1  # rows up to this cell go left
    gain: float = 0.0
    children: tuple[int, int] | None = None
    known: bool = False  # whether its best split has been looked for

    def splits(self) -> bool:
        return self.column >= 0


@dataclass(frozen=True)
class Tree:
    """Nodes in the order they were made: column (-1 for a leaf), cut, gain, children, rows of each class."""

    number: int
    columns: tuple[int, ...]
    cells: tuple[int, ...]
    gains: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    counts: tuple[tuple[int, int], ...]

    def leaves(self) -> int:
        return sum(c < 0 for c in self.columns)

    def leaf_of(self, cells: np.ndarray) -> np.ndarray:
        return descend(np.array(self.columns), np.array(self.cells), np.array(self.left), np.array(self.right), cells)


def descend(columns: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The node without children that each row ends in."""
    at, flat, width = np.zeros(len(cells), np.int64), cells.ravel(), cells.shape[1]
    inside = columns >= 0
    rows = np.arange(len(cells)) if len(inside) and inside[0] else np.zeros(0, np.int64)
    while len(rows):
        node = at.take(rows)
        goes_left = flat.take(rows * width + columns.take(node)) <= cut.take(node)
        node = np.where(goes_left, left.take(node), right.take(node))
        at[rows] = node
        rows = rows[inside.take(node)]
    return at


@dataclass(frozen=True)
class Forest:
    names: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    trees: tuple[Tree, ...]
    weights: tuple[float, float] = (1.0, 1.0)  # of the classes
    bootstrap: bool = True
    seed: int = 12345

    def importance(self) -> tuple[tuple[str, float], ...]:
        """Gain of each column, normalised in each tree and then over all."""
        total = np.zeros(len(self.names))
        for tree in self.trees:
            gains = np.zeros(len(self.names))
            for column, gain in zip(tree.columns, tree.gains):
                if column >= 0:
                    gains[column] += gain
            total += gains / gains.sum() if gains.sum() > 0 else 0.0
        total = total / total.sum() if total.sum() > 0 else total
        return tuple(zip(self.names, total.tolist()))

    def chances(self, cells: np.ndarray, keys: np.ndarray | None = None) -> np.ndarray:
        """Mean chance of class 1 over the trees; with keys, over those that did not see a row, else nan."""
        total, seen = np.zeros(len(cells)), np.zeros(len(cells))
        for tree in self.trees:
            n = np.array(tree.counts) * np.array(self.weights)
            p = (n[:, 1] / np.maximum(n.sum(axis=1), 1e-300))[tree.leaf_of(cells)]
            use = np.ones(len(cells)) if keys is None else multiplicities(keys, tree.number, self.seed) == 0
            total, seen = total + np.where(use, p, 0.0), seen + use
        return np.where(seen > 0, total / np.maximum(seen, 1), np.nan)

    def to_json(self) -> str:
        return json.dumps({"names": self.names, "cuts": self.cuts, "weights": self.weights, "bootstrap": self.bootstrap, "seed": self.seed,
                           "trees": [list(vars(t).values()) for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Forest:
        s = json.loads(text)
        trees = tuple(Tree(n, *[tuple(v) for v in values], tuple(tuple(c) for c in counts)) for n, *values, counts in s["trees"])
        return cls(tuple(s["names"]), tuple(map(tuple, s["cuts"])), trees, tuple(s["weights"]), s["bootstrap"], s["seed"])


def _binary(cells: np.ndarray) -> pa.Array:
    """The cells of each row as one value, without a Python object a row."""
    n, width = cells.shape
    ends = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(cells))])


def _cells(column: pa.Array, width: int) -> np.ndarray:
    """The cells of each row, a row each, as ``_binary`` packed them."""
    ends = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    low, high = ends[column.offset], ends[column.offset + len(column)]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[low:high].reshape(len(column), width)


def placed(df: DataFrame, names: Sequence[str], cuts: Sequence[Sequence[float]], label: str, key: str, keep_key: bool = False) -> DataFrame:
    """``h, y, cells``: hash of the key, class, and the cell of each column in a byte; and the key itself where it is wanted."""
    edges, more = [np.array(c) for c in cuts], ["__key"] if keep_key else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.searchsorted(e, batch.column(2 + i).to_numpy(zero_copy_only=False).astype(float)) for i, e in enumerate(edges)]
            cells = np.stack(columns, axis=1).astype(np.uint8) if columns else np.zeros((batch.num_rows, 0), np.uint8)
            kept = [batch.column(c) for c in more]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _binary(cells), *kept], ["h", "y", "cells", *more])

    rows = df.filter(F.col(label).isNotNull()).select(
        F.xxhash64(F.col(key)).alias("h"), (F.col(label) == 1).cast("int").alias("y"), *[F.col(f"`{n}`").cast("double").alias(f"c{i}") for i, n in enumerate(names)],
        *([F.col(key).alias("__key")] if keep_key else []))
    return rows.mapInArrow(run, "h bigint, y int, cells binary" + (f", __key {df.schema[key].dataType.simpleString()}" if keep_key else ""))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes, classes and cells, many batches at once."""
    held_, n = [], 0

    def out():
        table = pa.Table.from_batches(held_)
        cells = np.concatenate([_cells(part, width) for part in table.column("cells").chunks])
        return table.column("h").to_numpy().view(np.uint64), table.column("y").to_numpy(), cells

    for batch in batches:
        if batch.num_rows:
            held_.append(batch)
            n += batch.num_rows
        if n >= _ROWS:
            yield out()
            held_, n = [], 0
    if n:
        yield out()


def _entropy_terms(a: Column, b: Column) -> Column:
    """Entropy of two class weights times their sum, in bits."""
    term = lambda x: F.when(x > 0, x * F.ln(x)).otherwise(0.0)
    return (term(a + b) - term(a) - term(b)) / F.lit(math.log(2))


@dataclass
class Growing:
    """A tree while it grows; some of its nodes are only looked at in advance."""

    number: int
    most_leaves: int | None
    least: int
    most_deep: int | None = None
    nodes: list[Node] = field(default_factory=list)
    taken: set[int] = field(default_factory=set)
    frontier: list[tuple[float, int, str, int]] = field(default_factory=list)

    def add(self, path: str, counts: tuple[int, int]) -> int:
        known = min(counts) == 0 or sum(counts) < 2 * self.least or len(path) == self.most_deep  # nothing to look for
        self.nodes.append(Node(path, counts, known=known))
        return len(self.nodes) - 1

    def leaves(self) -> int:
        return len(self.taken) + 1

    def offer(self, at: int) -> None:
        if self.nodes[at].splits():
            heapq.heappush(self.frontier, self.turn(at))

    def turn(self, at: int) -> tuple[float, int, str, int]:
        """The greatest gain first; of equal ones the node nearest to the root, then the leftmost."""
        node = self.nodes[at]
        return -node.gain, len(node.path), node.path, at

    def room(self) -> float:
        return math.inf if self.most_leaves is None else self.most_leaves - self.leaves()

    def advance(self, lows: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
        """Take nodes while all that matters is known; then the nodes to be looked at next."""
        while True:
            while self.frontier and self.room() > 0:
                at = self.frontier[0][-1]
                children = self.nodes[at].children
                if children is None or not all(self.nodes[c].known for c in children):
                    break
                heapq.heappop(self.frontier)
                self.taken.add(at)
                for c in children:
                    self.offer(c)
            if not self.frontier or self.room() <= 0:
                return []
            if open_ := self.ahead(lows):
                return open_

    def ahead(self, lows: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
        """Unknown children of all nodes that may still be taken.

        They are the first that would be taken if unknown nodes did not split: those that do can only put others off.
        """
        waiting, room, open_ = list(self.frontier), self.room(), []
        while waiting and room > 0:
            at = heapq.heappop(waiting)[-1]
            room -= 1
            node = self.nodes[at]
            if node.children is None:
                low = lows[self.number, at]
                node.children = self.add(node.path + "l", low), self.add(node.path + "r", tuple(n - m for n, m in zip(node.counts, low)))
            for c in node.children:
                if not self.nodes[c].known:
                    open_.append(c)
                elif self.nodes[c].splits():
                    heapq.heappush(waiting, self.turn(c))
        return open_

    def arrays(self) -> tuple[np.ndarray, ...]:
        inner = [n.children is not None for n in self.nodes]
        return (np.array([n.column if i else -1 for n, i in zip(self.nodes, inner)]), np.array([n.cell for n in self.nodes]),
                np.array([n.children[0] if i else -1 for n, i in zip(self.nodes, inner)]), np.array([n.children[1] if i else -1 for n, i in zip(self.nodes, inner)]))

    def finished(self) -> Tree:
        """Only nodes that were taken split."""
        number, order = {0: 0}, [0]
        for at in order:
            if at in self.taken:
                for c in self.nodes[at].children:
                    number[c] = len(order)
                    order.append(c)
        each = [self.nodes[at] for at in order]
        inner = [at in self.taken for at in order]
        pick = lambda values, other: tuple(v if i else other for v, i in zip(values, inner))
        return Tree(self.number, pick([n.column for n in each], -1), pick([n.cell for n in each], -1), pick([n.gain for n in each], 0.0),
                    tuple(number[n.children[0]] if i else -1 for n, i in zip(each, inner)), tuple(number[n.children[1]] if i else -1 for n, i in zip(each, inner)),
                    tuple(n.counts for n in each))


def drawn_columns(width: int, some: int, seed: int, tree: int, path: str) -> list[int]:
    """The columns a node may split by."""
    if some >= width:
        return list(range(width))
    digest = hashlib.sha256(f"{seed}|{tree}|{path}".encode()).digest()
    return sorted(np.random.default_rng(list(digest[:16])).permutation(width)[:some].tolist())


def _by_code(codes: np.ndarray, often: np.ndarray, hits: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """The codes below ``size`` that occur, from small to large, and for each the sums of the two counts."""
    where, code = codes, None
    if size > len(codes):  # few rows for that many codes
        code, where = np.unique(codes, return_inverse=True)
        size = len(code)
    n, n1 = (np.bincount(where, v, size).astype(np.int64) for v in (often, hits))
    if code is None:
        code = np.flatnonzero(n)
        n, n1 = n[code], n1[code]
    return code, n, n1


def best_splits(rows: DataFrame, trees: dict[int, Growing], wanted: dict[int, list[int]], width: int, some: int, weights: tuple[float, float],
                least: int, bootstrap: bool, seed: int) -> dict[tuple[int, int], tuple[int, int, float, tuple[int, int]]]:
    """For each wanted node the column, cell and gain of its best split, and the rows of each class that go left."""
    todo = {t: (trees[t].arrays(), np.array(nodes), [drawn_columns(width, some, seed, t, trees[t].nodes[n].path) for n in nodes])
            for t, nodes in wanted.items()}
    sent = rows.sparkSession.sparkContext.broadcast(todo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, y, cells in _blocks(batches, width):
            for t, (arrays, nodes, columns) in sent.value.items():
                often = multiplicities(h, t, seed) if bootstrap else np.ones(len(h), np.int64)
                drawn = np.flatnonzero(often)
                place = np.full(max(len(arrays[0]), 1), -1)
                place[nodes] = np.arange(len(nodes))
                slot = place[descend(*arrays, cells[drawn])]
                inside = slot >= 0
                slot, drawn = slot[inside], drawn[inside]
                often, hits, own_cells = often[drawn], often[drawn] * y[drawn], cells[drawn]
                allowed = np.zeros((width, len(nodes)), bool)
                for i, c in enumerate(columns):
                    allowed[c, i] = True
                for c in range(width):
                    own = np.flatnonzero(allowed[c].take(slot))
                    if not len(own):
                        continue
                    code, n, n1 = _by_code(slot[own] * MOST_BINS + own_cells[own, c], often[own], hits[own], len(nodes) * MOST_BINS)
                    n0 = n - n1
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (
                        np.full(len(code), t), nodes[code // MOST_BINS], np.full(len(code), c), code % MOST_BINS, n0, n1)], ["t", "node", "c", "cell", "n0", "n1"])

    # a task's counts are combined already; one shuffle by node and column serves the sums and the running sums
    parts = rows.mapInArrow(run, "t bigint, node bigint, c bigint, cell bigint, n0 bigint, n1 bigint").repartition("t", "node", "c")
    found = parts.groupBy("t", "node", "c", "cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    group = Window.partitionBy("t", "node", "c")
    upto = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    sums = found.select("t", "node", "c", "cell", *[F.sum(n).over(upto).alias(f"l{n}") for n in ("n0", "n1")], *[F.sum(n).over(group).alias(f"a{n}") for n in ("n0", "n1")])
    w = {"n0": F.lit(weights[0]), "n1": F.lit(weights[1])}
    side = lambda f: _entropy_terms(*[f(n) * w[n] for n in ("n0", "n1")])
    gain = side(lambda n: F.col(f"a{n}")) - side(lambda n: F.col(f"l{n}")) - side(lambda n: F.col(f"a{n}") - F.col(f"l{n}"))
    low = F.col("ln0") + F.col("ln1")
    fits = (low >= least) & (F.col("an0") + F.col("an1") - low >= least)
    splits = sums.filter(fits).withColumn("gain", gain).filter(F.col("gain") > 1e-9)
    best = splits.groupBy("t", "node").agg(F.max(F.struct("gain", (-F.col("c")).alias("c"), (-F.col("cell")).alias("cell"), "ln0", "ln1")).alias("s"))
    out = {(r["t"], r["node"]): (-r["s"]["c"], -r["s"]["cell"], r["s"]["gain"], (r["s"]["ln0"], r["s"]["ln1"]))
           for r in best.collect()}  # one row a node
    sent.unpersist()
    return out


def class_weights(counts: tuple[int, int], weight: str | dict | None) -> tuple[float, float]:
    """'balanced' makes both classes weigh the same; a dict names the weight of 0 and 1."""
    if weight is None:
        return 1.0, 1.0
    if weight == "balanced":
        return tuple(sum(counts) / (2.0 * max(n, 1)) for n in counts)
    if isinstance(weight, dict):
        return float(weight.get(0, 1.0)), float(weight.get(1, 1.0))
    raise ValueError(f"unknown class weight {weight!r}")


def cut_points(df: DataFrame, names: Sequence[str], bins: int = MOST_BINS) -> list[list[float]]:
    """Values that rows are split at: at most ``bins`` - 1 a column, the greatest value never."""
    found = quantile_cuts(df.select(*[F.col(f"`{n}`").cast("double").alias(f"c{i}") for i, n in enumerate(names)]), [f"c{i}" for i in range(len(names))], bins)
    return [sorted(set(cuts)) for cuts in found]


def grow(df: DataFrame, names: Sequence[str], label: str, key: str, trees: int = 1, bootstrap: bool = False, columns: int | None = None,
         most_leaves: int | None = None, max_depth: int | None = None, least_share: float = 0.0, least_rows: int = 1, class_weight: str | dict | None = None,
         bins: int = MOST_BINS, seed: int = 12345, start: Forest | None = None) -> Forest:
    """Grow trees side by side; ``start`` is a forest that further trees are added to, with its cuts, classes' weights and draws.

    A leaf holds at least ``least_rows`` rows and the share ``least_share`` of all. ``columns`` is
    the number a node draws; None lets it choose among all.
    """
    names = list(start.names if start else names)
    if most_leaves is not None and most_leaves < 2:
        raise ValueError("a tree that splits has at least two leaves")
    cuts = [list(c) for c in start.cuts] if start else cut_points(df, names, min(bins, MOST_BINS))
    seed, bootstrap = (start.seed, start.bootstrap) if start else (seed, bootstrap)
    first = 1 + max((t.number for t in start.trees), default=-1) if start else 0
    numbers = range(first, first + trees)
    with held(placed(df, names, cuts, label, key)) as rows:
        totals = _class_counts(rows, numbers, bootstrap, seed, len(names))
        every = totals.pop(None)
        weights = start.weights if start else class_weights(every, class_weight)
        least = max(1, least_rows, math.ceil(least_share * sum(every)))
        growing = {t: Growing(t, most_leaves, least, max_depth) for t in numbers}
        wanted = {}
        for t, tree in growing.items():
            root = tree.add("", totals[t])
            if not tree.nodes[root].known:
                wanted[t] = [root]
        lows: dict = {}
        while wanted:
            found = best_splits(rows, growing, wanted, len(names), columns or len(names), weights, least, bootstrap, seed)
            for t, nodes in wanted.items():
                for at in nodes:
                    node = growing[t].nodes[at]
                    node.known = True
                    if (t, at) in found:
                        node.column, node.cell, node.gain, lows[t, at] = found[t, at]
                if nodes == [0]:
                    growing[t].offer(0)
            wanted = {t: nodes for t in wanted if (nodes := growing[t].advance(lows))}
    grown = tuple(tree.finished() for tree in growing.values())
    return Forest(tuple(names), tuple(map(tuple, cuts)), (start.trees if start else ()) + grown, tuple(weights), bootstrap, seed)


def _class_counts(rows: DataFrame, numbers: Sequence[int], bootstrap: bool, seed: int, width: int) -> dict:
    """Rows of each class as each tree sees them, and (None) as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, y, _ in _blocks(batches, width):
            seen = {-1: np.ones(len(h), np.int64)} | {t: multiplicities(h, t, seed) if bootstrap else np.ones(len(h), np.int64) for t in numbers}
            n1 = np.array([int((m * y).sum()) for m in seen.values()])
            n = np.array([int(m.sum()) for m in seen.values()])
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.array(list(seen)), n - n1, n1)], ["t", "n0", "n1"])

    found = rows.mapInArrow(run, "t bigint, n0 bigint, n1 bigint").groupBy("t").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()
    out = {None if r["t"] < 0 else r["t"]: (r["n0"], r["n1"]) for r in found}
    return {t: out.get(t, (0, 0)) for t in (None, *numbers)}


def with_chances(df: DataFrame, forest: Forest, label: str, key: str, keep: Sequence[str] = (), out_of_bag: bool = False) -> DataFrame:
    """``h, y`` and ``p1`` of every labelled row; out of bag, only from trees that did not see the row (null if all did)."""
    sent = df.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, y, cells in _blocks(batches, len(forest.names)):
            p = sent.value.chances(cells, h if out_of_bag else None)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(y, pa.int32()), pa.array(p, from_pandas=True)], ["h", "y", "p1"])

    return placed(df, forest.names, forest.cuts, label, key).mapInArrow(run, "h bigint, y int, p1 double")


def leaf_rows(df: DataFrame, forest: Forest, label: str, key: str) -> DataFrame:
    """``__key, y``, and for each tree its number ``t``, the ``leaf`` a labelled row ends in, and how ``often`` the tree saw the row."""
    sent = df.sparkSession.sparkContext.broadcast(forest)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = _cells(batch.column("cells"), len(sent.value.names))
            h = batch.column("h").to_numpy().view(np.uint64)
            for tree in sent.value.trees:
                often = multiplicities(h, tree.number, sent.value.seed) if sent.value.bootstrap else np.ones(len(h), np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("__key"), batch.column("y"), pa.array(np.full(len(h), tree.number)), pa.array(tree.leaf_of(cells)),
                                                  pa.array(often)], ["__key", "y", "t", "leaf", "often"])

    rows = placed(df, forest.names, forest.cuts, label, key, keep_key=True)
    return rows.mapInArrow(run, f"__key {kind}, y int, t bigint, leaf bigint, often bigint")


def out_of_bag_score(df: DataFrame, forest: Forest, label: str, key: str) -> DataFrame:
    """One row: rows that some tree did not see, how many of them the other trees get right, and the share."""
    if not forest.bootstrap:
        raise ValueError("every tree has seen every row")
    rows = with_chances(df, forest, label, key, out_of_bag=True).filter(F.col("p1").isNotNull())
    right = F.count_if((F.col("p1") > 0.5).cast("int") == F.col("y"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), right.alias("n_right")).withColumn("score", F.col("n_right") / F.nullif("n_rows", F.lit(0)))
