"""Hard negatives by inner product, found exactly with cover trees.

One more component gives all candidates the same norm, so that an inner product
with an anchor depends on the angle between the two alone.  A cover tree then
bounds it: every node has a centre and a covering radius (an angle), and what it
covers scores between the centre's angle less and plus that radius.

The tree's top is shared: pivots, chosen far from each other out of a bounded
sample, take every row into the cell of the nearest one, whose covering radius,
size and range of labels Spark aggregates.  A cell is cut into slices of bounded
size, and a task builds each slice's own tree, level by level, down to leaves
of a few rows; the slices are written once.  An anchor goes to the slices of
cells that can hold what it looks for.  There it descends level by level past
nodes outside its windows, and visits the leaves left, best bound first, until no
bound reaches what it has; scores in leaves are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymetrics.llm.staging import stage

#: fixed values of the contract
ANCHORS, RELABEL, LABELS, POSITIVES, NEGATIVES = 50, 7, 10, 5, 3
#: components are 1 / 256 steps
STEPS = 256

#: a slice has at most this many rows and about this many bytes
SLICE_ROWS, SLICE_BYTES = 1 << 16, 32 << 20
#: cells there are at least, and the bytes of the pivots, which are broadcast
LEAST_CELLS, PIVOT_BYTES = 32, 4 << 20
#: rows of the sample for each pivot
SAMPLE = 4
#: children of a node, rows of a leaf
FAN, LEAF = 8, 32
#: anchors compared with the nodes of a level at once
ROUND = 512
#: leaves of an anchor visited before what was found raises its bound
WAVE = 4
#: how many of the best scores of its own slice are kept in full detail for an anchor; its windows get a lower bound from them
MARKS = 256
#: rounding of angles and products
SLACK, RELATIVE = 2e-7, 1e-9
#: beyond every score
LARGE = 1 << 62

NODE = [("centre", "<i4"), ("begin", "<i4"), ("end", "<i4"), ("child", "<i4"), ("children", "<i4"), ("radius", "<f8"), ("low", "<i8"), ("high", "<i8")]


@dataclass(frozen=True)
class Space:
    """Components of a vector, and the largest norm."""

    width: int
    top: float

    @property
    def stored(self) -> str:
        return "<i4" if self.top < 1 << 31 else "<i8"

    @property
    def exact(self) -> type:
        """In which products of whole numbers are exact: floats while no product passes 2^53."""
        return np.float64 if self.top * self.top < 1 << 53 else np.int64

    def matrix(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        return np.frombuffer(b"".join(x.as_py() for x in column), self.stored).reshape(-1, max(1, self.width)).astype(self.exact)

    def unit(self, x: np.ndarray) -> np.ndarray:
        """Candidates as unit vectors, with one component more."""
        x = x.astype(np.float64) / self.top
        return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))[:, None]])

    def queries(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors as unit vectors whose further component is 0, and their norm times the largest."""
        x = x.astype(np.float64)
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        return np.hstack([x / np.maximum(norm, 1e-300)[:, None], np.zeros((len(x), 1))]), norm * self.top


def bounds(queries: np.ndarray, scale: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the scores of what each centre covers."""
    angle = np.arccos(np.clip(queries @ centres.T, -1.0, 1.0))
    scale = scale[:, None]
    low = scale * np.cos(np.minimum(np.pi, angle + radius + SLACK)) - scale * RELATIVE
    return low, scale * np.cos(np.maximum(0.0, angle - radius - SLACK)) + scale * RELATIVE


def apart(unit: np.ndarray, most: int, first: int = 0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Rows far from each other, each the one farthest from those before; for all rows the nearest of them and its cosine."""
    chosen, near, own = [first], unit @ unit[first], np.zeros(len(unit), np.int32)
    while len(chosen) < most:
        far = int(near.argmin())
        if near[far] > 1 - 1e-12:
            break
        cosine = unit @ unit[far]
        cosine[far] = 2.0  # itself, whatever the rounding
        own[cosine > near] = len(chosen)
        near = np.maximum(near, cosine)
        near[far] = 1.0
        chosen.append(far)
    return chosen, own, near


def cover(unit: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows, nodes by level) of a cover tree; a node covers a run of the ordered rows."""
    order = np.arange(len(unit))
    nodes: list[tuple] = []
    waiting = [(0, len(unit), 0)]
    while waiting:
        level, waiting = waiting, []
        child = len(nodes) + len(level)
        for begin, end, centre in level:
            rows = order[begin:end].copy()
            radius = float(np.arccos(np.clip((unit[rows] @ unit[centre]).min(), -1.0, 1.0)))
            parts = []
            if end - begin > LEAF:
                chosen, own, _ = apart(unit[rows], FAN, int(np.flatnonzero(rows == centre)[0]))
                if len(chosen) > 1:
                    order[begin:end] = rows[np.argsort(own, kind="stable")]
                    cut = begin + np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(chosen)))])
                    parts = [(int(a), int(b), int(rows[c])) for a, b, c in zip(cut[:-1], cut[1:], chosen, strict=True)]
            at = labels[rows]
            nodes.append((centre, begin, end, child, len(parts), radius, at.min(), at.max()))
            child += len(parts)
            waiting += parts
    out = np.array(nodes, NODE)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    out["centre"] = place[out["centre"]]
    return order, out


@dataclass
class Tree:
    """A slice: its rows in the order of its nodes."""

    space: Space
    vectors: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    nodes: np.ndarray

    def best(self, q: np.ndarray, label: np.ndarray, own: np.ndarray, sought: np.ndarray, most: int, same: bool) -> tuple[np.ndarray, ...]:
        """(anchor, window, scores, ids) of the ``most`` best rows of its label, or of others, for every window sought.

        ``sought`` has rows (anchor, window, low, high, floor) in the order of the anchors; rows that
        score under a floor may be missing: so many better ones are known.
        """
        unit = self.space.unit(self.vectors[self.nodes["centre"]])
        out = []
        for a in range(0, len(q), ROUND):
            n = min(ROUND, len(q) - a)
            mine = sought[slice(*np.searchsorted(sought[:, 0], [a, a + n]))] - [a, 0, 0, 0, 0]
            if len(mine):
                found = self._round(unit, q[a:a + n], label[a:a + n], own[a:a + n], mine, most, same)
                out.append((mine[found[0], 0] + a, mine[found[0], 1], *found[1:]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.zeros((4, 0), np.int64))

    def _round(self, unit, q, label, own, sought, most, same) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``sought``, score, id): leaves are visited best bound first, in waves over all anchors of the round."""
        of, high = sought[:, 0], sought[:, 3]
        enough = np.maximum(sought[:, 2], sought[:, 4])
        top = np.full(len(q), -LARGE)
        np.maximum.at(top, of, high)

        def needed() -> np.ndarray:
            need = np.full(len(q), LARGE)
            np.minimum.at(need, of, enough)
            return need

        need = needed()
        leaves, upper = self._leaves(unit, q, label, need, top, same)
        order = np.argsort(-upper, axis=1, kind="stable")
        window = scores = ids = np.zeros(0, np.int64)
        at, step = 0, WAVE
        while at < len(leaves):
            wave = order[:, at:at + step]
            bound = np.take_along_axis(upper, wave, 1)
            anchor, nth = np.nonzero((bound >= need[:, None]) & (bound > -np.inf))
            if not len(anchor):
                break
            at, step = at + step, 2 * step
            anchor, score, row = self._evaluate(leaves[wave[anchor, nth]], anchor, q, label, own, need, top, same)
            # each row found for every window of its anchor that it lies in
            begin, n = np.searchsorted(of, anchor), np.bincount(of, minlength=len(q))[anchor]
            each = np.repeat(np.arange(len(anchor)), n)
            w = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
            inside = (score[each] >= enough[w]) & (score[each] <= high[w])
            window = np.concatenate([window, w[inside]])
            scores = np.concatenate([scores, score[each[inside]]])
            ids = np.concatenate([ids, self.ids[row[each[inside]]]])
            first = np.lexsort((ids, -scores, window))
            window, scores, ids = window[first], scores[first], ids[first]
            place = np.arange(len(window)) - np.searchsorted(window, window)
            last = place == most - 1
            enough[window[last]] = np.maximum(enough[window[last]], scores[last])
            need = needed()
            keep = place < most
            window, scores, ids = window[keep], scores[keep], ids[keep]
        return window, scores, ids

    def _evaluate(self, leaf, anchor, q, label, own, need, top, same) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, exact score, row) of what the leaves hold for their anchors."""
        order = np.argsort(leaf, kind="stable")
        out = [(np.zeros(0, np.int64),) * 3]
        for part in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
            rows = slice(int(self.nodes["begin"][leaf[part[0]]]), int(self.nodes["end"][leaf[part[0]]]))
            who = anchor[part]
            score = (q[who] @ self.vectors[rows].T).astype(np.int64)
            fits = (score >= need[who, None]) & (score <= top[who, None])
            fits &= ((self.labels[rows] == label[who, None]) == same) & (self.rows[rows] != own[who, None])
            i, j = np.nonzero(fits)
            out.append((who[i], score[i, j], j + rows.start))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _leaves(self, unit, q, label, need, high, same) -> tuple[np.ndarray, np.ndarray]:
        """(leaves, upper bound of each for each anchor, -inf where it holds nothing for it), level by level."""
        queries, scale = self.space.queries(q)
        level, alive = np.zeros(1, np.int64), np.ones((len(q), 1), bool)
        leaves, upper = [], []
        while len(level):
            nodes = self.nodes[level]
            lowest, highest = bounds(queries, scale, unit[level], nodes["radius"])
            own = label[:, None]
            fits = (nodes["low"] <= own) & (own <= nodes["high"]) if same else (nodes["low"] != own) | (nodes["high"] != own)
            alive = alive & fits & (highest >= need[:, None]) & (lowest <= high[:, None])
            used = alive.any(axis=0)
            end = used & (nodes["children"] == 0)
            leaves.append(level[end])
            upper.append(np.where(alive[:, end], highest[:, end], -np.inf))
            inner = used & (nodes["children"] > 0)
            n = nodes["children"][inner]
            level = np.repeat(nodes["child"][inner] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            alive = np.repeat(alive[:, inner], n, axis=1)
        return np.concatenate(leaves), np.concatenate(upper, axis=1)

    @classmethod
    def stored(cls, space: Space, row: dict) -> Tree:
        numbers = {c: np.frombuffer(row[c], np.int64) for c in ("ids", "rows", "labels")}
        vectors = np.frombuffer(row["vectors"], space.stored).reshape(-1, max(1, space.width)).astype(space.exact)
        return cls(space, vectors, numbers["ids"], numbers["rows"], numbers["labels"], np.frombuffer(row["nodes"], NODE))


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows that take part, in whole numbers."""
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(STEPS)) * c.cast("double")))
    finite = ~F.exists("embedding", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(math.inf)))
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, c: s + F.floor(F.lit(float(STEPS)) * c.cast("double")).cast("double") ** 2)
    label = F.col("label").cast("decimal(20,0)")
    relabelled = F.when(F.col("vec_id") % RELABEL == 0, (label + 1) % LABELS).otherwise(label).cast("long")
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
        .withColumn("squares", squares).filter(F.col("squares") < float(LARGE))
        .select("vec_id", relabelled.alias("label"), x.alias("v"), "squares")
    )


def _stored(space: Space):
    """Vectors as bytes, shorter ones with zeros at their end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            n = np.diff(lists.offsets.to_numpy())
            x = np.zeros((len(batch), max(1, space.width)), space.stored)
            x[np.arange(x.shape[1]) < n[:, None]] = lists.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "vec_id", "label")), pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["row", "vec_id", "label", "v"])

    return run


def _cells(space: Space, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 4096):
                part = batch.slice(a, 4096)
                cosine = space.unit(space.matrix(part.column("v"))) @ pivots.T
                cell = cosine.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell.astype(np.int32)), pa.array(cosine[np.arange(len(cell)), cell])], [*part.schema.names, "cell", "cosine"])

    return run


def _marks(n: int) -> np.ndarray:
    """Places among n falling scores, NEGATIVES apart or more: MARKS in a row at the top, then ever rarer."""
    places, at, step = [], 0, float(NEGATIVES)
    while at < n:
        places.append(at)
        at += int(step)
        step *= 1.0 if len(places) < MARKS else 1.1
    return np.array(places, np.int64)


def _build(space: Space, anchors: int):
    """A slice's tree, and its anchors with their best rows there."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, rows, labels = (table.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        x = space.matrix(table.column("v"))
        order, nodes = cover(space.unit(x), labels)
        tree = Tree(space, x[order], ids[order], rows[order], labels[order], nodes)
        cell, piece = (k.as_py() for k in key)
        out = [{"cell": cell, "slice": piece, "vectors": tree.vectors.astype(space.stored).tobytes(), "ids": tree.ids.tobytes(),
                "rows": tree.rows.tobytes(), "labels": tree.labels.tobytes(), "nodes": nodes.tobytes()}]
        mine = np.flatnonzero(tree.ids % anchors == 0)
        every = np.tile(np.array([0, 0, -LARGE, LARGE, -LARGE], np.int64), (len(mine), 1))
        every[:, 0] = np.arange(len(mine))
        owner, _, scores, found = tree.best(tree.vectors[mine], tree.labels[mine], tree.rows[mine], every, POSITIVES, True)
        begin, end = np.searchsorted(owner, np.arange(len(mine))), np.searchsorted(owner, np.arange(len(mine)), side="right")
        for m, a, b in zip(mine, begin, end, strict=True):
            other = np.sort((tree.vectors[tree.labels != tree.labels[m]] @ tree.vectors[m]).astype(np.int64))[::-1]
            out.append({"cell": cell, "slice": piece, "row": int(tree.rows[m]), "vec_id": int(tree.ids[m]), "label": int(tree.labels[m]),
                        "v": tree.vectors[m].astype(space.stored).tobytes(), "scores": scores[a:b].tolist(), "found": found[a:b].tolist(),
                        "marks": other[_marks(len(other))].tolist()})
        return pa.Table.from_pylist(out, _INDEX)

    return run


INDEX = ("cell int, slice int, vectors binary, ids binary, rows binary, labels binary, nodes binary, "
         "row long, vec_id long, label long, v binary, scores array<long>, found array<long>, marks array<long>")
_BINARY = ("vectors", "ids", "rows", "labels", "nodes", "v")
_INDEX = pa.schema([("cell", pa.int32()), ("slice", pa.int32()), *((c, pa.binary()) for c in ("vectors", "ids", "rows", "labels", "nodes")),
                    *((c, pa.int64()) for c in ("row", "vec_id", "label")), ("v", pa.binary()),
                    *((c, pa.list_(pa.int64())) for c in ("scores", "found", "marks"))])


def windows(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest scores of negatives: 50 * positive <= 100 * negative <= 95 * positive."""
    return -(-scores // 2), 19 * (scores // 20) + 19 * (scores % 20) // 20


def _floor(marks: np.ndarray, low: int, high: int) -> int:
    """A score that at least NEGATIVES rows of the window reach; ``marks`` is falling scores, NEGATIVES or more rows apart."""
    at = int(np.searchsorted(-marks, -high, side="left"))  # the first mark not above the window
    return int(marks[at + 1]) if at + 1 < len(marks) and marks[at + 1] >= low else -LARGE


def _sought(batch: pa.RecordBatch, negatives: bool) -> np.ndarray:
    """(row of the batch, window, low, high, floor) of every window of every anchor."""
    out = []
    for i, (scores, marks) in enumerate(zip(batch.column("scores").to_pylist(), batch.column("marks").to_pylist(), strict=True)):
        if negatives:
            low, high = windows(np.array(scores, np.int64))
            marks = np.array(marks, np.int64)
            out += [(i, w, int(a), int(b), _floor(marks, int(a), int(b))) for w, (a, b) in enumerate(zip(low, high, strict=True)) if a <= b]
        else:
            out.append((i, 0, -LARGE, LARGE, min(scores) if len(scores) == POSITIVES else -LARGE))
    return np.array(out, np.int64).reshape(-1, 5)


def _route(space: Space, pivots: np.ndarray, cells: list[tuple], negatives: bool):
    """An anchor, with its windows, once for each slice of every cell that can hold what it looks for (for positives, but its own)."""
    radius = np.array([c[1] for c in cells])
    pieces = np.array([c[2] for c in cells])
    lowest, highest = np.array([c[3] for c in cells], np.int64), np.array([c[4] for c in cells], np.int64)
    place = [c[0] for c in cells]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), ROUND):
                part = batch.slice(a, ROUND)
                sought = _sought(part, negatives)
                if not len(sought):
                    continue
                queries, scale = space.queries(space.matrix(part.column("v")))
                low, high = bounds(queries, scale, pivots[place], radius)
                label = part.column("label").to_numpy()[:, None]
                fits = (lowest != label) | (highest != label) if negatives else (lowest <= label) & (label <= highest)
                i = sought[:, 0]
                meets = (high[i] >= sought[:, 2:3]) & (high[i] >= sought[:, 4:5]) & (low[i] <= sought[:, 3:4]) & fits[i]
                any_window = np.zeros(fits.shape, bool)
                np.logical_or.at(any_window, i, meets)
                i, c = np.nonzero(any_window)
                i, c, n = np.repeat(i, pieces[c]), np.repeat(c, pieces[c]), pieces[c]
                piece = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
                cell = np.array(place)[c]
                if not negatives:  # what its own slice holds is known
                    other = (cell != part.column("cell").to_numpy()[i]) | (piece != part.column("slice").to_numpy()[i])
                    i, cell, piece = i[other], cell[other], piece[other]
                chosen = part.take(pa.array(i))
                ends = np.searchsorted(sought[:, 0], np.arange(len(part) + 1))
                seen = pa.array([sought[x:y, 1:].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary()).take(pa.array(i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(piece.astype(np.int32)), *(chosen.column(x) for x in ("row", "label", "v")), seen],
                    ["cell", "slice", "row", "label", "v", "windows"])

    return run


def _search(space: Space, negatives: bool):
    most = NEGATIVES if negatives else POSITIVES

    def run(anchors: pa.Table, index: pa.Table) -> pa.Table:
        row = nth = score = found = np.zeros(0, np.int64)
        if anchors.num_rows and index.num_rows:
            tree = Tree.stored(space, {c: index.column(c)[0].as_py() for c in _BINARY if c != "v"})
            of = [np.frombuffer(x.as_py(), np.int64).reshape(-1, 4) for x in anchors.column("windows")]
            sought = np.hstack([np.repeat(np.arange(len(of)), [len(x) for x in of])[:, None], np.concatenate(of)])
            label, row = anchors.column("label").to_numpy(), anchors.column("row").to_numpy()
            anchor, nth, score, found = tree.best(space.matrix(anchors.column("v")), label, row, sought, most, not negatives)
            row = row[anchor]
        return pa.table([row, nth.astype(np.int32), score, found], ["row", "nth", "score", "id"])

    return run


def _first(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best of each (row, nth), numbered from 1: higher scores first, ties to the smaller id."""
    order = Window.partitionBy("row", "nth").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")


def hard_negatives(embeddings: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``anchors`` divides; a label moves up by
    one, modulo LABELS, where RELABEL divides vec_id.  A score is the inner
    product of two vectors in whole steps of 1 / STEPS, rounded down; higher ones
    come first, ties by the smaller vec_id.  Positives are an anchor's first
    POSITIVES other rows of its label, negatives of each the first NEGATIVES
    rows of other labels that score 50 to 95 hundredths of it.

    Rows with a NULL vec_id, label or vector, or a NULL or non-finite component
    take no part, nor do those whose squared norm in steps reaches 2^62 (their
    scores would not fit a long).  Shorter vectors, empty ones too, count as
    ended by zeros.  Rows of one vec_id are rows each: an anchor's own row alone
    is not its positive.  Only vec_id, embedding and label are read; an empty
    table gives an empty result.
    """
    spark = embeddings.sparkSession
    rows = stage(usable(embeddings).withColumn("row", F.monotonically_increasing_id()), "usable")
    count, width, squares = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max("squares")).first()
    if not count:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    space = Space(int(width), max(1.0, math.sqrt(squares)) * (1 + 1e-12))
    most_rows = min(SLICE_ROWS, max(LEAF, SLICE_BYTES // (8 * max(1, space.width))))
    most_pivots = max(1, PIVOT_BYTES // (8 * (space.width + 1)))
    n_pivots = min(most_pivots, max(LEAST_CELLS, -(-count // most_rows)))
    vectors = rows.select("row", "vec_id", "label", "v").mapInArrow(_stored(space), "row long, vec_id long, label long, v binary")
    sample = vectors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE * n_pivots).select("v").toArrow()  # at most SAMPLE * PIVOT_BYTES
    spots = space.unit(space.matrix(sample.column("v")))
    pivots = spots[apart(spots, n_pivots)[0]]
    placed = stage(vectors.mapInArrow(_cells(space, pivots), "row long, vec_id long, label long, v binary, cell int, cosine double"), "placed")
    of_cells = placed.groupBy("cell").agg(F.min("cosine"), F.count(F.lit(1)), F.min("label"), F.max("label"))
    cells = sorted((c, math.acos(min(1.0, max(-1.0, cosine))), -(-n // most_rows), low, high) for c, cosine, n, low, high in of_cells.collect())
    pieces = F.create_map(*(F.lit(x) for c, _, n, *_ in cells for x in (c, n)))
    index = stage(
        placed.withColumn("slice", F.pmod(F.xxhash64("row"), pieces[F.col("cell")]).cast("int"))
        .groupBy("cell", "slice").applyInArrow(_build(space, anchors), INDEX), "index")
    slices = index.filter("row IS NULL").select("cell", "slice", *(c for c in _BINARY if c != "v"))
    asking = index.filter("row IS NOT NULL").select("cell", "slice", "row", "vec_id", "label", "v", "scores", "found", "marks")
    # as many blocks of anchors as keep a slice's anchors in memory; each block meets a copy of the slice
    blocks = -(-asking.count() // most_rows)
    if not blocks:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    copies = slices.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(what: DataFrame, negatives: bool) -> DataFrame:
        sent = what.select("cell", "slice", "row", "label", "v", "scores", "marks").mapInArrow(
            _route(space, pivots, cells, negatives), "cell int, slice int, row long, label long, v binary, windows binary")
        return (sent.withColumn("block", _block(blocks)).groupBy("cell", "slice", "block")
                .cogroup(copies.groupBy("cell", "slice", "block"))
                .applyInArrow(_search(space, negatives), "row long, nth int, score long, id long"))

    known = asking.select("row", F.lit(0).alias("nth"), F.explode(F.arrays_zip("scores", "found")).alias("x")).select("row", "nth", "x.scores", "x.found")
    positives = stage(_first(search(asking, False).unionByName(known.toDF("row", "nth", "score", "id")), POSITIVES), "positives")
    ranked = positives.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))  # at most POSITIVES
    windowed = asking.drop("scores", "found").join(ranked.select("row", F.col("p.score").alias("scores")), "row")
    negatives = _first(search(windowed, True), NEGATIVES)
    pairs = positives.join(asking.select("row", F.col("vec_id").alias("anchor_id")), "row").select(
        "row", (F.col("rank") - 1).alias("nth"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(pairs, ["row", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
