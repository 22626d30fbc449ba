"""Similarity graph analytics.

Vertices are all users, edges (src < dst, weight) come from the pair
kernel, which packs them in cells (`similarity_cells`), so that no operator reads them
as rows. Iterative jobs run one DataFrame step per iteration; each step is a table
in the shared folder, so plans stay one step deep, a lost executor only replays the
current step, and the planner picks joins by true sizes. A step's table is deleted
once the next one is written. Hubs are dealt to lots by their measured degrees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stray.config import GRAPH_MINMAX_EPS
from stray.functions.stats import minmax_bounds, minmax_eps
from stray.operators import blocks as B
from stray.operators import similarity as S
from stray.operators.spread import dealt, hubs_of, repeated
from stray.session import Written, bounded_batches, bucket_count, reliable_checkpoint, written

#: Edges that a task gathers before it reduces them to a forest, and rows that it passes on at once.
FOREST_EDGES, FOREST_ROWS = 1 << 18, 1 << 16
#: Edges of a packed cell, and pairs of a dense one, about. A request is dense where one in `SPARSE` of its pairs is an edge.
CELL_EDGES, CELL_PAIRS, SPARSE = 1 << 17, 1 << 20, 32
#: Columns of a cell that name the ends of its edges, and those that tell the weights.
ENDS, WEIGHTS = ("ids", "i", "j", "far"), ("w", "m")


class PageRankNotConverged(RuntimeError):
    pass


@dataclass(frozen=True)
class PackedEdges:
    """Edges packed in cells (`Cell`; `packed_cells`, `similarity_cells`). Operators take them in place of rows."""

    cells: Written

    def count(self) -> int:
        return int(self.cells.df.agg(F.sum("n")).first()[0] or 0)

    def rows(self) -> DataFrame:
        """(src, dst, weight), src < dst."""
        kind = self.cells.df.schema["ids"].dataType.elementType
        schema = T.StructType([T.StructField("src", kind), T.StructField("dst", kind), T.StructField("weight", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, i, j, w in opened(batches):
                for at in range(0, len(i), FOREST_ROWS):
                    part = slice(at, at + FOREST_ROWS)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(i[part])), ids.take(pa.array(j[part])), pa.array(w[part])], schema.names)

        both = self.cells.df.select(*ENDS, *WEIGHTS).mapInArrow(run, schema)
        return both.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "weight")


@dataclass
class Cell:
    """A cell as a task sees it. A list has edges `i[k]`-`j[k]` of weights `w`; a dense cell has rows `i` and columns `j`
    with their unit vectors (`left`, `right`), and says which pairs are `far`: the others are its edges, their weights the cosines."""

    ids: pa.Array
    i: np.ndarray
    j: np.ndarray
    w: np.ndarray | None = None
    far: np.ndarray | None = None
    left: np.ndarray | None = None
    right: np.ndarray | None = None

    def portions(self) -> Iterator[slice]:
        """Rows of a dense cell, few at a time."""
        step = max(1, CELL_EDGES // len(self.j))
        return (slice(at, at + step) for at in range(0, len(self.i), step))

    def cosines(self, part: slice) -> np.ndarray:
        """Of some rows to all columns, 0 where they are far."""
        w = self.left[part] @ self.right.T
        np.copyto(w, 0.0, where=self.far[part])
        return w

    def edges(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """(i, j, w), some at a time; w where the cell was read with it."""
        if self.far is None:
            yield self.i, self.j, self.w
            return
        for part in self.portions():
            r, c = np.nonzero(~self.far[part])
            yield self.i[part][r], self.j[c], None if self.left is None else S.pair_cosines(self.left[part], self.right, r, c)

    def sums(self, x: np.ndarray | None) -> np.ndarray:
        """For each of `ids` the sum of its edges' weights, times `x` at their other ends, if given."""
        n, i, j = len(self.ids), self.i, self.j
        if self.far is None:
            to_j, to_i = (self.w, self.w) if x is None else (self.w * x.take(i), self.w * x.take(j))
            return np.bincount(j, to_j, n) + np.bincount(i, to_i, n)
        x = np.ones(n) if x is None else x
        to_i, to_j, at_j = np.zeros(len(i)), np.zeros(len(j)), x[j]
        for part in self.portions():
            w = self.cosines(part)
            to_i[part] = w @ at_j
            to_j += x[i[part]] @ w
        return np.bincount(j, to_j, n) + np.bincount(i, to_i, n)

    def degrees(self) -> np.ndarray:
        """For each of `ids` the number of its edges."""
        n = len(self.ids)
        if self.far is None:
            return np.bincount(self.i, minlength=n) + np.bincount(self.j, minlength=n)
        of_i, of_j = ((~self.far).sum(axis=axis) for axis in (1, 0))
        return (np.bincount(self.i, of_i, n) + np.bincount(self.j, of_j, n)).astype(np.int64)


def cells_of(batch: pa.RecordBatch) -> Iterator[Cell]:
    """The cells of a batch, with weights where it has them."""
    weighed = "w" in batch.schema.names
    for row in range(batch.num_rows):
        def packed(name: str, kind: type) -> np.ndarray | None:
            value = batch.column(name)[row]
            return np.frombuffer(value.as_buffer(), kind) if value.is_valid else None

        ids = batch.column("ids")[row].values
        code = np.uint16 if len(ids) <= 1 << 16 else np.int32
        cell = Cell(ids, *(packed(c, code).astype(np.intp) for c in "ij"))
        far = packed("far", np.uint8)
        if far is not None:
            shape = len(cell.i), len(cell.j)
            cell.far = np.unpackbits(far, count=shape[0] * shape[1]).view(bool).reshape(shape)
            if weighed:
                m = packed("m", np.float64).reshape(sum(shape), -1)
                cell.left, cell.right = m[:shape[0]], m[shape[0]:]
        elif weighed:
            cell.w = packed("w", np.float64)
        yield cell


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(ids, i, j, w) of the edges of each cell, some at a time, w where the batches have it."""
    for batch in batches:
        for cell in cells_of(batch):
            for part in cell.edges():
                yield cell.ids, *part


def both_directions(edges: DataFrame) -> DataFrame:
    """(a, b, w): each undirected edge in both directions."""
    e = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("weight").alias("w"))
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def degree_centrality(nodes: DataFrame, edges: DataFrame | PackedEdges, n: int | None = None) -> DataFrame:
    """(id, degree, degree_centrality = degree / (n - 1)); 1.0 when n <= 1.
    Zero-degree nodes come from a union, not a join: one aggregation shuffle."""
    if n is None:
        n = nodes.count()
    if isinstance(edges, PackedEdges):
        d = cell_degrees(edges.cells.df)
    else:
        d = both_directions(edges).select(F.col("a").alias("id"), F.lit(1).cast("bigint").alias("one"))
    zero = nodes.select(F.col("id"), F.lit(0).cast("bigint").alias("one"))
    deg = d.unionByName(zero).groupBy("id").agg(F.sum("one").alias("degree"))
    cen = F.lit(1.0) if n <= 1 else F.col("degree").cast("double") / F.lit(float(n - 1))
    return deg.select("id", "degree", cen.alias("degree_centrality"))


def pagerank(nodes: DataFrame, edges: DataFrame | PackedEdges, alpha: float = 0.85, max_iter: int = 100,
             tol: float | None = 1e-6, n: int | None = None) -> DataFrame:
    """Weighted PageRank of the undirected graph: (id, pagerank).

    Power iteration x' = alpha (x P + D/n) + (1 - alpha)/n with P the
    out-weight-normalised transition and D the mass on dangling nodes.
    tol=None runs exactly `max_iter` steps; otherwise stops when the L1
    change < n * tol and raises if that never happens.

    Edges that are not packed yet are packed once in cells of `CELL_EDGES` (`packed_cells`), in the order in which they
    come, so that edges from one pair of blocks share their nodes. A step sends a cell one number for each of its nodes
    and gets one back: what is joined and shuffled grows with the nodes of the cells, not with their edges, and no node
    is in a cell twice, hub or not. The numbers go to the buckets of the cells, so that no step shuffles a cell. Each step writes the n ranks. Nodes without edges all have one rank, so their mass needs no
    pass; the L1 change is computed only where it is asked for.
    """
    if n is None:
        n = nodes.count()
    spark = nodes.sparkSession
    if n == 0:
        return spark.createDataFrame([], "id long, pagerank double")
    cells = edges.cells if isinstance(edges, PackedEdges) else packed_cells(edges)
    members = written(cells.df.select("cell", F.posexplode("ids").alias("pos", "id")).where(F.col("id").isNotNull())
                      .repartition("id"), "members", "id")
    verts = nodes.select("id").join(out_weights(cells.df), "id", "left")
    ranks = written(verts.select("id", "sw", F.lit(1.0 / n).alias("r")), "ranks")
    free = ranks.df.where(F.col("sw").isNull()).count()
    base, lone = (1.0 - alpha) / n, 1.0 / n
    converged = False
    try:
        for _ in range(max_iter):
            sent = (members.df.join(ranks.df.where(F.col("sw").isNotNull()).select("id", (F.col("r") / F.col("sw")).alias("x")), "id")
                    .repartition(bucket_count(spark), "cell").groupBy("cell").agg(F.collect_list(F.struct("pos", "x")).alias("sent")))
            contrib = cell_sums(cells.df.join(sent.hint("shuffle_hash"), "cell")).groupBy("id").agg(F.sum("s").alias("s"))
            lone = alpha * free * lone / n + base
            new = written(ranks.df.join(contrib, "id", "left").select(
                "id", "sw", F.col("r").alias("r_old"), (F.lit(alpha) * F.coalesce("s", F.lit(0.0)) + F.lit(lone)).alias("r")), "ranks")
            ranks.drop()
            ranks = new
            if tol is not None and ranks.df.agg(F.sum(F.abs(F.col("r") - F.col("r_old")))).first()[0] < n * tol:
                converged = True
                break
        if tol is not None and not converged:
            raise PageRankNotConverged(f"PageRank did not converge in {max_iter} iterations")
    finally:
        if not isinstance(edges, PackedEdges):
            cells.drop()
        members.drop()
    return ranks.df.select("id", F.col("r").alias("pagerank"))


def cell_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("cell", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
                         *[T.StructField(c, T.BinaryType()) for c in ("i", "j", "w", "far", "m")]])


def one_cell(cell: int, both: pa.DictionaryArray, i: np.ndarray, j: np.ndarray, w: np.ndarray, schema: T.StructType) -> pa.RecordBatch:
    """A cell of the edges between places `i` and `j` of `both`, every node once in its `ids`."""
    code = codes(both)
    return cell_row(cell, len(w), both.dictionary, (code[i], code[j], w, None, None), schema)


def dense_cell(cell: int, both: pa.DictionaryArray, near: np.ndarray, x: np.ndarray, schema: T.StructType) -> pa.RecordBatch:
    """A cell of the `near` pairs of the rows and columns whose ids are `both` and whose unit vectors are `x`, one after the other."""
    code, k = codes(both), len(near)
    return cell_row(cell, np.count_nonzero(near), both.dictionary, (code[:k], code[k:], None, np.packbits(~near), x), schema)


def codes(both: pa.DictionaryArray) -> np.ndarray:
    return both.indices.to_numpy().astype(np.uint16 if len(both.dictionary) <= 1 << 16 else np.int32)


def cell_row(cell: int, n: int, ids: pa.Array, packed: tuple, schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([cell], pa.int64()), pa.array([n], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
         *[pa.array([None if x is None else x.tobytes()], pa.binary()) for x in packed]], schema.names)


def packed_cells(edges: DataFrame) -> Written:
    """(cell, n, ids, i, j, w, far, m): the n edges of a cell by the places of their ends in `ids`, packed (`Cell`); a table
    bucketed by cell. All are lists here, as weights of any kind are kept."""
    bounded_batches(edges.sparkSession, B.BATCH_BYTES)
    schema = cell_schema(edges.schema["src"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done, held, waiting = TaskContext.get().partitionId() << 32, 0, [], 0

        def cell() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            both = pa.chunked_array([*t["src"].chunks, *t["dst"].chunks]).combine_chunks().dictionary_encode("encode")
            w = t["weight"].combine_chunks().fill_null(0.0).to_numpy(zero_copy_only=False)
            return one_cell(first + done, both, np.arange(len(w)), np.arange(len(w), 2 * len(w)), w, schema)

        for batch in batches:
            for at in range(0, batch.num_rows, CELL_EDGES):
                held.append(batch.slice(at, CELL_EDGES))
                waiting += held[-1].num_rows
                if waiting >= CELL_EDGES:
                    yield cell()
                    done, held, waiting = done + 1, [], 0
        if waiting:
            yield cell()

    return written(edges.select("src", "dst", "weight").mapInArrow(run, schema), "cells", "cell", large_rows=True)


class CellBox:
    """A task's edges, given by places in arrays of ids, until they are a cell; and what a block's dense requests have near."""

    def __init__(self, kind: T.DataType) -> None:
        self.kind, self.schema, self.next = kind, cell_schema(kind), TaskContext.get().partitionId() << 32
        self.clear()
        self.block, self.near, self.pairs, self.count = None, [], 0, 0

    def clear(self) -> None:
        self.arrays, self.begin, self.places, self.edges, self.waiting = [], {}, 0, [], 0

    def place(self, ids: np.ndarray) -> int:
        """Where the places of `ids` begin; an array is kept, and so known again, until the cell is taken."""
        if id(ids) not in self.begin:
            self.begin[id(ids)] = self.places
            self.arrays.append(ids)
            self.places += len(ids)
        return self.begin[id(ids)]

    def put(self, left: np.ndarray, i: np.ndarray, right: np.ndarray, j: np.ndarray, w: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(w), CELL_EDGES):
            part = slice(at, at + CELL_EDGES)
            self.edges.append((self.place(left) + i[part], self.place(right) + j[part], w[part]))
            self.waiting += len(w[part])
            if self.waiting >= CELL_EDGES:
                yield from self.take_list()

    def put_dense(self, block: B.Held, ids: np.ndarray, x: np.ndarray, near: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows (ids, x) of a request to `block`, and which pairs with the block's rows are edges."""
        if self.block is not block:
            yield from self.take_dense()
            self.block = block
        self.near.append((ids, x, near))
        self.pairs += near.size
        self.count += np.count_nonzero(near)
        if self.count >= CELL_EDGES or self.pairs >= CELL_PAIRS:
            yield from self.take_dense()

    def take_dense(self) -> Iterator[pa.RecordBatch]:
        if self.near:
            ids, x, near = map(np.concatenate, zip(*self.near))
            met = near.any(axis=0)
            both = pa.concat_arrays([S._typed(i, self.kind) for i in (ids, self.block.ids[met])]).dictionary_encode("encode")
            yield dense_cell(self.next, both, near[:, met], np.concatenate([x, self.block.x[met]]), self.schema)
            self.next += 1
        self.near, self.pairs, self.count = [], 0, 0

    def take(self) -> Iterator[pa.RecordBatch]:
        yield from self.take_dense()
        yield from self.take_list()

    def take_list(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            i, j, w = map(np.concatenate, zip(*self.edges))
            used = np.zeros(self.places, bool)
            used[i] = used[j] = True
            ids = pa.concat_arrays([S._typed(x, self.kind) for x in self.arrays]).filter(pa.array(used))
            at = np.cumsum(used) - 1
            yield one_cell(self.next, ids.dictionary_encode("encode"), at[i], at[j], w, self.schema)
            self.next += 1
        self.clear()


def similarity_cells(vecs: DataFrame, threshold: float = 0.7, id_col: str = "user_id", vec_col: str = "z",
                     block_size: int = 2048, centres: int | None = None) -> PackedEdges:
    """The edges of `similarity_edges`, packed in cells by the tasks that find them. Where many pairs of a request are near,
    a cell holds the nodes' unit vectors and a bit for each pair, which are fewer bytes than edges with their weights."""
    kind = vecs.schema[id_col].dataType
    bounded_batches(vecs.sparkSession, B.BATCH_BYTES)
    b = S._blocks(vecs, id_col, vec_col, block_size, centres)
    if b is None:
        return PackedEdges(written(vecs.sparkSession.createDataFrame([], cell_schema(kind)), "cells", "cell", large_rows=True))

    def make() -> tuple[B.Kernel, Callable]:
        box = CellBox(kind)

        def kernel(held: B.Held, asked: B.Held) -> Iterator[pa.RecordBatch]:
            for ids, x, at, keep in S.near_masks(held, asked, threshold):
                rows = keep.any(axis=1)
                if np.count_nonzero(keep) * SPARSE >= np.count_nonzero(rows) * keep.shape[1]:
                    part = slice(at, at + len(keep))
                    yield from box.put_dense(held, ids[part][rows], x[part][rows], keep[rows])
                else:
                    i, j = np.nonzero(keep)
                    yield from box.put(ids, at + i, held.ids, j, S.pair_cosines(x, held.x, at + i, j))
        return kernel, box.take

    return PackedEdges(written(B.meet(b, S._edge_requests(b, threshold), make, cell_schema(kind)), "cells", "cell", large_rows=True))


def cell_sums(cells: DataFrame) -> DataFrame:
    """(id, s) for each node of each cell: the sum of its edges' weights, times what was `sent` for their other ends, if anything was."""
    schema = T.StructType([T.StructField("id", cells.schema["ids"].dataType.elementType), T.StructField("s", T.DoubleType())])
    told = "sent" in cells.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, cell in enumerate(cells_of(batch)):
                ids, x = cell.ids, None
                if told:
                    sent, x = batch.column("sent")[row].values, np.zeros(len(ids))
                    pos, value = (x.to_numpy(zero_copy_only=False) for x in sent.flatten())
                    np.add.at(x, pos, value)
                s = cell.sums(x)
                for at in range(0, len(ids), FOREST_ROWS):
                    yield pa.RecordBatch.from_arrays([ids[at:at + FOREST_ROWS], pa.array(s[at:at + FOREST_ROWS])], schema.names)

    return cells.select(*ENDS, *WEIGHTS, *["sent"] * told).mapInArrow(run, schema)


def cell_degrees(cells: DataFrame) -> DataFrame:
    """(id, one) for each node of each cell: the number of its edges."""
    schema = T.StructType([T.StructField("id", cells.schema["ids"].dataType.elementType), T.StructField("one", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in cells_of(batch):
                ids, n = cell.ids, cell.degrees()
                for at in range(0, len(ids), FOREST_ROWS):
                    yield pa.RecordBatch.from_arrays([ids[at:at + FOREST_ROWS], pa.array(n[at:at + FOREST_ROWS], pa.int64())], schema.names)

    return cells.select(*ENDS).mapInArrow(run, schema)


def out_weights(cells: DataFrame) -> DataFrame:
    """(id, sw): the sum of the weights of each node's edges."""
    return cell_sums(cells).groupBy("id").agg(F.sum("s").alias("sw"))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of all nodes that are not the least, for edges a-b: every round
    hooks the larger root of an edge to the smaller and jumps all pointers to their roots."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = code[:len(a)], code[len(a):]
    label = np.arange(len(nodes))
    while len(i):
        x, y = label[i], label[j]
        open_ = x != y
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def contracted(edges: DataFrame | PackedEdges) -> DataFrame:
    """(u, v): a spanning forest of each partition's edges (u, v), as stars around the least node of each
    component; edges are taken in `FOREST_EDGES` at a time, or a cell, so a task holds its nodes and no more."""
    packed = isinstance(edges, PackedEdges)
    kind = edges.cells.df.schema["ids"].dataType.elementType if packed else edges.schema["u"].dataType
    schema = T.StructType([T.StructField("u", kind), T.StructField("v", kind)])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if packed:
            for ids, i, j, _ in opened(batches):
                ids = ids.to_numpy(zero_copy_only=False)
                apart = ids[i] != ids[j]
                yield ids[i[apart]], ids[j[apart]]
            return
        for batch in batches:
            yield tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in "uv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for part in ends(batches):
            if len(part[0]):
                held.append(part)
                waiting += len(part[0])
                if waiting >= FOREST_EDGES:
                    held = [forest(*map(np.concatenate, zip(*held)))]
                    waiting = 0
        if held:
            u, v = forest(*map(np.concatenate, zip(*held)))
            for i in range(0, len(u), FOREST_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x[i:i + FOREST_ROWS], to_arrow_type(kind)) for x in (u, v)], schema.names)

    return (edges.cells.df.select(*ENDS) if packed else edges.select("u", "v")).mapInArrow(run, schema)


def _with_minima(links: DataFrame) -> tuple[DataFrame, Written]:
    """The links (u, v) with the least neighbour of u (mv), and the minima (u, mv) alone."""
    mn = written(links.groupBy("u").agg(F.min("v").alias("mv"), F.count(F.lit(1)).alias("c")), "minima")
    total = mn.df.agg(F.sum("c")).first()[0] or 0
    hubs = hubs_of(mn.df.select(F.col("u").alias("key"), "c"), total)
    joined = dealt(links, "u", "v", hubs).join(repeated(mn.df.select("u", "mv"), "u", hubs), ["u", "lot"])
    return joined.select("u", "v", "mv"), mn


def connected_components(nodes: DataFrame, edges: DataFrame | PackedEdges, max_rounds: int = 64, n: int | None = None) -> DataFrame:
    """(id, component = smallest id of its component).

    Before any shuffle each partition reduces its edges to a spanning forest (`contracted`),
    so a node, hub or not, is at most one row from each. The forests are dealt by node, reduced
    again, and joined by alternating large-star / small-star rounds (Kiveris et al., 2014),
    whose links to hubs are dealt to lots. Converged when every node has at most one parent
    and no parent has one.
    """
    e = edges
    if not isinstance(edges, PackedEdges):
        e = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).where(F.col("u") != F.col("v"))
    links = contracted(contracted(e).repartition("u"))
    turned = lambda x: x.unionByName(x.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    und = written(turned(links), "links")
    for _ in range(max_rounds):
        # large-star: link every larger neighbour of u to min(N(u) + u)
        near, mn = _with_minima(und.df)
        large = written(near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "mv").alias("v")).distinct(), "large")
        mn.drop()
        # small-star: u's smaller neighbours and u itself point to min(N(u) + u)
        near, ms = _with_minima(large.df)
        small = (near.where(F.col("v") != F.col("mv")).select(F.col("v").alias("u"), F.col("mv").alias("v"))
                 .unionByName(ms.df.select("u", F.col("mv").alias("v"))).distinct())
        parents = written(small, "parents")
        for old in (ms, large, und):
            old.drop()
        multi = (parents.df.groupBy("u").agg(F.count(F.lit(1)).alias("c"))
                 .where(F.col("c") > 1).select("u"))
        chained = parents.df.select(F.col("v").alias("u")).distinct().join(parents.df.select("u"), "u", "left_semi")
        if multi.unionByName(chained).limit(1).count() == 0:
            break
        und = written(turned(parents.df), "links")
        parents.drop()
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    return (nodes.select("id").join(parents.df.select(F.col("u").alias("id"), F.col("v").alias("p")), "id", "left")
            .select("id", F.coalesce("p", "id").alias("component")))


def isolated_nodes(degrees: DataFrame, top_k: int = 10) -> DataFrame:
    """The k lowest degree centralities, ascending, ties by id."""
    return (degrees.select(F.col("id").alias("user_id"), "degree_centrality")
            .orderBy(F.col("degree_centrality").asc(), F.col("user_id").asc()).limit(top_k))


def graph_anomalies(pr: DataFrame, deg: DataFrame) -> DataFrame:
    """Min-max (+1e-10) of PageRank and degree, score ((1-pr)+(1-deg))/2.
    A user absent from either side counts 0 there."""
    j = (pr.join(deg.select("id", "degree_centrality"), "id", "full")
         .select(F.col("id").alias("user_id"),
                 F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"),
                 F.coalesce("degree_centrality", F.lit(0.0)).alias("degree_centrality")))
    b = minmax_bounds(j, ["pagerank", "degree_centrality"])
    prn = minmax_eps(F.col("pagerank"), *b["pagerank"], GRAPH_MINMAX_EPS)
    dgn = minmax_eps(F.col("degree_centrality"), *b["degree_centrality"], GRAPH_MINMAX_EPS)
    return j.select("user_id", "pagerank", "degree_centrality",
                    (((F.lit(1.0) - prn) + (F.lit(1.0) - dgn)) / 2.0).alias("graph_anomaly_score"))


def graph_statistics(nodes: DataFrame, edges: DataFrame | PackedEdges, components: DataFrame) -> DataFrame:
    """One row: n_nodes, n_edges, density, n_components, avg_degree."""
    spark = nodes.sparkSession
    n = nodes.count()
    m = edges.count()
    c = components.select("component").distinct().count()
    density = 0.0 if (n <= 1 or m == 0) else 2.0 * m / (n * (n - 1))
    avg_deg = 2.0 * m / n if n > 0 else 0.0
    return spark.createDataFrame([(n, m, density, c, avg_deg)],
                                 "n_nodes long, n_edges long, density double, "
                                 "n_components long, avg_degree double")


def graph_moments(pr: DataFrame, deg: DataFrame) -> DataFrame:
    """Mean and population std of PageRank and of degree centrality."""
    a = pr.agg(F.avg("pagerank").alias("pagerank_mean"),
               F.stddev_pop("pagerank").alias("pagerank_std"))
    b = deg.agg(F.avg("degree_centrality").alias("degree_mean"),
                F.stddev_pop("degree_centrality").alias("degree_std"))
    ra, rb = a.first(), b.first()
    spark = pr.sparkSession
    return spark.createDataFrame(
        [(ra["pagerank_mean"], ra["pagerank_std"], rb["degree_mean"], rb["degree_std"])],
        "pagerank_mean double, pagerank_std double, degree_mean double, degree_std double")


@dataclass(frozen=True)
class GraphResult:
    edges: DataFrame
    pagerank: DataFrame
    degrees: DataFrame
    scores: DataFrame
    statistics: DataFrame | None = None     # G8 and G9 in one row, when asked for
    top: DataFrame | None = None            # highest graph scores, ties by user


def detect_anomalies_graph(nodes: DataFrame, edges: DataFrame | PackedEdges, alpha: float = 0.85,
                           max_iter: int = 100, tol: float | None = 1e-6, with_statistics: bool = False,
                           show_top: int = 0) -> GraphResult:
    """G10 on a given edge set: PageRank + degree -> graph anomaly scores, with statistics and a top list on demand."""
    n = nodes.count()
    pr = pagerank(nodes, edges, alpha, max_iter, tol, n)
    deg = reliable_checkpoint(degree_centrality(nodes, edges, n))
    scores = reliable_checkpoint(graph_anomalies(pr, deg))
    stats = top = None
    if with_statistics:
        stats = graph_statistics(nodes, edges, connected_components(nodes, edges, n=n)).crossJoin(graph_moments(pr, deg))  # one row each
    if show_top > 0:
        top = scores.orderBy(F.col("graph_anomaly_score").desc(), F.col("user_id").asc()).limit(show_top)
    return GraphResult(edges.rows() if isinstance(edges, PackedEdges) else edges, pr, deg, scores, stats, top)


def detect_anomalies(vecs: DataFrame, threshold: float = 0.7, alpha: float = 0.85, max_iter: int = 100, tol: float | None = 1e-6,
                     with_statistics: bool = True, show_top: int = 0, id_col: str = "user_id", vec_col: str = "z",
                     block_size: int = 2048) -> GraphResult:
    """The similarity graph of the users (G1), then all of the above."""
    edges = similarity_cells(vecs, threshold, id_col, vec_col, block_size)
    nodes = vecs.select(F.col(id_col).alias("id"))
    return detect_anomalies_graph(nodes, edges, alpha, max_iter, tol, with_statistics, show_top)
