"""Embedding near-dedup by int8 tile products with exact error bounds.

Vectors are compared inside their group (a label) only. Equal vectors of a group are one class, found by an aggregation in which
copies meet inside each task; only classes are compared, and every copy gets its class's answer.

Classes are dealt to tiles of at most about ``TILE`` vectors, by hash, and a tile is one row of packed vectors. Each
unordered pair of tiles of a group (a tile with itself included) is one row of a join on (group, tile, tile), so no key is
hot and no task holds more than two tiles. In it, a unit vector u is quantised as u = s*q + e with bytes q. Since |u| = 1,
Cauchy and Schwarz give

    |u.v - s_u s_v (q_u.q_v)|  <=  |s_u q_u| |e_v| + |e_u|

with the measured norms of each vector's own e, not an estimate. Products of bytes are summed by a single-precision matrix
product in stretches of ``EXACT`` dimensions, so short that every sum is an exact integer; ``PAD`` covers what later
steps round. Pairs whose upper bound is below the threshold are no links, pairs whose lower bound reaches it
are links, and only the rest is recomputed in double precision. So the result is that of the full comparison.

A tile pair does not emit its links: it counts them for each class and gives a spanning forest of them, both at
most as long as its two tiles. Counts add up, forests have the links' components. The comparisons themselves grow with the square of a
group, spread over its tile pairs; a tile travels once for every tile of its group.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite entries link with nothing, nor do rows whose
group or key is NULL, nor vectors of another length. A row without links is its own component; with a NULL key its component is NULL and it
is kept. Rows that repeat a key are vectors of their own: a repeated row is linked to the first, and the component is named by
the smallest key. An entry -0.0 equals 0.0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import Scratch, packed
from corpuscope.llm.components import connected_components

THRESHOLD = 0.93
TILE = 2048
TILE_BYTES = 32 << 20
EXACT = 1024  # 1024 * 127 * 127 < 2^24
BLOCK = 1024  # rows and columns of a tile multiplied at once
PAD = 1e-5
RECOMPUTED = 1 << 22  # numbers gathered at once in double precision
PAIRS = 64  # pairs of tiles for a task, if the session's number of partitions is too small
SHARE = 1000  # classes with over a SHAREth of all rows are hot; there are fewer than SHARE of them


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; the largest entry is scaled to one first, so nothing overflows."""
    scaled = vectors.astype(float)
    scaled /= np.abs(scaled).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


class Tile:
    """Unit vectors, their bytes, and the norms that bound the quantisation's error."""

    def __init__(self, vectors: np.ndarray):
        self.units = unit(vectors)
        self.scale = np.abs(self.units).max(1, initial=0.0) / 127
        self.bytes = np.rint(self.units / self.scale[:, None]).astype(np.int8)
        coarse = self.bytes * self.scale[:, None]
        self.coarse = np.sqrt((coarse * coarse).sum(1))
        self.error = np.sqrt(((self.units - coarse) ** 2).sum(1))

    def __len__(self) -> int:
        return len(self.units)


def linked(a: Tile, rows: slice, b: Tile, columns: slice, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of the linked pairs of a block of two tiles, and how many pairs were recomputed."""
    product = 0.0
    for at in range(0, a.bytes.shape[1], EXACT):
        dims = slice(at, at + EXACT)
        product = product + a.bytes[rows, dims].astype(np.float32) @ b.bytes[columns, dims].astype(np.float32).T
    product *= a.scale[rows, None].astype(np.float32)
    product *= b.scale[None, columns].astype(np.float32)
    slack = np.outer(a.coarse[rows], b.error[columns]).astype(np.float32)
    slack += (a.error[rows, None] + PAD).astype(np.float32)
    possible = product + slack >= threshold
    i, j = np.nonzero(possible)
    sure = (product[i, j] - slack[i, j]) >= threshold
    open_ = np.flatnonzero(~sure)
    step = max(1, RECOMPUTED // max(a.units.shape[1], 1))
    for at in range(0, len(open_), step):
        own = open_[at:at + step]
        exact = np.einsum("ij,ij->i", a.units[rows][i[own]], b.units[columns][j[own]])
        sure[own] = exact >= threshold
    return i[sure] + rows.start, j[sure] + columns.start, len(open_)


def join_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots (smallest places) after nodes i and j are tied, by hooking the larger root below the smaller and halving paths."""
    while len(i):
        a, b = root[i], root[j]
        differ = a != b
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def compare(a: Tile, b: Tile, same: bool, many_a: np.ndarray, many_b: np.ndarray, threshold: float):
    """Links of two tiles' classes: for each class the vectors it is linked with, and its root among the places of both tiles.

    ``many`` is the number of vectors of each class. A tile with itself (``same``) has every pair once; places of ``b``
    then are those of ``a``.
    """
    shift = 0 if same else len(a)
    count = np.zeros(len(a) + len(b) - (len(a) if same else 0), dtype=np.int64)
    root = np.arange(len(count))
    for r in range(0, len(a), BLOCK):
        for c in range(r if same else 0, len(b), BLOCK):
            i, j, _ = linked(a, slice(r, r + BLOCK), b, slice(c, c + BLOCK), threshold)
            if same:
                upper = i < j
                i, j = i[upper], j[upper]
            # Whole numbers below 2^53, so the sums by bincount are exact.
            count += np.bincount(i, many_b[j], len(count)).astype(np.int64)
            count += np.bincount(j + shift, many_a[i], len(count)).astype(np.int64)
            root = join_roots(root, i, j + shift)
    return count, root


def _numbers(lists: pa.Array) -> np.ndarray:
    return pc.list_flatten(lists).to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _pack(rows: pa.Table) -> pa.Table:
    """One tile: its classes' numbers, sizes and vectors as bytes."""
    vectors = _numbers(rows.column("v").combine_chunks())
    return pa.table({
        "part": rows.column("part").slice(0, 1), "tile": rows.column("tile").slice(0, 1), "tiles": rows.column("tiles").slice(0, 1),
        "ids": [rows.column("id").to_numpy().tobytes()], "many": [rows.column("many").to_numpy().tobytes()],
        "dims": pa.array([vectors.shape[1]], pa.int32()), "vectors": [np.ascontiguousarray(vectors).tobytes()],
    })


def classes(vectors: DataFrame, key: Column, vector: Column, group: Column) -> DataFrame:
    """``part`` (group and length of the vectors), ``v``, and of each such class the rows (``many``) and the ``least`` key."""
    rows = vectors.select(key.cast("long").alias("key"), vector.alias("v"), group.alias("label"))
    return rows.filter(usable(F.col("v")) & F.col("key").isNotNull() & F.col("label").isNotNull()).groupBy(_part(F.col("label"), F.col("v")), "v").agg(
        F.count(F.lit(1)).alias("many"), F.min("key").alias("least")
    )


def _part(group: Column, vector: Column) -> Column:
    return F.concat_ws(":", F.size(vector), group.cast("string")).alias("part")


def usable(vector: Column) -> Column:
    """Neither NULL nor zero, and all entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def tiles(of: DataFrame, scratch: Scratch, tile: int = TILE) -> DataFrame:
    """``part``, number of ``tiles``, ``tile``, and the packed classes of each tile.

    A part has so many tiles that the mean tile is full; the hash of a class's number picks its tile.
    """
    sizes = of.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"))
    rows = F.least(F.lit(tile), F.greatest(F.lit(TILE_BYTES) / (8 * F.col("dims")), F.lit(1.0)))
    # Written, so that its measured size picks the join.
    sizes = scratch.keep(sizes.select(F.col("part").alias("of"), F.ceil(F.col("n") / rows).cast("int").alias("tiles")), "sizes")
    dealt = of.join(sizes, F.col("part") == F.col("of")).select(
        "part", "tiles", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int").alias("tile"), "id", "many", "v"
    )
    return dealt.groupBy("part", "tile").applyInArrow(_pack, "part string, tile int, tiles int, ids binary, many binary, dims int, vectors binary")


def compared(packed_tiles: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """``id``, ``n`` (vectors linked with) and ``root`` of the classes that have links, from every pair of tiles."""
    spark = packed_tiles.sparkSession
    pairs = packed_tiles.agg(F.sum(F.col("tile").cast("long") + 1)).first()[0] or 0
    # Work is counted in pairs, not bytes, so the number of tasks is given and not left to the size of the shuffle.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + pairs // PAIRS)

    def side(name: str, first: Column, last: Column) -> DataFrame:
        own = packed_tiles.withColumn("to", F.explode(F.sequence(first, last)))
        return own.select(*[F.col(c).alias(f"{c}_{name}") for c in ("part", "tile", "to", "ids", "many", "dims", "vectors")])

    left = side("a", F.col("tile"), F.col("tiles") - 1).repartition(tasks, "part_a", "tile_a", "to_a")
    right = side("b", F.lit(0), F.col("tile")).repartition(tasks, "part_b", "to_b", "tile_b")
    joined = left.join(right.hint("merge"), (F.col("part_a") == F.col("part_b")) & (F.col("tile_a") == F.col("to_b")) & (F.col("to_a") == F.col("tile_b")))
    joined = joined.select("tile_a", "tile_b", "ids_a", "many_a", "ids_b", "many_b", "dims_a", "vectors_a", "vectors_b")

    def run(batches):
        read = lambda value, kind="<i8": np.frombuffer(value, dtype=kind)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns)}
                same = row["tile_a"] == row["tile_b"]
                ids_a, ids_b, many_a, many_b = (read(row[c]) for c in ("ids_a", "ids_b", "many_a", "many_b"))
                a = Tile(read(row["vectors_a"], dtype).reshape(-1, row["dims_a"]))
                b = a if same else Tile(read(row["vectors_b"], dtype).reshape(-1, row["dims_a"]))
                count, root = compare(a, b, same, many_a, many_b, threshold)
                ids = ids_a if same else np.concatenate([ids_a, ids_b])
                at = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(count[at]), pa.array(ids[root[at]])], names=["id", "n", "root"]
                )

    return joined.mapInArrow(run, "id long, n long, root long")


def near_duplicates(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", group: str = "label", threshold: float = THRESHOLD, tile: int = TILE,
) -> DataFrame:
    """The rows (as ``row``) with ``n_links`` (other vectors linked directly), ``component_id`` and ``kept``; runs jobs."""
    spark = vectors.sparkSession
    work, scratch = Scratch(spark, "embedding-dedup"), Scratch(spark, "embedding-answers")
    single = vectors.schema[vector].dataType.elementType.typeName() == "float"
    dtype, kind = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    # Numbers are given once: what is written stays, whatever executor is lost.
    found = classes(vectors, F.col(key), F.col(vector).cast(kind), F.col(group)).withColumn("id", F.monotonically_increasing_id())
    found = work.keep(found, "classes")
    links = work.keep(compared(work.keep(tiles(found, work, tile), "tiles"), dtype, threshold), "links")
    roots = connected_components(links.select(F.col("id").alias("a"), F.col("root").alias("b")), work)
    members = found.join(links.groupBy(F.col("id").alias("at")).agg(F.sum("n").alias("n")), F.col("id") == F.col("at"), "left")
    members = members.join(roots.withColumnRenamed("root", "of"), F.col("id") == F.col("node"), "left").select(
        "part", "v", "many", "least", F.coalesce("of", "id").alias("of"), (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links")
    )
    members = members.filter("n_links > 0")  # other classes have nothing to say
    least = members.groupBy(F.col("of").alias("root")).agg(F.min("least").alias("component"))
    answers = members.join(least, F.col("of") == F.col("root")).select(
        F.col("part").alias("of_part"), F.col("v").alias("of_v"), "many", "n_links", "component"
    )
    answers = scratch.keep(answers, "answers")
    work.drop()
    rows = packed(vectors, key=F.col(key).cast("long"), label=F.col(group))
    v = F.col("row").getField(vector).cast(kind)
    part = F.when(usable(v) & F.col("key").isNotNull() & F.col("label").isNotNull(), _part(F.col("label"), v))
    return _told(rows.select("row", "key", part.alias("part")), v, answers).select(
        "row", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "key").alias("component_id"),
        F.coalesce(F.col("component") == F.col("key"), F.lit(True)).alias("kept"),
    )


def _told(rows: DataFrame, v: Column, answers: DataFrame) -> DataFrame:
    """Each row with its class's answer, or NULLs.

    Classes with over a ``SHARE``th of all rows that have an answer are fewer than ``SHARE``, so they are broadcast; of any other, no
    task of the shuffled join gets more than that share.
    """
    total = answers.agg(F.sum("many")).first()[0] or 0
    hot = F.col("many") > total // SHARE
    same = (F.col("part") == F.col("of_part")) & (v == F.col("of_v"))
    wanted = ["row", "key", "n_links", "component"]
    few = rows.join(F.broadcast(answers.filter(hot)), same, "left")
    done = F.col("of_part").isNotNull() | F.col("part").isNull()
    cold = few.filter(~done).drop(*answers.columns).join(answers.filter(~hot), same, "left")
    return few.filter(done).select(*wanted).union(cold.select(*wanted))


def representatives(vectors: DataFrame, **options) -> DataFrame:
    """The rows, with all their columns, that name their component."""
    return near_duplicates(vectors, **options).filter("kept").select("row.*")
