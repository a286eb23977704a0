r"""Near-duplicates of embeddings by int8 tile products with rigorous error bounds.

Each vector is brought to length 1, u, and quantised: u = s q + r with q in int8, a scale s of its own and
the length e of the rest r. For two vectors |u.w - s_u s_w (q_u.q_w)| <= e_u + e_w + e_u e_w, so the integer
product plus that bound is an upper bound of their cosine. Only pairs whose upper bound reaches the threshold are
computed again, in double precision, from the vectors as they came.

Vectors of one label with more than a block are dealt out in cells first: some of them, chosen far apart from a sample four
times as large, are pivots, and a vector is at home with the pivot p of largest product. Two vectors of length 1 with cosine t are sqrt(2 - 2t) apart. If x and y are that near
and y is at home with q, then y.(q - p) >= 0, so x.(p - q) <= sqrt(2 - 2t) |p - q|: x is a guest in such cells q > p, and in no
other is anything near it. Rounding is within `SLACK`, and what does not compare (NaN) is a guest.

The homes of a cell are dealt out in blocks, and so are its guests; a task multiplies a block of homes with another block. So
vectors in groups of more than about `PER_PIVOT` are shuffled in proportion to their number, as long as pivots are not at
their limit of `PIVOTS` a label; vectors spread evenly in many dimensions are guests in up to half of the cells, and
beyond the limit a cell is a share of its label: then work grows with the square of a label.

Equal vectors are one row, and pairs never leave a task: it returns, per vector, how many it is linked with and the
smallest member of the group it sees. Groups are then joined as connected components.

Defined cases: a NULL label, a vector that is NULL, empty, zero or holds NULL or non-finite components, and
vectors of different lengths link with nothing; a NULL vec_id takes no part and has a NULL component; rows
that repeat an id are one vector with the links of all; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfstrata.llm.common import checkpoint, ship_code, table
from shelfstrata.llm.components import components
from shelfstrata.llm.runs import grouped, whole_runs

THRESHOLD = 0.98
BLOCK = 1024
#: Dimensions whose products of int8 values a float32 sum holds exactly.
EXACT = 1024
#: What rounding in double precision can add to a bound.
ROUNDING = 1e-9

#: Vectors of a label for each of its pivots, and the most pivots of a label.
PER_PIVOT = 512
PIVOTS = 1024
#: Vectors drawn for each pivot that is chosen of them.
DRAWN = 4
#: Vectors whose cells are looked up together.
PART = 4096
#: More than rounding can change in a product of vectors of length 1, or in the distance of two pivots.
SLACK = 1e-7

GROUP = ("label", "dims", "part")
TILE = ("label", "dims", "cell", "low", "high")


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of `v` as int8 values, scale, error bound, and length."""
    length = np.sqrt((v * v).sum(axis=1))
    u = v / length[:, None]
    scale = np.abs(u).max(axis=1) / 127.0
    q = np.rint(u / scale[:, None])
    error = np.sqrt(((u - scale[:, None] * q) ** 2).sum(axis=1)) + ROUNDING
    return q.astype(np.int8), scale, error, length


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of rows of int8 values."""
    total = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], EXACT):
        total += a[:, d : d + EXACT].astype(np.float32) @ b[:, d : d + EXACT].astype(np.float32).T
    return total


def similar_pairs(v: np.ndarray, w: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of v, row of w) whose cosine reaches `threshold`."""
    q, s, e, n = quantised(v)
    p, t, f, m = quantised(w)
    bound = int8_products(q, p) * s[:, None] * t + e[:, None] + f + e[:, None] * f
    i, j = np.nonzero(bound >= threshold)
    keep = np.zeros(len(i), dtype=bool)
    for k in range(0, len(i), 1 << 15):
        a, b = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
        keep[k : k + (1 << 15)] = (v[a] * w[b]).sum(axis=1) / (n[a] * m[b]) >= threshold
    return i[keep], j[keep]


def _vectors(rows: pa.Table, dims: int) -> np.ndarray:
    flat = rows.column("embedding").combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def cells(v: np.ndarray, pivots: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Per row of `v` the pivot it is at home with, and a row of booleans: the later pivots it is a guest of."""
    u = v / np.sqrt((v * v).sum(axis=1))[:, None]
    p = pivots / np.sqrt((pivots * pivots).sum(axis=1))[:, None]
    products = u @ p.T
    home = products.argmax(axis=1)
    apart = np.sqrt(np.maximum(2.0 - 2.0 * (p @ p.T), 0.0))
    reach = np.sqrt(2.0 - 2.0 * threshold)
    ahead = products[np.arange(len(v)), home][:, None] - products
    guest = ~(ahead > reach * apart[home] + SLACK)
    return home, guest & (np.arange(len(p)) > home[:, None])


def far_apart(v: np.ndarray, wanted: int) -> np.ndarray:
    """Row numbers of `wanted` vectors, each the one least similar to those before it."""
    with np.errstate(all="ignore"):
        u = v / np.sqrt((v * v).sum(axis=1))[:, None]
    usable = np.flatnonzero(np.isfinite(u).all(axis=1) & u.any(axis=1))
    u = u[usable]
    chosen, nearest = [], np.full(len(u), -np.inf)
    for _ in range(min(wanted, len(u))):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, u @ u[chosen[-1]])
    return usable[chosen]


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in whole_runs(batches, "label", "dims"):
        for start, end in zip(starts, starts[1:]):
            group = rows.slice(start, end - start)
            dims, wanted = group.column("dims")[0].as_py(), group.column("wanted")[0].as_py()
            v = _vectors(group, dims)
            # By content, so that a task that runs again chooses alike.
            v = v[np.lexsort(v.T[::-1])]
            v = v[far_apart(v, wanted)]
            n = len(v)
            kept = [pa.array(np.full(n, group.column("label")[0].as_py())), pa.array(np.full(n, dims, dtype=np.int32)), pa.array(list(v), pa.list_(pa.float64())), pa.array(np.arange(n, dtype=np.int32))]
            yield pa.RecordBatch.from_arrays(kept, ["label", "dims", "embedding", "pivot"])


def _housed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in whole_runs(batches, *GROUP):
        for start, end in zip(starts, starts[1:]):
            group = rows.slice(start, end - start)
            place = group.column("pivot").to_numpy()
            members = group.filter(pa.array(place < 0))
            pivots = group.filter(pa.array(place >= 0))
            if not members.num_rows:
                continue
            home, guests = np.zeros(members.num_rows, dtype=np.int64), [[]] * members.num_rows
            if pivots.num_rows:
                dims = group.column("dims")[0].as_py()
                order = np.argsort(pivots.column("pivot").to_numpy())
                with np.errstate(all="ignore"):
                    home, guest = cells(_vectors(members, dims), _vectors(pivots, dims)[order])
                guests = [np.flatnonzero(row).tolist() for row in guest]
            kept = [members.column(c).combine_chunks() for c in ("label", "dims", "rep", "copies", "embedding")]
            kept += [pa.array(home.astype(np.int32)), pa.array(guests, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(kept, ["label", "dims", "rep", "copies", "embedding", "home", "guests"])


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in whole_runs(batches, *TILE):
        for start, end in zip(starts, starts[1:]):
            tile = rows.slice(start, end - start)
            rep, copies = tile.column("rep").to_numpy(), tile.column("copies").to_numpy()
            dims, low, high = (tile.column(c)[0].as_py() for c in ("dims", "low", "high"))
            v = _vectors(tile, dims)
            order = np.argsort(rep, kind="stable")
            rep, copies, v, side = rep[order], copies[order], v[order], tile.column("side").to_numpy()[order]
            left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
            if not len(left) or not len(right):
                continue
            i, j = similar_pairs(v[left], v[right])
            i, j = left[i], right[j]
            if low == high:
                i, j = i[i < j], j[i < j]
            links, parent = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            for x, y in zip(i.tolist(), j.tolist()):
                a, b = _root(parent, x), _root(parent, y)
                parent[max(a, b)] = min(a, b)
            linked = np.flatnonzero(links)
            roots = np.array([_root(parent, x) for x in linked], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(links[linked]), pa.array(rep[roots])], ["rep", "links", "root"])


def _cells_of(classes: DataFrame) -> DataFrame:
    """`classes` with the cell each is at home in and those it is a guest in."""
    sizes = classes.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("members"))
    wanted = F.least(F.ceil(F.col("members") / PER_PIVOT), F.lit(PIVOTS))
    sizes = sizes.select("label", "dims", "members", F.ceil(F.col("members") / PART).alias("parts"), wanted.alias("wanted"))
    sized = classes.join(sizes, ["label", "dims"])
    # At least one in `every` may be drawn, and of a label at most what its pivots are chosen of.
    every = F.greatest(F.floor(F.col("members") / (F.col("wanted") * DRAWN)), F.lit(1))
    place = F.row_number().over(Window.partitionBy("label", "dims").orderBy(F.xxhash64("embedding", F.lit(2)), "embedding"))
    drawn = sized.where(F.col("members") > BLOCK).where(F.pmod(F.xxhash64("embedding"), every) == 0).withColumn("place", place)
    drawn = drawn.where(F.col("place") <= DRAWN * PIVOTS).select("label", "dims", "embedding", "wanted")
    pivots = grouped(drawn, "label", "dims").mapInArrow(_chosen, "label long, dims int, embedding array<double>, pivot int")
    pivots = pivots.join(sizes.select("label", "dims", "parts"), ["label", "dims"])
    # Each part of a label meets its pivots.
    spread = pivots.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    members = sized.withColumn("part", F.pmod(F.xxhash64("embedding", F.lit(1)), "parts")).withColumn("pivot", F.lit(-1))
    columns = [*GROUP, "embedding", "pivot"]
    members = members.select(*columns, "rep", "copies")
    both = grouped(members.unionByName(spread.select(columns), allowMissingColumns=True), *GROUP)
    schema = "label long, dims int, rep long, copies long, embedding array<double>, home int, guests array<int>"
    return checkpoint(both.mapInArrow(_housed, schema))


def _tiles(housed: DataFrame) -> DataFrame:
    """A row for each vector and tile: the pairs of blocks of a cell of which one at least holds homes."""
    columns = ["label", "dims", "rep", "copies", "embedding", "cell"]
    homes = housed.withColumn("cell", F.col("home")).select(columns)
    guests = housed.withColumn("cell", F.explode("guests")).select(columns)
    cell = ["label", "dims", "cell"]
    counts = housed.select("label", "dims", F.col("home").alias("cell"), F.lit(1).alias("home")).unionByName(
        housed.select("label", "dims", F.explode("guests").alias("cell"), F.lit(0).alias("home"))
    ).groupBy(cell).agg(F.sum("home").alias("homes"), F.sum(1 - F.col("home")).alias("visits"))
    blocks = [F.ceil(F.col(c) / BLOCK).cast("int").alias(b) for c, b in (("homes", "h"), ("visits", "g"))]
    # A cell without homes has nothing to compare.
    counts = counts.where("homes > 0").select(*cell, *blocks)
    at = lambda blocks: F.pmod(F.xxhash64("embedding"), blocks).cast("int")
    homes = homes.join(counts, cell).withColumn("side", at(F.col("h")))
    homes = homes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("h") + F.col("g") - 1)))
    guests = guests.join(counts, cell).withColumn("side", F.col("h") + at(F.col("g")))
    guests = guests.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("h") - 1)))
    tiled = homes.unionByName(guests).withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
    return tiled.select(*TILE, "side", "rep", "copies", "embedding")


def near_duplicate_vectors(vectors: DataFrame) -> DataFrame:
    """Per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    ship_code(vectors.sparkSession)
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where("vec_id is not null and label is not null and embedding is not null").where(finite)
    usable = usable.where(F.exists("embedding", lambda x: x != 0))
    # -0.0 equals 0.0 but is another key.
    usable = usable.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"))
    classes = checkpoint(classes.withColumn("dims", F.size("embedding")))
    tiled = _tiles(_cells_of(classes))
    found = checkpoint(grouped(tiled, *TILE).mapInArrow(_linked, "rep long, links long, root long"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    judged = classes.join(links, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    judged = judged.select("label", "embedding", "rep", "copies", "links", "component")
    members = usable.distinct().join(judged, ["label", "embedding"]).groupBy("vec_id")
    members = members.agg(
        F.min(F.coalesce("component", "rep")).alias("component"),
        F.sum(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    joined = rows.select("vec_id").join(members, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


#: Every pair of a label, and groups by following links.
OP8_SQL = """
with recursive usable as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where label is not null and embedding is not null and vec_id is not null
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
pairs as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
  on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98),
reach as (select vec_id as node, vec_id as seen from embeddings union select r.node, p.b from reach r join pairs p on r.seen = p.a),
links as (select a as vec_id, count(*) as n_links from pairs group by a),
groups as (select node as vec_id, min(seen) as component_id from reach group by node)
select vec_id, coalesce(n_links, 0) as n_links, component_id, component_id = vec_id as kept
from embeddings left join links using (vec_id) left join groups using (vec_id)
"""
