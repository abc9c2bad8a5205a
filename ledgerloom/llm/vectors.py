"""Near-duplicate vectors by tiled comparison in the order of principal components.

Unit vectors are turned onto the principal axes of all vectors (second moments summed on Spark), so leading coordinates
carry most of a product. Sorted by label and the cells of leading coordinates they are cut into blocks, and two blocks
of a label meet only if their boxes over leading coordinates and residual norms leave a cosine at the threshold
possible. A tile of two blocks adds up leading coordinates first; by Cauchy-Schwarz the rest adds at most the product
of the residual norms, and a pair stops as soon as that bound falls below the threshold. Survivors are confirmed by the
cosine of the vectors as given, in double precision.

Equal vectors of a label are one class with a weight. A tile returns counts of links, and one link per vector that
joins it to a component of the tile, so what leaves it grows with its rows. Nothing is capped: a label, cell or group
of any size is cut into blocks, and the blocks that meet one block are dealt to several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import runs
from ledgerloom.llm.workers import arrow_map
from ledgerloom.runtime import durable, lookup_side

# Rows of a block, blocks that meet one block within a task, and meetings of a block made in one task.
BLOCK_ROWS, VISITORS, MEETINGS = 2048, 32, 64
# Leading coordinates that bound blocks, and those of them that order rows.
LEAD, ORDER = 8, 4
# Bounds are computed in floating point and give way by this much; the confirmation does not.
SLACK = 1e-9
# Pairs whose rows are gathered at once when few of a tile are left.
_GATHER = 50_000


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by the largest component first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.diff(batch.column("vector").offsets.to_numpy())
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second moments of a task's vectors, by length."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, part in _by_length(batch):
            x = _unit(_matrix(part.column("vector")))
            sums[size] = sums.get(size, 0) + x.T @ x
    for size, total in sums.items():
        flat = total.reshape(-1)
        columns = [pa.array(np.full(len(flat), size, np.int32)), pa.array(np.arange(len(flat))), pa.array(flat)]
        yield pa.RecordBatch.from_arrays(columns, names=["size", "at", "value"])


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Axes of the second moments, largest first, for each length that occurs. All vectors count; per length only its
    square matrix of sums comes to the driver."""
    sums = arrow_map(vectors.select("vector"), _moments, "size int, at bigint, value double")
    sums = sums.groupBy("size", "at").agg(F.sum("value").alias("value")).orderBy("size", "at").toArrow()
    sizes, values = sums.column("size").to_numpy(), sums.column("value").to_numpy()
    return {int(s): np.linalg.eigh(values[sizes == s].reshape(s, s))[1][:, ::-1].copy() for s in np.unique(sizes)}


def _leads(axes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_length(batch):
                turned = _unit(_matrix(part.column("vector"))) @ axes.value[size]
                lead = np.zeros((len(turned), LEAD + 1))
                lead[:, : min(LEAD, size)] = turned[:, :LEAD]
                lead[:, LEAD] = np.sqrt(np.square(turned[:, LEAD:]).sum(axis=1))
                rows = pa.array(np.arange(len(turned) + 1, dtype=np.int32) * (LEAD + 1))
                columns = [pa.array(np.full(len(turned), size, np.int32)), pa.ListArray.from_arrays(rows, pa.array(lead.reshape(-1)))]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, "size", "lead"])

    return run


def _blocks(block_rows: int):
    """Numbers consecutive rows of one label, length and slab in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = -1, 0
        for opens, part in runs(batches, ["label", "size", "slab"]):
            filled = block_rows if opens else filled
            at = filled + np.arange(part.num_rows)
            over = at // block_rows
            block = number + over
            number, filled = int(block[-1]), int(at[-1] - over[-1] * block_rows) + 1
            task = part.column("task").to_numpy().astype(np.int64) << 32
            yield part.drop_columns(["task"]).append_column("block", pa.array(task | block))

    return run


class _Side:
    """Vectors of one side of a tile: ids, weights, unit rows, turned rows and residual norms after each step."""

    def __init__(self, part: pa.Table, axes: dict[int, np.ndarray]):
        self.ids = part.column("id").to_numpy(zero_copy_only=False)
        self.weights = part.column("weight").to_numpy()
        self.unit = _unit(_matrix(part.column("vector")))
        self.turned = self.unit @ axes[self.unit.shape[1]]
        tails = np.sqrt(np.cumsum(np.square(self.turned[:, ::-1]), axis=1)[:, ::-1])
        self.rest = np.hstack([tails, np.zeros((len(tails), 1))])

    def __len__(self) -> int:
        return len(self.ids)


def _steps(size: int) -> list[int]:
    return sorted({size // 8, size // 4, size // 2} - {0, size})


def tile_links(a: _Side, b: _Side, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (of ``a``, of ``b``) of all pairs with a cosine of at least ``least``."""
    size = a.unit.shape[1]
    product = np.zeros((len(a), len(b)))
    done = 0
    pairs = None
    for step in _steps(size):
        if pairs is None:
            product += a.turned[:, done:step] @ b.turned[:, done:step].T
            open_pairs = product + np.multiply.outer(a.rest[:, step], b.rest[:, step]) >= least - SLACK
            if np.count_nonzero(open_pairs) * 16 <= open_pairs.size:
                pairs = np.nonzero(open_pairs)
                so_far = product[pairs]
        else:
            i, j = pairs
            so_far = so_far + _products(a.turned[:, done:step], b.turned[:, done:step], i, j)
            left = so_far + a.rest[i, step] * b.rest[j, step] >= least - SLACK
            pairs, so_far = (i[left], j[left]), so_far[left]
        if pairs is not None and not len(pairs[0]):
            return pairs
        done = step
    if pairs is None:
        return np.nonzero(a.unit @ b.unit.T >= least)
    i, j = pairs
    found = _products(a.unit, b.unit, i, j) >= least
    return i[found], j[found]


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    parts = [np.einsum("ij,ij->i", a[i[k : k + _GATHER]], b[j[k : k + _GATHER]]) for k in range(0, len(i), _GATHER)]
    return np.concatenate(parts) if parts else np.empty(0)


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining rows ``i`` and ``j``: each component is named by its smallest row number."""
    while True:
        a, b = labels[i], labels[j]
        if (a == b).all():
            return labels
        low = np.minimum(a, b)
        labels = labels.copy()
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        while not np.array_equal(shorter := labels[labels], labels):
            labels = shorter


def _found(ids: np.ndarray, links: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
    met = links > 0
    columns = [pa.array(ids[met], pa.string()), pa.array(links[met]), pa.array(roots[met], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["id", "links", "root"])


def _compare(axes, least: float):
    """Home rows (``visitor`` -1) come first in each unit and are held; visitors stream past them in slices."""

    def close(home: _Side, links: np.ndarray, labels: np.ndarray, own: bool) -> pa.RecordBatch:
        if own:
            i, j = tile_links(home, home, least)
            i, j = i[i != j], j[i != j]
            links = links + np.bincount(i, home.weights[j], len(home)).astype(np.int64)
            labels = merge(labels, i, j)
        return _found(home.ids, links, home.ids[labels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts, home, own = None, [], None, False
        links = labels = np.empty(0, np.int64)
        for _, part in runs(batches, ["home", "chunk", "visitor"]):
            now = (part.column("home")[0].as_py(), part.column("chunk")[0].as_py())
            visits = part.column("visitor")[0].as_py() >= 0
            if now != unit or visits:
                if parts:
                    home = _Side(pa.Table.from_batches(parts), axes.value)
                    links, labels, parts = np.zeros(len(home), np.int64), np.arange(len(home)), []
                if now != unit and unit is not None:
                    yield close(home, links, labels, own)
            unit, own = now, now[1] == 0
            if not visits:
                parts.append(part)
                continue
            for start in range(0, part.num_rows, BLOCK_ROWS):
                guest = _Side(pa.Table.from_batches([part.slice(start, BLOCK_ROWS)]), axes.value)
                i, j = tile_links(home, guest, least)
                links = links + np.bincount(i, guest.weights[j], len(home)).astype(np.int64)
                both = merge(np.concatenate([labels, len(home) + np.arange(len(guest))]), i, len(home) + j)
                labels, roots = both[: len(home)], both[len(home) :]
                met = np.bincount(j, home.weights[i], len(guest)).astype(np.int64)
                yield _found(guest.ids, met, home.ids[np.minimum(roots, len(home) - 1)])
        if parts:
            home = _Side(pa.Table.from_batches(parts), axes.value)
            links, labels = np.zeros(len(home), np.int64), np.arange(len(home))
        if home is not None:
            yield close(home, links, labels, own)

    return run


def _meetings(placed: DataFrame, least: float, width: float) -> DataFrame:
    """``home, visitor`` of all pairs of different blocks that can hold a link."""
    bounds = [f(F.get("lead", F.lit(k))).alias(f"{n}{k}") for k in range(LEAD + 1) for n, f in (("low", F.min), ("high", F.max))]
    boxes = lookup_side(placed.groupBy("label", "size", "slab", "block").agg(*bounds))
    left = boxes.select("*", F.explode(F.array("slab", F.col("slab") + 1)).alias("met")).alias("l")
    right = boxes.alias("r")
    near = left.join(
        right,
        (F.col("l.label") == F.col("r.label")) & (F.col("l.size") == F.col("r.size")) & (F.col("l.met") == F.col("r.slab"))
        & ((F.col("l.met") > F.col("l.slab")) | (F.col("l.block") < F.col("r.block"))),
    )
    gaps = [
        F.greatest(F.lit(0.0), F.col(f"l.low{k}") - F.col(f"r.high{k}"), F.col(f"r.low{k}") - F.col(f"l.high{k}"))
        for k in range(LEAD + 1)
    ]
    distance = reduce(add, [g * g for g in gaps])
    near = near.where(distance <= width * width + SLACK)
    return durable(near.select(F.col("l.block").alias("home"), F.col("r.block").alias("visitor")))


def _dealt(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of each wanted block, once per want. A block wanted often is copied to several keys first."""
    salts = wanted.groupBy("block").agg(F.ceil(F.count("*") / MEETINGS).cast("int").alias("salts"))
    wanted = wanted.join(salts, "block").withColumn("salt", F.pmod(F.xxhash64("home", "chunk"), F.col("salts")).cast("int"))
    copies = salts.select("block", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return rows.join(copies, "block").join(wanted.drop("salts"), ["block", "salt"]).drop("salt", "block")


def link_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``; other columns are left out.

    Two rows are linked when their labels are equal and not null, their vectors have one length, and their cosine is at
    least ``least`` (above 0). A vector that is null, empty, zero or holds null or non-finite components is linked with
    nothing. Every row is a vector of its own: rows of one id are not linked by that, and a repeated row counts as another
    vector at cosine 1. Components are named by their smallest id; a row of null id cannot name one: alone, it gets a
    null component and is kept. ``kept`` rows of a component all carry its name. An empty table gives no rows.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine must be above 0 and at most 1")
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("label").isNotNull() & sound & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("id", F.when(sound, F.md5(F.to_json(F.struct("label", "vector")))))
    classes = (
        rows.where("id IS NOT NULL")
        .groupBy("id")
        .agg(
            F.any_value("label").alias("label"), F.any_value("vector").alias("vector"),
            F.count("*").alias("weight"), F.min("vec_id").alias("least_id"),
        )
    )
    classes = durable(classes)
    axes = spark.sparkContext.broadcast(principal_axes(classes))
    width = max((2 - 2 * least) ** 0.5 + SLACK, 0.01)
    schema = "id string, label string, weight bigint, vector array<double>, size int, lead array<double>"
    leads = arrow_map(classes.select("id", "label", "weight", "vector"), _leads(axes), schema)
    cells = [F.floor(F.get("lead", F.lit(k)) / width).cast("int") for k in range(ORDER)]
    leads = leads.withColumn("slab", cells[0])
    order = ["label", "size", "slab", *cells[1:], "id"]
    sorted_rows = leads.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())
    placed = durable(arrow_map(sorted_rows, _blocks(BLOCK_ROWS), f"{schema}, slab int, block bigint"))
    meetings = _meetings(placed, least, width)
    chunks = meetings.groupBy("home").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("chunks"))
    visits = meetings.join(chunks, "home").select(
        F.col("visitor").alias("block"), "home", F.pmod(F.xxhash64("visitor"), F.col("chunks")).cast("int").alias("chunk"), "visitor"
    )
    homes = placed.select(F.col("block").alias("home")).distinct().join(chunks, "home", "left")
    homes = homes.select(
        F.col("home").alias("block"), "home", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("chunk"),
        F.lit(-1).cast("bigint").alias("visitor"),
    )
    tiles = _dealt(placed.select("id", "weight", "vector", "block"), durable(homes.unionByName(visits)))
    tiles = tiles.repartition("home", "chunk").sortWithinPartitions("home", "chunk", "visitor")
    found = durable(arrow_map(tiles, _compare(axes, least), "id string, links bigint, root string"))
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    facts = classes.select("id", "weight", "least_id").join(sums, "id", "left").join(named, "id", "left")
    facts = facts.withColumn("component", F.coalesce("component", "id"))
    names = facts.groupBy("component").agg(F.min("least_id").alias("component_id"))
    facts = facts.join(names, "component").select("id", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    joined = rows.select("vec_id", "id").join(facts, "id", "left")
    component = F.when(F.col("id").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )
