"""Near-duplicate vectors: collisions counted in windows of sorted one-dimensional projections."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as T
from tidemark.llm.components import components, local_roots
from tidemark.llm.joins import lookup
from tidemark.operators.keyed_join import fits_broadcast
from tidemark.sources.storage import scratch_path

#: Query rows whose collisions are counted together, and pairs compared together.
TILE, PAIRS = 64, 100_000
_OUT = "node bigint, links bigint, root bigint"


def _same_cell(spread: float, width: float) -> float:
    """Chance that two values whose difference is normal share a cell of a randomly shifted grid."""
    z = width / spread
    return math.erf(z / math.sqrt(2)) - math.sqrt(2 / math.pi) / z * (1 - math.exp(-z * z / 2))


@dataclass(frozen=True)
class Projections:
    """How pairs with a cosine of ``cosine`` or more are found.

    A pair at the bound differs by a normal value of known spread on every
    random direction, and by less when it is closer. So the chance of a
    collision in a window of ``reach`` spreads around the query is known, and
    ``least`` is the largest count of collisions on ``lines`` directions that a
    pair at the bound reaches with a chance of ``recall``.

    Windows over a whole label make a fixed share of its pairs collide. Labels
    of more than ``cell_rows`` vectors are therefore dealt to cells of grids,
    each on a few directions of its own with cells ``width`` wide: so many
    directions that unrelated vectors fill ``cell_rows`` rows, and so many grids
    that a pair at the bound shares a cell of one with a chance of ``recall``.
    Cells of more than ``block_rows`` rows are compared block by block.
    """

    cosine: float = 0.93
    recall: float = 0.9999
    lines: int = 24
    reach: float = 1.5
    width: float = 2.0
    cell_rows: int = 8192
    block_rows: int = 8192
    seed: int = 0

    def __post_init__(self):
        if not -1 < self.cosine < 1 or not 0 < self.recall < 1:
            raise ValueError("cosine must be within -1 and 1, recall within 0 and 1")
        if not 1 <= self.lines <= 255 or not 2 <= self.block_rows < 1 << 16 or self.cell_rows < 2:
            raise ValueError("lines must be 1 to 255, block_rows 2 to 65535, cell_rows 2 or more")

    @property
    def spread(self) -> float:
        return math.sqrt(2 - 2 * self.cosine)

    @property
    def window(self) -> float:
        return self.reach * self.spread

    @property
    def least(self) -> int:
        hit, missed = math.erf(self.reach / math.sqrt(2)), 0.0
        for n in range(self.lines + 1):
            missed += math.comb(self.lines, n) * hit**n * (1 - hit) ** (self.lines - n)
            if missed > 1 - self.recall:
                return n
        return self.lines

    def directions(self, rows: int) -> int:
        """Directions of each grid for a label of so many vectors."""
        if rows <= self.cell_rows:
            return 0
        return math.ceil(math.log(rows / self.cell_rows) / -math.log(_same_cell(math.sqrt(2), self.width)))

    def grids(self, directions: int) -> int:
        if not directions:
            return 1
        both = _same_cell(self.spread, self.width) ** directions
        return math.ceil(math.log(1 - self.recall) / math.log(1 - both))

    def codes(self, unit: np.ndarray, directions: int) -> np.ndarray:
        """The cell of each unit vector in every grid, as a hash of 32 bits."""
        out = np.zeros((len(unit), self.grids(directions)), np.int32)
        for grid in range(out.shape[1] if directions else 0):
            draw = np.random.default_rng((self.seed, 1, unit.shape[1], grid))
            lines = draw.standard_normal((unit.shape[1], directions))
            shift = draw.uniform(0, self.width, directions)
            at = np.floor((unit @ lines + shift) / self.width).astype(np.int64).astype(np.uint64)
            h = np.full(len(unit), grid + 1, np.uint64)
            for column in at.T:
                h = T.mix(h * np.uint64(0x9E3779B97F4A7C15) + column)
            out[:, grid] = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return out

    def project(self, unit: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng((self.seed, 0, unit.shape[1]))
        return unit @ draw.standard_normal((unit.shape[1], self.lines))


def _unit(values: np.ndarray) -> np.ndarray | None:
    """The vector at length one; None where it has no direction."""
    most = np.abs(values).max(initial=0)
    if not (0 < most < np.inf) or not np.isfinite(values).all():
        return None
    values = values / most
    # Zeros of either sign are one value.
    return values / np.sqrt(values @ values) + 0.0


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """``vec_id``, ``label``, ``unit`` (bytes of the unit vector) and ``key`` (its digest); both null where nothing links."""
    label = F.col(label_col) if label_col else F.lit(0)
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), label.alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    kind = rows.schema["label"].dataType.simpleString()

    def prepare(batches):
        for batch in T.slices(batches, 4096):
            column = batch.column(2)
            values = column.values.to_numpy(zero_copy_only=False)
            holes = column.values.is_null().to_numpy(zero_copy_only=False)
            offsets = column.offsets.to_numpy()
            units = []
            for i, (there, named) in enumerate(zip(column.is_valid().to_pylist(), batch.column(1).is_valid().to_pylist())):
                at = slice(offsets[i], offsets[i + 1])
                found = _unit(values[at]) if there and named and not holes[at].any() else None
                units.append(None if found is None else found.tobytes())
            keys = [None if u is None else hashlib.sha256(u).digest()[:16] for u in units]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(units, pa.binary()), pa.array(keys, pa.binary())],
                ["vec_id", "label", "unit", "key"],
            )

    at = scratch_path(vectors.sparkSession, "vectors")
    rows.mapInArrow(prepare, f"vec_id bigint, label {kind}, unit binary, key binary").write.parquet(at)
    return vectors.sparkSession.read.parquet(at)


def _celled(classes: DataFrame, how: Projections) -> DataFrame:
    """The classes, once for each grid and block pair they meet others in."""
    sizes = classes.groupBy("label").agg(F.count("*").alias("size"))
    sizes = F.broadcast(sizes) if fits_broadcast(sizes) else sizes
    rows = classes.join(sizes, "label").select("label", "node", "weight", "unit", "size")
    kind = classes.schema["label"].dataType.simpleString()

    def cells(batches):
        for batch in batches:
            units, sizes = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            codes: list = [None] * len(units)
            groups: dict[tuple[int, int], list[int]] = {}
            for i, (unit, size) in enumerate(zip(units, sizes)):
                groups.setdefault((len(unit), how.directions(size)), []).append(i)
            for (_, directions), at in groups.items():
                found = how.codes(_matrix([units[i] for i in at]), directions)
                for i, row in zip(at, found):
                    codes[i] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(codes, pa.list_(pa.int32()))], ["label", "node", "weight", "unit", "codes"]
            )

    celled = rows.mapInArrow(cells, f"label {kind}, node bigint, weight bigint, unit binary, codes array<int>")
    celled = celled.select("*", F.posexplode("codes").alias("grid", "cell"))
    celled = celled.withColumn("length", F.octet_length("unit"))
    cell = ["label", "length", "grid", "cell"]
    parts = F.ceil(F.col("n") / how.block_rows).cast("int").alias("parts")
    large = celled.groupBy(*cell).agg(F.count("*").alias("n")).where(F.col("n") > how.block_rows).select(*cell, parts)
    large = F.broadcast(large) if fits_broadcast(large) else large
    celled = celled.join(large, cell, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    celled = celled.withColumn("mine", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    celled = celled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return celled.select(
        *cell, F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
        (F.col("mine") > F.col("other")).alias("second"), "node", "weight", "unit", "codes",
    )


def _matrix(units: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


class _Side:
    def __init__(self, table: pa.Table, how: Projections):
        self.node = table["node"].to_numpy()
        self.weight = table["weight"].to_numpy()
        self.unit = _matrix(table["unit"].to_pylist())
        self.codes = np.array(table["codes"].to_pylist(), np.int32)
        self.at = how.project(self.unit)
        self.links = np.zeros(len(self.node))

    def sort(self) -> None:
        """Every projection sorted, and the rank of each row on it."""
        order = np.argsort(self.at, axis=0)
        self.sorted = np.take_along_axis(self.at, order, axis=0)
        self.rank = np.empty(order.T.shape, np.uint16)
        np.put_along_axis(self.rank, order.T, np.arange(len(order), dtype=np.uint16)[None, :], axis=1)

    def windows(self, at: np.ndarray, window: float) -> tuple[np.ndarray, np.ndarray]:
        """For queries and each projection, the first rank in the window around the query, and the ranks in it."""
        low = np.empty(at.shape, np.uint16)
        span = np.empty(at.shape, np.uint16)
        for j, line in enumerate(self.sorted.T):
            first = np.searchsorted(line, at[:, j] - window, "left")
            low[:, j] = first
            span[:, j] = np.searchsorted(line, at[:, j] + window, "right") - first
        return low, span


def _links(grid: int, one: _Side, two: _Side, how: Projections) -> np.ndarray:
    """Counts links between two sides (or within one) into them; the local root of every row of both."""
    alone = one is two
    two.sort()
    low, span = two.windows(one.at, how.window)
    shift = 0 if alone else len(one.node)
    root = np.arange(shift + len(two.node))
    least = how.least
    for start in range(0, len(one.node), TILE):
        rows = slice(start, start + TILE)
        first = start if alone else 0
        counts = np.zeros((len(one.node[rows]), len(two.node) - first), np.uint8)
        for j, rank in enumerate(two.rank):
            # Ranks before the window wrap around, so one comparison tells both ends.
            counts += (rank[first:] - low[rows, j, None]) < span[rows, j, None]
        i, k = np.nonzero(counts >= least)
        i, k = i + start, k + first
        if alone:
            i, k = i[i < k], k[i < k]
        for part in range(0, len(i), PAIRS):
            a, b = i[part : part + PAIRS], k[part : part + PAIRS]
            near = np.einsum("ij,ij->i", one.unit[a], two.unit[b]) >= how.cosine
            a, b = a[near], b[near]
            if grid and len(a):  # a pair counts in the first grid where it shares a cell
                fresh = ~(one.codes[a, :grid] == two.codes[b, :grid]).any(1)
                a, b = a[fresh], b[fresh]
            if not len(a):
                continue
            one.links += np.bincount(a, two.weight[b], len(one.node))
            two.links += np.bincount(b, one.weight[a], len(two.node))
            root = local_roots(len(root), root[a], root[b + shift])[root]
    return root


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    how: Projections | None = None,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows link when their labels are equal and their cosine, in double precision,
    reaches the bound. ``n_links`` counts the other rows a row links to,
    ``component_id`` is the smallest id it reaches over links, itself included;
    ``kept`` rows are those with that id.

    Rows with one label and direction are one class with its number of rows, so
    common vectors cost one. Classes meet in cells (see ``Projections``); inside,
    collisions in the windows of sorted projections are counted for each pair,
    and pairs that reach the calibrated count are compared. A pair counts in the
    first grid where it shares a cell. A task emits, for each class, the rows it
    links to there and one link to its local root, not the pairs. A group of s
    near copies that are not equal still costs s * s / 2 comparisons, in blocks
    over all tasks; its classes are copied once for each block of the group.

    Without ``label_col`` all rows are compared. Rows with a null label, or a
    vector that is null, empty, zero or holds a null or non-finite value, link
    with nothing and are components of their own, as are vectors of different
    length. Null ids take part but are nobody's component id while there is
    another; their rows are not kept. Repeated rows stay, link to each other and
    are kept alike. An empty table gives no rows.
    """
    how = how or Projections()
    rows = _prepared(vectors, id_col, vector_col, label_col)
    classes = rows.where("unit IS NOT NULL").groupBy("label", "key", "unit").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least")
    )
    classes = classes.withColumn("node", F.monotonically_increasing_id()).checkpoint()

    def count(table: pa.Table) -> pa.Table:
        grid, alone = table["grid"][0].as_py(), table["a"][0].as_py() == table["b"][0].as_py()
        second = table["second"].to_numpy(zero_copy_only=False)
        one = _Side(table.filter(pa.array(~second)), how) if not second.all() else None
        two = one if alone else _Side(table.filter(pa.array(second)), how) if second.any() else None
        if one is None or two is None:
            return pa.table({"node": [], "links": [], "root": []}, pa.schema([(c, pa.int64()) for c in ("node", "links", "root")]))
        root = _links(grid, one, two, how)
        node = one.node if alone else np.concatenate([one.node, two.node])
        links = one.links if alone else np.concatenate([one.links, two.links])
        found = links > 0
        return pa.table({"node": node[found], "links": links[found].astype(np.int64), "root": node[root][found]})

    meeting = _celled(classes, how).groupBy("label", "length", "grid", "cell", "a", "b")
    linked = meeting.applyInArrow(count, _OUT).checkpoint()
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(linked, "node", "root")
    classes = classes.select("label", "key", "node", "weight", "least").join(links, "node", "left")
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).checkpoint()
    least = classes.groupBy("root").agg(F.min("least").alias("component_id")).checkpoint()
    known = lookup(classes.drop("least"), least, ["root"]).select(
        "label", "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    ).checkpoint()
    found = lookup(rows.select("vec_id", "label", "key"), known, ["key", "label"])
    lone = F.col("n_links").isNull()
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(lone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(lone, F.col("vec_id").isNotNull()).otherwise(F.col("vec_id") == F.col("component_id")), F.lit(False)).alias("kept"),
    )
