"""Embedding near-duplicates: a subspace pigeonhole join, exact in double precision.

Unit vectors with a cosine of ``t`` or more are within a squared distance of ``2 - 2 t``.  They are
rotated to principal axes and cut into blocks of ``BLOCK`` axes; each block gets a part of the
squared distance in proportion to its variance.  If two vectors are within the whole budget, some
block is within its own: so a pair is a candidate if any block's range join has it, and every
candidate's cosine is computed again from the given numbers in double precision.

Vectors are dealt to cells by a tree of median cuts along the widest axes.  Two cells meet if for
some block the boxes around their members are within that block's budget.  Large cells are dealt
into parts by a hash, and each pair of parts is a task; it gives the number of links of each vector
and a spanning forest, never the pairs.  Rotation and cuts come from at most ``SAMPLE`` vectors and
decide about speed alone.  Equal vectors are compared once and counted.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import checkpoint, typed, written
from postsieve.llm.graph import components, forest

BLOCK = 8
SAMPLE = 20_000
#: Vectors of one side of a task.
PART = 4096
#: Cells, at most: boxes of cells are compared on the driver.
CELLS = 1024
#: What 32-bit arithmetic may be off in a squared distance of unit vectors.
SLACK = 1e-4


class Subspaces:
    """Rotation, blocks with their budgets, and the tree of cuts."""

    def __init__(self, sample, budget: float, count: int):
        import numpy as np

        unit = sample / np.linalg.norm(sample, axis=1)[:, None]
        variance, axes = np.linalg.eigh(unit.T @ unit / len(unit))
        variance, axes = np.maximum(variance[::-1], 1e-12), axes[:, ::-1]
        dims = len(variance)
        blocks = -(-dims // BLOCK)
        self.rotation = axes
        # Axes are dealt like cards, so each block has wide and narrow ones.
        self.blocks = [np.arange(b, dims, blocks) for b in range(blocks)]
        self.budgets = [budget * variance[b].sum() / variance.sum() for b in self.blocks]
        depth = 0
        while 2 << depth <= CELLS and count / (1 << depth) > PART * 0.8 and depth < dims:
            depth += 1
        self.depth = depth
        turned = unit @ axes
        self.cuts, cell = [], np.zeros(len(turned), np.int64)
        for level in range(depth):
            cuts = np.zeros(1 << level)
            for k in range(1 << level):
                own = turned[cell == k, level]
                cuts[k] = np.median(own) if len(own) else 0.0
            self.cuts.append(cuts)
            cell = cell * 2 + (turned[:, level] > cuts[cell])

    def turned(self, vectors):
        import numpy as np

        return (vectors / np.linalg.norm(vectors, axis=1)[:, None]) @ self.rotation

    def cells(self, turned):
        import numpy as np

        cell = np.zeros(len(turned), np.int64)
        for level, cuts in enumerate(self.cuts):
            cell = cell * 2 + (turned[:, level] > cuts[cell])
        return cell

    def neighbours(self, low, high):
        """Index pairs ``i <= j`` of the boxes that some block's budget brings together."""
        import numpy as np

        pairs = []
        for i in range(len(low)):
            gap = np.maximum(0, np.maximum(low[i] - high[i:], low[i:] - high[i])) ** 2
            near = np.zeros(len(gap), bool)
            for axes, budget in zip(self.blocks, self.budgets):
                near |= gap[:, axes].sum(axis=1) <= budget + SLACK
            pairs += [(i, i + int(j)) for j in np.flatnonzero(near)]
        return pairs

    def candidates(self, left, right):
        """Index arrays of the pairs of rotated vectors in some block's range, near enough in all."""
        import numpy as np

        left, right = left.astype(np.float32), right.astype(np.float32)
        total = np.float32(sum(self.budgets) + SLACK)
        sides = []
        for axes, budget in zip(self.blocks, self.budgets):
            a, b = np.ascontiguousarray(left[:, axes]), np.ascontiguousarray(right[:, axes].T)
            sides.append((a * -2, b, (a * a).sum(1)[:, None], (b * b).sum(0)[None, :], np.float32(budget + SLACK)))
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first in range(0, len(left), 128):
            rows = slice(first, first + 128)
            hit, whole = None, None
            for a, b, norm_a, norm_b, budget in sides:
                distance = a[rows] @ b
                distance += norm_a[rows]
                distance += norm_b
                near = distance <= budget
                hit, whole = (near, distance) if hit is None else (hit | near, whole + distance)
            i, j = np.nonzero(hit & (whole <= total))
            found_a.append(i + first)
            found_b.append(j)
        return np.concatenate(found_a), np.concatenate(found_b)


def _prepare(vectors: DataFrame) -> tuple[DataFrame, str]:
    """``uid``, ``vec_id``, ``packed`` (bytes, NULL if no vector to compare), written once."""
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    rows = typed(vectors, vec_id="long", embedding="array<float>" if kind == "<f4" else "array<double>")

    def run(batches):
        import numpy as np

        for batch in batches:
            packed = []
            for values in batch.column(2).to_pylist():
                numbers = None
                if values and None not in values:
                    numbers = np.array(values, kind)
                    wide = numbers.astype(np.float64)
                    # A norm that overflows or vanishes has no direction in double precision.
                    norm = np.linalg.norm(wide)
                    if not np.isfinite(wide).all() or not np.isfinite(norm) or norm == 0:
                        numbers = None
                packed.append(None if numbers is None else numbers.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["uid", "vec_id", "packed"]
            )

    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "embedding")
    return written(rows.mapInArrow(run, "uid long, vec_id long, packed binary"), "vectors"), kind


def _links(reps: DataFrame, kind: str, least: float) -> DataFrame | None:
    """``uid``, ``n``, ``root`` from every task that has links of a vector."""
    import numpy as np

    sample = reps.select("packed").orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).collect()
    if not sample:
        return None
    first = np.array([np.frombuffer(r[0], kind) for r in sample], np.float64)
    spaces = Subspaces(first, 2 - 2 * least, reps.count())
    spark = reps.sparkSession
    shared = spark.sparkContext.broadcast(spaces)

    def matrix(column):
        return np.array([np.frombuffer(x, kind) for x in column.to_pylist()], np.float64)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                cell = shared.value.cells(shared.value.turned(matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["uid", "packed", "copies", "cell"])

    placed = checkpoint(reps.select("uid", "packed", "copies").mapInArrow(place, "uid long, packed binary, copies long, cell long"))

    def box(batches):
        low, high, count = {}, {}, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            turned, cell = shared.value.turned(matrix(batch.column(0))), batch.column(1).to_numpy()
            for k in np.unique(cell).tolist():
                own = turned[cell == k]
                count[k] = count.get(k, 0) + len(own)
                low[k] = np.minimum(low.get(k, np.inf), own.min(axis=0))
                high[k] = np.maximum(high.get(k, -np.inf), own.max(axis=0))
        for k in count:
            row = [[k], [count[k]], [low[k].tolist()], [high[k].tolist()]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["cell", "n", "low", "high"])

    kinds = "cell long, n long, low array<double>, high array<double>"
    boxes = placed.select("packed", "cell").mapInArrow(box, kinds)
    worst = lambda pick, name: F.array(*[pick(F.col(name)[i]) for i in range(first.shape[1])]).alias(name)
    # One row a cell, and no more than CELLS of them.
    boxes = sorted(boxes.groupBy("cell").agg(F.sum("n").alias("n"), worst(F.min, "low"), worst(F.max, "high")).collect())
    parts = {b["cell"]: -(-b["n"] // PART) for b in boxes}
    near = spaces.neighbours(np.array([b["low"] for b in boxes]), np.array([b["high"] for b in boxes]))
    targets: dict[int, list] = {b["cell"]: [] for b in boxes}
    for i, j in near:
        a, b = boxes[i]["cell"], boxes[j]["cell"]
        targets[a].append((a, b, 0, parts[b]))
        if a != b:
            targets[b].append((a, b, 1, parts[a]))
    rows = [(k, parts[k], *t) for k, own in targets.items() for t in own]
    table = spark.createDataFrame(rows, "cell long, parts long, a long, b long, side int, others long")
    # Of a pair of parts of one cell, both sides are the same part or the smaller number is left.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
    dealt = (
        placed.join(F.broadcast(table), "cell")
        .withColumn("part", F.pmod(F.xxhash64("uid", F.lit(3)), F.col("parts")))
        .withColumn("other", other)
        .withColumn("p", F.when(F.col("a") == F.col("b"), F.least("part", "other")).when(F.col("side") == 0, F.col("part")).otherwise(F.col("other")))
        .withColumn("q", F.when(F.col("a") == F.col("b"), F.greatest("part", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("part")))
        .withColumn("left", F.when(F.col("a") == F.col("b"), F.col("part") == F.col("p")).otherwise(F.col("side") == 0))
        .select("a", "b", "p", "q", "left", "uid", "packed", "copies")
    )

    def compare(tile: pa.Table) -> pa.Table:
        vectors, uid = matrix(tile["packed"]), tile["uid"].to_numpy()
        copies, left = tile["copies"].to_numpy(), tile["left"].to_numpy()
        turned = shared.value.turned(vectors)
        same = left.all()  # one part with itself
        x, y = np.flatnonzero(left), np.flatnonzero(left if same else ~left)
        i, j = shared.value.candidates(turned[x], turned[y])
        i, j = x[i], y[j]
        if same:
            i, j = i[i < j], j[i < j]
        norms = np.linalg.norm(vectors, axis=1)
        good = [np.zeros(0, bool)]
        for first in range(0, len(i), 50_000):
            a, b = i[first : first + 50_000], j[first : first + 50_000]
            dot = np.einsum("ij,ij->i", vectors[a], vectors[b])
            good.append(dot / (norms[a] * norms[b]) >= least)
        good = np.concatenate(good)
        i, j = i[good], j[good]
        links = np.bincount(i, copies[j], len(uid)) + np.bincount(j, copies[i], len(uid))
        root = forest(len(uid), i, j)
        some = np.flatnonzero(links > 0)
        columns = [pa.array(uid[some]), pa.array(links[some].astype(np.int64)), pa.array(uid[root[some]])]
        return pa.table(columns, ["uid", "n", "root"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "a", "b", "p", "q")
    return checkpoint(dealt.groupBy("a", "b", "p", "q").applyInArrow(compare, "uid long, n long, root long"))


def link_vectors(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Rows link if their cosine is ``least`` or more.  A NULL, empty or zero vector, and one with a NULL
    or non-finite component, links with nothing.  Vectors of different lengths don't link; those of
    each length are compared by themselves, in a run for each length.  Rows are vectors of their own even if their ids
    repeat: ``n_links`` counts rows, and ``component_id`` is the smallest id of the component's
    rows.  Rows without an id name no component and aren't kept.  An empty table gives no rows;
    only ``vec_id`` and ``embedding`` are read.
    """
    rows, kind = _prepare(vectors)
    real = F.col("packed").isNotNull()
    reps = rows.where(real).groupBy("packed").agg(F.min("uid").alias("rep"), F.count("*").alias("copies"))
    reps = checkpoint(reps)
    sizes = [r["size"] for r in reps.select(F.length("packed").alias("size")).distinct().orderBy("size").collect()]
    parts = [_links(reps.where(F.length("packed") == n).withColumnRenamed("rep", "uid"), kind, least) for n in sizes]
    found = rows.sparkSession.createDataFrame([], "uid long, n long, root long")
    for part in parts:
        found = found if part is None else found.unionByName(part)
    counts = found.groupBy("uid").agg(F.sum("n").alias("n")).withColumnRenamed("uid", "rep")
    tied = components(found.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    tied = tied.withColumnRenamed("id", "rep")
    named = reps.join(counts, "rep", "left").join(tied, "rep", "left")
    named = named.select(
        "packed",
        F.coalesce("component", "rep").alias("component"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    compared = rows.where(real).join(named, "packed").select("uid", "vec_id", "component", "n_links")
    alone = rows.where(~F.coalesce(real, F.lit(False))).select("uid", "vec_id", F.col("uid").alias("component"), F.lit(0).cast("long").alias("n_links"))
    every = compared.unionByName(alone)
    names = every.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return every.join(names, "component").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
