"""Approximate nearest neighbours: stable projections, kd-trees, a chi-square stop.

Vectors are scaled to length one and projected to ``M`` dimensions by Gaussian
(2-stable) directions: the squared projected distance of two vectors over their
squared distance follows a chi-square law with ``M`` degrees of freedom. The
projected space is cut into cells by a kd-tree over a bounded sample (all rows
are indexed); each cell holds a kd-tree of its own. A query goes through a
cell's leaves in the order of their projected distance and verifies their
vectors; it stops where a vector as near as its current k-th would have been
projected nearer already with probability ``CONFIDENCE``. Round one searches the
query's home cell, round two every other cell that this test leaves open.

Cosine order equals distance order on unit vectors; results carry the cosine in
double precision on the original vectors. Equal vectors are one point with its
smallest ids (k + 1 of them can matter), kept by a per-partition limit before
the shuffle, so a vector that fills a third of the table stays one point.

Cases: vectors that are null, zero, or hold null or non-finite components take no
part, nor do vectors of another length than most; fewer candidates than k give
fewer rows; ties go to the smaller id; rows that repeat id and vector are one;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.textblock import quoted
from ledgerline.session import cut_lineage

M = 8
CONFIDENCE = 0.98
K = 5
SAMPLE_ROWS = 20_000
#: Vectors of a cell, and of a leaf inside it; queries searched by one task.
CELL_ROWS, LEAF_ROWS, TASK_QUERIES = 16_384, 32, 50_000
MAX_CELLS = 1 << 16
SEED = 1


def chi2_below(x: np.ndarray, m: int = M) -> np.ndarray:
    """Chi-square distribution function, m even."""
    h = np.asarray(x, float) / 2
    term, total = np.ones_like(h), np.ones_like(h)
    for i in range(1, m // 2):
        term = term * h / i
        total = total + term
    return 1 - np.exp(-h) * total


def _chi2_point(p: float, m: int = M) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_below(np.array(mid), m) < p else (lo, mid)
    return hi


#: A vector at distance d is projected beyond d * sqrt(REACH) with probability
#: 1 - CONFIDENCE at most.
REACH = _chi2_point(CONFIDENCE)


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(dim, M))


def unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, keepdims=True)
    x = x / big  # components near the ends of the double range stay in it
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kd_boxes(points: np.ndarray, leaf: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Leaves of a kd-tree (row numbers) with their lower and upper corners."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        p = points[rows]
        if len(rows) > leaf and (p.max(0) > p.min(0)).any():
            axis = int(np.argmax(p.max(0) - p.min(0)))
            order = np.argsort(p[:, axis], kind="stable")
            half = len(rows) // 2
            todo += [rows[order[:half]], rows[order[half:]]]
        else:
            leaves.append(rows)
    lo = np.array([points[r].min(0) for r in leaves])
    hi = np.array([points[r].max(0) for r in leaves])
    return leaves, lo, hi


def box_distance(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    gap = np.maximum(np.maximum(lo - q, q - hi), 0)
    return np.einsum("ij,ij->i", gap, gap)


class Cell:
    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        self.vectors, self.ids = vectors, ids
        self.unit = unit(vectors)
        self.proj = self.unit @ directions(vectors.shape[1])
        self.leaves, self.lo, self.hi = kd_boxes(self.proj, LEAF_ROWS)

    def search(self, query: np.ndarray, query_id: int, k: int, bound: float) -> tuple[list[tuple[float, int]], float]:
        """Best (cosine, id) rows of the cell, and the squared distance of the k-th
        nearest known (``bound`` if none nearer)."""
        u = unit(query[None])[0]
        near = box_distance(u @ directions(len(u)), self.lo, self.hi)
        best: list[tuple[float, int]] = []
        kth = bound
        order = np.argsort(near, kind="stable")
        for at in range(0, len(order), 4):
            if near[order[at]] > REACH * kth:
                break
            rows = np.concatenate([self.leaves[j] for j in order[at:at + 4]])
            dist = 2 - 2 * (self.unit[rows] @ u)
            rows = rows[dist <= kth + 1e-9]
            if not len(rows):
                continue
            for r, s in zip(rows.tolist(), cosine(self.vectors[rows], query).tolist()):
                best += [(s, i) for i in self.ids[r] if i != query_id]
            best.sort(key=lambda x: (-x[0], x[1]))
            del best[k:]
            if len(best) == k:
                kth = min(kth, max(0.0, 2 - 2 * best[-1][0]))
        return best, kth


def cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``q`` in double precision, on the original vectors."""
    x, q = x / np.abs(x).max(1, keepdims=True), q / np.abs(q).max()
    return np.sum(x * q, axis=1) / (np.sqrt(np.sum(x * x, axis=1)) * np.sqrt(np.sum(q * q)))


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part."""
    v = quoted(vector).cast("array<double>")
    rows = vectors.select(quoted(id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == dims[0]["d"]) if dims else rows


def points_of(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids): distinct vectors, each with its ``keep`` smallest ids."""
    rows = rows.select("vec_id", "v", F.xxhash64("v").alias("h")).dropDuplicates(["vec_id", "h"])
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("vec_id"))).where(F.col("r") <= keep)
    return few.groupBy("h").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v")).select("v", "ids")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, id: str = "vec_id", vector: str = "embedding",
            cell_rows: int = CELL_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row of
    ``queries`` (same columns as ``vectors``) but the query's own row."""
    spark = vectors.sparkSession
    rows = usable(vectors, id, vector)
    points = cut_lineage(points_of(rows, k + 1))
    n = points.count()
    asked = usable(queries, id, vector).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    out = "query_id long, vec_id long, score double, kth double"
    if n == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # cells from a bounded sample of points
    size = min(n, SAMPLE_ROWS)
    wanted = max(1, min(MAX_CELLS, -(-n // cell_rows)))
    sample = points.select("v").where(F.pmod(F.xxhash64("v", F.lit(7)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, 1.2 * size / n)) + 1).limit(size).collect()
    base = np.array([r["v"] for r in sample])
    dim = base.shape[1] if len(base) else len(points.first()["v"])
    base = unit(base) @ directions(dim) if len(base) else np.zeros((1, M))
    tree = split_tree(base, wanted)
    n_cells = max(1, sum(t[0] == "leaf" for t in tree))
    n_asked = asked.count()
    chunks = max(1, -(-n_asked // TASK_QUERIES))
    shared = spark.sparkContext.broadcast(tree)

    def home(v: pd.Series) -> pd.Series:
        return pd.Series(route(shared.value, unit(np.stack(v.to_list())) @ directions(dim)), dtype="int32")
    cell_of = F.pandas_udf(home, "int")
    placed = cut_lineage(points.withColumn("cell", cell_of("v")))
    # each cell's box, from all its points
    boxes = cell_boxes(placed, dim)
    asked = asked.withColumn("cell", cell_of("q")).withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
    index = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def look(points_pdf: pd.DataFrame, queries_pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points_pdf) and len(queries_pdf):
            cell = Cell(np.stack(points_pdf["v"].to_list()), [list(x) for x in points_pdf["ids"]])
            for qid, q, kth in zip(queries_pdf["query_id"], queries_pdf["q"], queries_pdf["kth"]):
                best, far = cell.search(np.asarray(q, float), int(qid), k, float(kth))
                found += [(int(qid), i, s, far) for s, i in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score", "kth"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64", "kth": "float64"})

    def searched(q: DataFrame) -> DataFrame:
        return index.groupBy("cell", "chunk").cogroup(q.groupBy("cell", "chunk")).applyInPandas(look, out)

    first = cut_lineage(searched(asked.withColumn("kth", F.lit(5.0))))
    reach = first.groupBy("query_id").agg(F.min("kth").alias("kth"))
    corners = spark.sparkContext.broadcast(boxes)

    def others(q: pd.Series, own: pd.Series, kth: pd.Series) -> pd.Series:
        ids, lo, hi = corners.value
        p = unit(np.stack(q.to_list())) @ directions(dim)
        return pd.Series([[int(c) for c in ids[box_distance(x, lo, hi) <= REACH * d] if c != o] for x, o, d in zip(p, own, kth)])
    open_cells = F.pandas_udf(others, "array<int>")
    again = (asked.join(reach, "query_id", "left").withColumn("kth", F.coalesce("kth", F.lit(5.0)))
             .withColumn("cell", F.explode(open_cells("q", "cell", "kth"))))
    every = first.unionByName(searched(again)) if n_cells > 1 else first
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def split_tree(points: np.ndarray, wanted: int) -> list[tuple]:
    """kd-tree with about ``wanted`` leaves: (axis, value, left, right) or
    ("leaf", cell)."""
    tree: list[tuple] = []
    cells = 0
    todo = [(np.arange(len(points)), wanted, None)]
    while todo:
        rows, share, back = todo.pop()
        at = len(tree)
        if back is not None:
            node, side = back
            t = list(tree[node])
            t[side] = at
            tree[node] = tuple(t)
        p = points[rows]
        if share > 1 and len(rows) > 1 and (p.max(0) > p.min(0)).any():
            axis = int(np.argmax(p.max(0) - p.min(0)))
            value = float(np.quantile(p[:, axis], (share // 2) / share))
            left = p[:, axis] <= value
            if left.any() and not left.all():
                tree.append((axis, value, -1, -1))
                todo += [(rows[left], share // 2, (at, 2)), (rows[~left], share - share // 2, (at, 3))]
                continue
        tree.append(("leaf", cells))
        cells += 1
    return tree


def route(tree: list[tuple], points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int32)
    todo = [(0, np.arange(len(points)))]
    while todo:
        at, rows = todo.pop()
        if tree[at][0] == "leaf":
            out[rows] = tree[at][1]
            continue
        axis, value, left, right = tree[at]
        below = points[rows, axis] <= value
        todo += [(left, rows[below]), (right, rows[~below])]
    return out


def cell_boxes(placed: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Corners of the projected points of each cell (at most MAX_CELLS rows)."""
    def corners(v: pd.Series) -> pd.Series:
        return pd.Series((unit(np.stack(v.to_list())) @ directions(dim)).tolist())
    project = F.pandas_udf(corners, "array<double>")
    p = placed.select("cell", project("v").alias("p"))
    rows = p.groupBy("cell").agg(*[f(F.col("p")[i]).alias(f"{n}{i}") for i in range(M) for n, f in (("lo", F.min), ("hi", F.max))]).collect()
    return (np.array([r["cell"] for r in rows]), np.array([[r[f"lo{i}"] for i in range(M)] for r in rows]),
            np.array([[r[f"hi{i}"] for i in range(M)] for r in rows]))
