"""Hard negatives by segment summaries: cheap bounds on inner products before exact ones.

1. Components are whole numbers. Segments of 64, 16 and 4 components of a
   vector are summed up by their mean and deviation. The part of an inner
   product that lies in a segment of L components is L * mean * mean give or
   take L * deviation * deviation, so sums over segments bound a score from
   both sides, and finer segments bound it more closely.
2. Rows are packed into blocks. Anchors stream past bins of blocks. At each level, pairs whose
   bounds show that they can't be among the wanted ones are dropped; the rest goes
   on to finer segments and at last to the exact product.
3. First pass: the best rows with the anchor's label are its positives. Second
   pass: of the rows with another label, the best within a window of
   shares of the positive's score. Each bin gives its best few, a ranked window merges the bins.

Results: rows take part if they have an id, a label, and a vector without null, NaN or
infinite components; components beyond 2^27 after scaling count as 2^27. Of
rows that share an id, the one with the least label and vector counts. Missing
components of shorter vectors count as 0. An anchor without positives, or a positive
without negatives, gives no row; nor does an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetally.llm.meeting import each_bin, meet, one_bin
from zonetally.session import store

#: Components in a segment, level by level.
SEGMENTS = (64, 16, 4)
#: Rows of a packed block, rows that a bin has about, and anchors that are compared at a time.
PACK, BIN_ROWS, MOST_BIN_ROWS, AT_ONCE = 256, 4_096, 65_536, 32
LIMIT = float(1 << 27)
_FAR = np.iinfo(np.int64).max // 2


def usable(rows: DataFrame, id_col: str, label: Column, vector: str, scale: int) -> DataFrame:
    """(id, label, q) of the rows that take part, q being floor(scale * component)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-LIMIT)), F.lit(LIMIT))).cast("int"))
    rows = rows.where(finite).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("q"))
    one = rows.where("id is not null and label is not null").groupBy("id").agg(F.min(F.struct("label", "q")).alias("row"))
    return one.select("id", "row.label", "row.q")


def summaries(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of every segment, level by level."""
    out = []
    for length in SEGMENTS:
        parts = vectors.reshape(len(vectors), -1, length).astype(np.float64)
        out.append((parts.mean(axis=2), parts.std(axis=2)))
    return out


def matrix(lists: pa.ListArray, step: int, dtype: type, fill: int = 0) -> np.ndarray:
    """Lists as rows, filled up to a common multiple of `step`."""
    sizes = np.diff(lists.offsets.to_numpy())
    width = max(1, -(-int(sizes.max(initial=0)) // step)) * step
    out = np.full((len(sizes), width), fill, dtype)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


BLOCK = "ids binary, labels binary, vectors binary, summaries array<binary>"


def packed(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of up to PACK rows: ids, labels, vectors and the summaries of their segments, all as bytes.

    extra: columns of longs or lists of longs that anchors carry; they stay lists.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PACK):
                part = pa.Table.from_batches([batch.slice(start, PACK)]).combine_chunks()
                vectors = matrix(pa.ListArray.from_arrays(*_unsliced(part["q"].chunk(0))), SEGMENTS[0], np.int32)
                levels = [np.stack(level).tobytes() for level in summaries(vectors)]
                values = [part["id"].to_numpy().tobytes(), part["label"].to_numpy().tobytes(), vectors.tobytes(), levels]
                columns = [pa.array([v]) for v in values] + [pa.array([part[c].to_pylist()], pa.list_(part[c].type)) for c in extra]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "labels", "vectors", "summaries", *extra])

    schema = BLOCK + "".join(f", {c} array<{rows.schema[c].dataType.simpleString()}>" for c in extra)
    return rows.select("id", "label", "q", *extra).mapInArrow(run, schema)


def _unsliced(lists: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    offsets = lists.offsets.to_numpy()
    return pa.array(offsets - offsets[0], pa.int32()), lists.flatten()


class Block:
    """Rows as arrays; blocks of different width are filled up with zeros."""

    def __init__(self, rows: list[dict]):
        ids = [np.frombuffer(r["ids"], np.int64) for r in rows]
        vectors = [np.frombuffer(r["vectors"], np.int32).reshape(len(k), -1) for k, r in zip(ids, rows, strict=True)]
        width = max(v.shape[1] for v in vectors)
        self.ids = np.concatenate(ids)
        self.labels = np.concatenate([np.frombuffer(r["labels"], np.int64) for r in rows])
        self.vectors = _stacked(vectors, width).astype(np.float64)
        self.levels = []
        for n, length in enumerate(SEGMENTS):
            both = [np.frombuffer(r["summaries"][n], np.float64).reshape(2, len(k), -1) for k, r in zip(ids, rows, strict=True)]
            self.levels.append(tuple(_stacked([b[side] for b in both], width // length) for side in (0, 1)))
        self.norms = np.sqrt(np.square(self.vectors).sum(axis=1))

    def part(self, at: slice) -> Block:
        out = Block.__new__(Block)
        out.ids, out.labels, out.vectors, out.norms = self.ids[at], self.labels[at], self.vectors[at], self.norms[at]
        out.levels = [(mean[at], deviation[at]) for mean, deviation in self.levels]
        return out


def _stacked(parts: list[np.ndarray], width: int) -> np.ndarray:
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def _common(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both cut to the components that both have; the others are 0 on one side."""
    width = min(a.shape[1], x.shape[1])
    return a[:, :width], x[:, :width]


def _exact(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers. Doubles hold them while sums stay below 2^53."""
    a, x = _common(a, x)
    if np.abs(a).max(initial=0) * np.abs(x).max(initial=0) * a.shape[1] < 1 << 53:
        return np.rint(a @ x.T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


def candidates(a: Block, x: Block, eligible: np.ndarray, low: np.ndarray, high: np.ndarray, most: int,
               counts: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns, scores, alive): the exact scores of the pairs that bounds could not rule out.

    low, high: (anchors, windows) of scores; of each window the `most` best eligible rows are wanted.
    """
    columns, alive = np.arange(len(x.ids)), eligible
    for n, length in enumerate(SEGMENTS):
        used = alive.any(axis=0)
        columns, alive = columns[used], alive[:, used]
        if not len(columns):
            break
        (mean_a, spread_a), (mean_x, spread_x) = a.levels[n], x.levels[n]
        middle = length * (_product(mean_a, mean_x[columns]))
        # doubles round; scores are whole numbers, so a little less than 1 costs nothing
        reach = length * (_product(spread_a, spread_x[columns])) + 1e-9 * np.outer(a.norms, x.norms[columns]) + 0.01
        upper, lower = middle + reach, middle - reach
        still = np.zeros_like(alive)
        for w in range(low.shape[1]):
            least, top = low[:, w, None], high[:, w, None]
            may = alive & (upper >= least) & (lower <= top)
            sure = may & (lower >= least) & (upper <= top)
            full = np.flatnonzero(sure.sum(axis=1) >= most)
            if len(full):  # that many are better than this
                known = np.where(sure[full], lower[full], -np.inf)
                may[full] &= upper[full] >= np.partition(known, -most, axis=1)[:, -most, None]
            still |= may
        alive = still
        if counts is not None:
            counts[length] = counts.get(length, 0) + int(alive.sum())
    used = alive.any(axis=0)
    columns, alive = columns[used], alive[:, used]
    return columns, _exact(a.vectors, x.vectors[columns]), alive


def _product(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    a, x = _common(a, x)
    return a @ x.T


def best(ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` highest scores, equal ones by smaller id."""
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, -most)[-most])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:most]]


def _anchors(batch: pa.RecordBatch) -> Iterator[tuple[Block, dict, slice]]:
    for row in batch.to_pylist():
        block = Block([row])
        for start in range(0, len(block.ids), AT_ONCE):
            yield block.part(at := slice(start, start + AT_ONCE)), row, at


def _find_positives(most: int):
    def run(x: Block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, _, _ in _anchors(batch):
            eligible = (a.labels[:, None] == x.labels) & (a.ids[:, None] != x.ids)
            everything = np.full((len(a.ids), 1), _FAR)
            columns, scores, alive = candidates(a, x, eligible, -everything, everything, most)
            found: list[tuple[np.ndarray, ...]] = []
            for k, anchor in enumerate(a.ids):
                at = columns[alive[k]]
                own = scores[k][alive[k]]
                top = best(x.ids[at], own, most)
                found.append((np.full(len(top), anchor), x.ids[at][top], own[top]))
            yield _rows(found, "anchor_id positive_id positive_score")

    return run


def _find_negatives(most: int, low: int, high: int):
    def run(x: Block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, row, part in _anchors(batch):
            eligible = a.labels[:, None] != x.labels
            ids, wanted = row["positive_ids"][part], row["positive_scores"][part]
            width = max(map(len, wanted))
            least, top = np.full((len(ids), width), _FAR), np.full((len(ids), width), -_FAR)
            for k, scores in enumerate(wanted):
                for j, score in enumerate(scores):
                    least[k, j], top[k, j] = -(-low * score // 100), high * score // 100
            columns, scores, alive = candidates(a, x, eligible, least, top, most)
            found: list[tuple[np.ndarray, ...]] = []
            for k, anchor in enumerate(a.ids):
                at = columns[alive[k]]
                own = scores[k][alive[k]]
                for j, (positive, score) in enumerate(zip(ids[k], wanted[k], strict=True)):
                    inside = np.flatnonzero((own >= least[k, j]) & (own <= top[k, j]))
                    chosen = inside[best(x.ids[at][inside], own[inside], most)]
                    n = len(chosen)
                    found.append((np.full(n, anchor), np.full(n, positive), np.full(n, score), x.ids[at][chosen], own[chosen]))
            yield _rows(found, "anchor_id positive_id positive_score negative_id negative_score")

    return run


def _rows(found: list[tuple[np.ndarray, ...]], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)], names.split())


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchor: which rows are anchors, an expression over column `id`.
    low, high: a negative's score is at least `low` and at most `high` percent of the positive's.
    """
    spark = rows.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    table = store(spark, usable(rows, id_col, label, vector, scale), "vectors")
    n = table.count()
    bins = max(1, -(-n // min(MOST_BIN_ROWS, max(BIN_ROWS, n // 48))))
    blocks = one_bin(store(spark, packed(table), "blocks"), bins, "ids")

    asked = table.where(anchor)
    met = meet(blocks, each_bin(packed(asked), bins), Block, _find_positives(positives), "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    top = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    lists = top.groupBy("anchor_id").agg(F.collect_list("positive_id").alias("positive_ids"), F.collect_list("positive_score").alias("positive_scores"))
    asked = store(spark, lists.join(asked, lists["anchor_id"] == asked["id"]).drop("anchor_id"), "anchors")

    met = meet(blocks, each_bin(packed(asked, ("positive_ids", "positive_scores")), bins), Block, _find_negatives(negatives, low, high),
               "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
