"""Quality scores from preference pairs: the Bradley-Terry model on text features.

A document beats another with probability sigmoid(score - score'); scores are
linear in features of the text alone. The model is learned from pairs of a
document labelled 1 and one labelled 0, by logistic loss on the difference of
their features. The cut between good and bad is the quantile of the scores that
the number of label 0 names, and lies at CUT on the scale from 0 to 1.

Every labelled row meets every row of the other class. Sums over all pairs need
no pairs: what a row gets from the other class is a smooth function of its own
score, which follows from the other class's scores counted in steps of STEP.
So each round of Newton's method is two passes over the stored features, and the
cut is an order statistic of all labelled rows. Texts are read once.

Null and empty texts have features like others (all zero) and get a score.
Rows without a valid label are not learned from; without both labels
all scores are 0.5; rows with a null doc_id are scored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetally.llm.text import MOST_IDS, texts_only
from zonetally.session import store

#: Width of the steps in which scores are counted, and of those for the curvature between classes, which only sets the pace of
#: the rounds. A step's rows stand at their mean, so a sum over pairs is off by about STEP ** 2 / 100 of its size.
STEP, COARSE = 1 / 64, 1 / 2
#: Rounds end when no weight moves by more.
SETTLED = 1e-7
#: Stands for a step where a sum is over all rows of a label.
_OWN = -(1 << 40)
#: The score at the quantile that separates the classes.
CUT = 0.7

#: Kinds of bytes: 0 others, 1 capitals, 2 small letters, 3 digits, 4 white space, 5 stops, 6 calls, 7 symbols, 8 non-ASCII.
_KIND = np.zeros(256, np.int64)
for _k, _members in enumerate((range(65, 91), range(97, 123), range(48, 58), (32, *range(9, 14)), b".,;:", b"!?", b"#*$%&|<>{}[]=_~^\\/@", range(128, 256)), 1):
    _KIND[list(_members)] = _k


def features(text: bytes) -> list[float]:
    """Shares between 0 and 1, each also as its root, and the logarithms of sizes."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=9) / len(text)
    letters = max(kinds[1] + kinds[2], 1e-9)
    lines = [line for line in text.split(b"\n") if line.strip()]
    pairs = set(zip(words, words[1:], strict=False))
    sizes = np.fromiter(map(len, words), np.int64, n)
    shares = [
        *kinds.tolist(), kinds[1] / (letters + kinds[1]), 1 - len(set(words)) / n, 1 - len(pairs) / max(1, n - 1), 1 - len(set(lines)) / len(lines),
        sum(map(bytes.isupper, words)) / n, sum(w[-1] in b"!?#*$%&|<>" for w in words) / n, sum(not w[:1].isalpha() and w[0] < 128 for w in words) / n,
        sum(w[-1] in b".,;:" for w in words) / n, sum(map(bytes.istitle, words)) / n, float(np.mean(sizes == 1)), float(np.mean(sizes > 15)),
    ]
    return [*shares, *(x**0.5 for x in shares), float(np.log1p(n)) / 10, float(sizes.mean()) / 20, float(sizes.std()) / 20, float(np.log1p(n / len(lines))) / 10, 1.0 / n]


N_FEATURES = 2 * 20 + 5


@dataclass(frozen=True)
class Model:
    """score = sigmoid(weights . (features - middle) / spread - cut + the logit of CUT)."""

    weights: np.ndarray
    middle: np.ndarray
    spread: np.ndarray
    cut: float

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.spread, -10, 10)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + np.log(CUT / (1 - CUT)), -40, 40)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class _Others:
    """By a row's score, means over all rows of the other class: the chance of the worse one to win, and how fast it changes."""

    at: np.ndarray
    chance: np.ndarray
    slope: np.ndarray

    @staticmethod
    def of(scores: np.ndarray, counts: np.ndarray, steps: np.ndarray, sign: int) -> _Others:
        """For rows in these steps, against the other class's counts at their scores."""
        at = np.unique(np.concatenate([steps, steps + 1])) * STEP
        chance, slope, share = np.zeros(len(at)), np.zeros(len(at)), counts / counts.sum()
        for k in range(0, len(at), 256):  # a bounded part of the square at a time
            p = _sigmoid(-sign * (at[k:k + 256, None] - scores))
            chance[k:k + 256], slope[k:k + 256] = p @ share, (p * (1 - p)) @ share
        return _Others(at, chance, slope)


def _counts(x: np.ndarray, label: np.ndarray, model: Model) -> dict[tuple[int, int], np.ndarray]:
    """By (label, step): rows and the sum of their scores."""
    raw = model.raw(x)
    keys, where = np.unique(np.stack([label.astype(np.int64), np.floor(raw / STEP).astype(np.int64)]), axis=1, return_inverse=True)
    n, total = np.bincount(where.ravel()), np.bincount(where.ravel(), raw)
    return {(int(k), int(b)): np.array([m, t]) for k, b, m, t in zip(*keys, n, total, strict=True)}


def _slopes(x: np.ndarray, label: np.ndarray, model: Model, others: dict[int, _Others]) -> dict[tuple[int, int], np.ndarray]:
    """By (label, _OWN): the sums of a row's slope and own curvature; by (label, coarse step): the sum of their features."""
    out = {}
    z = model.scaled(x)
    raw = z @ model.weights
    for k in np.unique(label).tolist():
        mine, at = z[label == k], raw[label == k]
        chance, curve = np.interp(at, others[k].at, others[k].chance), np.interp(at, others[k].at, others[k].slope)
        own = (mine * curve[:, None]).T @ mine
        out[k, _OWN] = np.concatenate([(1 if k == 0 else -1) * (chance @ mine), own.ravel()])
        step = np.floor(at / COARSE).astype(np.int64)
        for b in np.unique(step).tolist():
            out[k, b] = mine[step == b].sum(axis=0)
    return out


def _newton(summed: Callable[..., dict[tuple[int, int], np.ndarray]], start: Model, penalty: float, rounds: int) -> Model:
    """The weights at the least mean loss over all pairs. `summed` gives the sums of a function over all labelled rows."""
    model = start
    for _ in range(rounds):
        found = summed(_counts, model)
        steps = {k: np.array([[b, *v] for (label, b), v in found.items() if label == k]) for k in (0, 1)}
        # the chance that the model gives to the worse of two, for a good row against each bad one and the other way round
        others = {k: _Others.of(steps[1 - k][:, 2] / steps[1 - k][:, 1], steps[1 - k][:, 1], steps[k][:, 0], 1 if k else -1) for k in (0, 1)}
        n = {k: v[:, 1].sum() for k, v in steps.items()}
        found = summed(_slopes, model, others)
        width = len(model.weights)
        slope, bend = penalty * model.weights, penalty * np.eye(width)
        for k in (0, 1):
            slope = slope + found[k, _OWN][:width] / n[k]
            bend = bend + found[k, _OWN][width:].reshape(width, width) / n[k]
        sides = {k: [(b, v) for (label, b), v in found.items() if label == k and b != _OWN] for k in (0, 1)}
        at = {k: (np.array([b for b, _ in side]) + 0.5) * COARSE for k, side in sides.items()}
        sums = {k: np.array([v for _, v in side]) / n[k] for k, side in sides.items()}
        p = _sigmoid(at[1][:, None] - at[0])
        between = sums[1].T @ (p * (1 - p)) @ sums[0]
        values, axes = np.linalg.eigh(bend - between - between.T)  # coarse steps may leave it short of positive
        move = axes @ ((axes.T @ slope) / np.maximum(values, penalty))
        model = replace(model, weights=model.weights - move)
        if np.abs(move).max() < SETTLED:
            break
    return model


def _moments(x: np.ndarray, label: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """By (label, 0): rows, and the sums of features and of their squares."""
    return {(k, 0): np.concatenate([[(label == k).sum()], x[label == k].sum(axis=0), (x[label == k] ** 2).sum(axis=0)]) for k in np.unique(label).tolist()}


def _trained(summed: Callable[..., dict[tuple[int, int], np.ndarray]], penalty: float = 1e-3, rounds: int = 50) -> tuple[Model, int] | None:
    """The model without its cut, and the number of rows labelled 0; None if one class is missing."""
    found = summed(_moments)
    if len(found) < 2:
        return None
    both = found[0, 0] + found[1, 0]
    middle, square = np.split(both[1:] / both[0], 2)
    spread = np.sqrt(np.maximum(square - middle**2, 0)) + 1e-6
    return _newton(summed, Model(np.zeros(len(middle)), middle, spread, 0.0), penalty, rounds), int(found[0, 0][0])


def fit(good: np.ndarray, bad: np.ndarray, share_bad: float) -> Model:
    """The model from the features of preferred and of other documents that one process holds; `share_bad` places the cut."""
    x, label = np.concatenate([good, bad]), np.repeat([1, 0], [len(good), len(bad)])
    model, _ = _trained(lambda fn, *args: fn(x, label, *args))
    raw = np.concatenate([model.raw(good), model.raw(bad)])
    order = np.argsort(raw)
    weight = np.repeat([(1 - share_bad) / len(good), share_bad / len(bad)], [len(good), len(bad)])
    below = int((np.cumsum(weight[order]) <= share_bad + 1e-12).sum())
    low, high = raw[order[max(0, below - 1)]], raw[order[min(len(raw) - 1, below)]]
    return replace(model, cut=float(low + high) / 2)


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features, of every row, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.list_(pa.float64()))], ["doc_id", "x"])

    return store(docs.sparkSession, texts_only(docs).mapInArrow(run, "doc_id long, x array<double>"), "features")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _summed(rows: DataFrame, fn: Callable[..., dict[tuple[int, int], np.ndarray]], *args) -> dict[tuple[int, int], np.ndarray]:
    """The sums of fn(x, label, *args) over all rows. A task gives one row per key; Spark adds them by key."""
    shared = rows.sparkSession.sparkContext.broadcast(args)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for key, value in fn(_matrix(batch["x"]), batch["label"].to_numpy(), *shared.value).items():
                    total[key] = total[key] + value if key in total else value
        columns = [pa.array([k for k, _ in total], pa.int32()), pa.array([b for _, b in total], pa.int64()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["label", "step", "v"])

    parts = rows.select("label", "x").mapInArrow(run, "label int, step long, v array<double>")
    if fn is _counts:
        added = parts.groupBy("label", "step").agg(F.array(F.sum(F.col("v")[0]), F.sum(F.col("v")[1])).alias("v"))
    else:  # long arrays of few keys
        added = parts.select("label", "step", F.posexplode("v").alias("k", "v")).groupBy("label", "step", "k").agg(F.sum("v").alias("v"))
        added = added.groupBy("label", "step").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda e: e["v"]).alias("v"))
    out = {(row.label, row.step): np.array(row.v) for row in added.collect()}
    shared.unpersist()
    return out


def _order_statistic(rows: DataFrame, column: str, rank: int, bins: int = 4096) -> float:
    """The value with `rank` smaller or earlier equal ones. Ranges around it are counted, ever narrower, so no task sorts the rows."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / bins
        inside = rows.where(F.col(column).between(low, high))
        step = F.least(F.floor((F.col(column) - low) / width), F.lit(bins)) if width > 0 else F.when(F.col(column) > low, 1).otherwise(0)
        for part in inside.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy("step").collect():
            if rank < part.n:
                low, high = part.low, part.high
                break
            rank -= part.n
    return low


def learn_featured(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """The model from the rows of `featured` that have a label; None if one class is missing."""
    spark = rows.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    if known.count() <= MOST_IDS:
        known = F.broadcast(known)
    train = store(spark, rows.join(known, "doc_id").select("label", "x"), "labelled")
    found = _trained(lambda fn, *args: _summed(train, fn, *args))
    if found is None:
        return None
    model, n_bad = found
    raw = store(spark, _scored(train, model, "label int").select("raw"), "raw")
    return replace(model, cut=(_order_statistic(raw, "raw", n_bad - 1) + _order_statistic(raw, "raw", n_bad)) / 2)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """The model from all labelled documents; None if one class is missing. The labels given are those to learn from."""
    return learn_featured(featured(docs), labels, label)


def _scored(rows: DataFrame, model: Model | None, key: str) -> DataFrame:
    """The key column, raw (without the cut) and score of rows with features x."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    name = key.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is None:
                raw, found = np.zeros(batch.num_rows), np.full(batch.num_rows, 0.5)
            else:
                x = _matrix(batch["x"])
                raw, found = shared.value.raw(x), shared.value.scores(x)
            yield pa.RecordBatch.from_arrays([batch[name], pa.array(raw, pa.float64()), pa.array(found, pa.float64())], [name, "raw", "score"])

    return rows.select(name, "x").mapInArrow(run, f"{key}, raw double, score double")


def score_featured(rows: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row of `featured`."""
    return _scored(rows, model, "doc_id long").select("doc_id", "score")


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is None:
                found = np.full(batch.num_rows, 0.5)
            else:
                found = shared.value.scores(np.array([features(text) for text in batch["text"].to_pylist()]).reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.float64())], ["doc_id", "score"])

    return texts_only(docs).mapInArrow(run, "doc_id long, score double")
