"""Quality scores by Bradley-Terry ranking: preference pairs, logistic loss on feature differences, quantile threshold.

A pair prefers a document labelled 1 to one labelled 0. The utility ``w . features`` is learnt so that the logistic of
the utilities' difference is the chance of the preference; a quantile of the utilities separates the labels, and the
score is the logistic of the utility measured from there.

The loss is over all pairs of all labelled training documents. A pair's loss depends on two utilities alone, so the pairs
are never made: documents are summed up by label and utility, rounded to bins, and bins meet bins.
"""

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import crc_fold, map_batches, map_texts, schema_of, stored
from tidewire.llm.quality_rules import repeated_words

#: A score of this or more predicts label 1.
CUT = 0.3
#: All pairs together weigh as much against the ridge as so many.
PAIRS = 200_000
#: Least width of a bin of utilities, and bins between the least and the greatest utility there can be.
WIDTH, BINS = 1 / 64, 16_384
#: Standardised features lie within this.
CLIP = 8
RATIOS = (
    "upper", "digit", "exclamation", "bar", "symbol", "comma", "stop", "wide", "repeated", "adjacent", "distinct",
    "exclaimed", "bars", "marked", "capitalised", "dup_lines", "top_word")
N_FEATURES = 5 + 3 * len(RATIOS)


def features(text: str) -> np.ndarray:
    """Length, word and line shape, and per signal its share, the root of the share and whether it occurs."""
    data = text.encode("utf-8", "surrogatepass")
    words, lines = data.split(), data.split(b"\n")
    n, size = max(1, len(words)), max(1, len(data))
    at = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = max(1, int(at[65:91].sum() + at[97:123].sum()))
    counts = Counter(words)
    filled = [line for line in lines if line.strip()]
    longest = run = 1
    adjacent = 0
    for a, b in zip(words, words[1:]):
        if a == b:
            run += 1
            adjacent += 1
            longest = max(longest, run)
        else:
            run = 1
    ratios = np.array([
        at[65:91].sum() / letters, at[48:58].sum() / size, at[33] / size, at[124] / size, at[[35, 36, 37, 38, 42, 60, 62]].sum() / size,
        at[44] / n, at[46] / n, (at[128:] > 0).sum() / 128, repeated_words(words) / n, adjacent / n, len(counts) / n,
        sum(w[-1] == 33 for w in words) / n, counts.get(b"|", 0) / n, sum(w[-1] in b"#$%&*<>" for w in words) / n,
        sum(65 <= w[0] <= 90 for w in words) / n, (len(filled) - len(set(filled))) / max(1, len(filled)),
        max(counts.values(), default=0) / n,
    ])
    shape = [
        np.log1p(len(words)), np.log1p(size / n), np.log1p(longest), np.log1p(len(filled)), np.log1p(n / max(1, len(filled)))]
    return np.concatenate([shape, ratios, np.sqrt(ratios), ratios > 0])


class Ranking:
    """Learnt utilities: standardised features, weights, and the line from utility to score."""

    def __init__(self):
        """Before anything is learnt every text scores alike, as label 1."""
        self.weights, self.slope, self.cut = np.zeros(N_FEATURES), 1.0, -1.0
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)

    def standardised(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -CLIP, CLIP)

    def width(self) -> float:
        """Width of a bin of utilities."""
        return max(WIDTH, 2 * CLIP * float(np.abs(self.weights).sum()) / BINS)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        utility = self.standardised(rows) @ self.weights
        logit = np.log(CUT / (1 - CUT)) + self.slope * (utility - self.cut)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _features(docs: DataFrame) -> DataFrame:
    """``doc_id, features`` of every row."""
    return map_texts(
        docs, ["doc_id"], lambda: lambda texts: [[features(t).tobytes() for t in texts]], "features binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(-1, N_FEATURES)


def summed(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], Iterator], width: int) -> dict[int, np.ndarray]:
    """Sums of the vectors that ``of`` gives by key for the features and labels of a batch; there are few keys."""
    names = [f"c{i}" for i in range(width)]
    schema = schema_of(rows, [], ", ".join(["key long", *(f"{n} double" for n in names)]))

    def run(batches):
        sums = {}
        for batch in batches:
            for key, vector in of(_matrix(batch.column(1)), batch.column(0).to_numpy()):
                sums[key] = sums[key] + vector if key in sums else vector
        columns = np.array(list(sums.values())).reshape(-1, width).T
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in columns)], names=schema.names)

    found = map_batches(rows.select("_label", "features"), run, schema).groupBy("key").agg(*(F.sum(n).alias(n) for n in names))
    return {r[0]: np.array(r[1:]) for r in found.orderBy("key").collect()}


def _moments(rows: np.ndarray, labels: np.ndarray) -> Iterator:
    for label in (0, 1):
        of = rows[labels == label]
        yield label, np.append(of.sum(axis=0), len(of))
        yield 2 + label, np.append((of * of).sum(axis=0), len(of))


def _key(label: int, bins: np.ndarray) -> np.ndarray:
    return 2 * bins + label


def _step(rows: DataFrame, ranking: Ranking, pairs: float, ridge: float) -> np.ndarray:
    """One Newton step for the loss of all pairs."""
    width = ranking.width()

    def binned(x, labels):
        z = ranking.standardised(x)
        u = z @ ranking.weights
        keys, at = np.unique(_key(labels, np.floor(u / width).astype(np.int64)), return_inverse=True)
        order = np.argsort(at, kind="stable")
        starts = np.searchsorted(at[order], np.arange(len(keys)))
        return keys, at, np.add.reduceat(np.column_stack([z, u, np.ones(len(z))])[order], starts), z

    bins = summed(rows, lambda x, labels: zip(*(v.tolist() if v.ndim == 1 else v for v in binned(x, labels)[::2])), N_FEATURES + 2)
    keys = [np.array([k for k in bins if k % 2 == label], np.int64) for label in (0, 1)]
    (bad, bad_u, bad_n), (good, good_u, good_n) = (
        (m[:, :-2], m[:, -2] / m[:, -1], m[:, -1]) for m in (np.array([bins[k] for k in of]) for of in keys))
    share = PAIRS / pairs
    gradient, cross, weight, against = np.zeros(N_FEATURES), np.zeros((N_FEATURES, N_FEATURES)), {}, np.zeros(len(bad_n))
    for k, (key, total, u, n) in enumerate(zip(keys[1].tolist(), good, good_u, good_n)):
        p = 1 / (1 + np.exp(-np.clip(u - bad_u, -30, 30)))
        h = p * (1 - p)
        gradient += total * (bad_n @ (p - 1)) - n * ((p - 1) @ bad)
        cross += np.outer(total, h @ bad)
        weight[key] = bad_n @ h
        against += n * h
    weight.update(zip(keys[0].tolist(), against))

    def curved(x, labels):
        found, at, _, z = binned(x, labels)
        held = np.array([weight[k] for k in found.tolist()])[at]
        yield from enumerate((z * held[:, None]).T @ z)

    own = summed(rows, curved, N_FEATURES)
    curvature = share * (np.array([own[i] for i in range(N_FEATURES)]) - cross - cross.T)
    return np.linalg.solve(
        curvature + (ridge + 1e-3) * np.eye(N_FEATURES), share * gradient + ridge * ranking.weights)


def _line(rows: DataFrame, ranking: Ranking, n_good: int, n_bad: int) -> tuple[float, float]:
    """The quantile of the utilities that parts the labels best, both weighing the same, of several the middle; and the
    median utility of label 1."""
    schema = schema_of(rows, ["_label"], "utility double")

    def run(batches):
        for batch in batches:
            u = ranking.standardised(_matrix(batch.column(1))) @ ranking.weights
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(u)], names=schema.names)

    place = F.floor(F.col("utility") / ranking.width())
    values = stored(map_batches(rows.select("_label", "features"), run, schema).groupBy("utility").agg(
        F.sum("_label").alias("good"), F.sum(1 - F.col("_label")).alias("bad")).withColumn("bin", place), "preference-utilities")
    bins = values.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("bin").collect()
    sums = np.cumsum([(0, 0), *((r.good, r.bad) for r in bins)], axis=0).tolist()
    before = rows.sparkSession.createDataFrame(
        [(r.bin, *s) for r, s in zip(bins, sums)], "bin long, good_start long, bad_start long")
    below = Window.partitionBy("bin").orderBy("utility").rowsBetween(Window.unboundedPreceding, -1)
    sofar = lambda kind: (F.col(f"{kind}_start") + F.coalesce(F.sum(kind).over(below), F.lit(0))).alias(f"{kind}_below")
    ranked = stored(values.join(F.broadcast(before), "bin").select(
        "utility", "good", "bad", sofar("good"), sofar("bad")).withColumn(
        "at", F.col("good_below") + F.col("bad_below")).withColumn("n", F.col("good") + F.col("bad")).withColumn(
        "parted", F.col("bad_below") * n_good - F.col("good_below") * n_bad), "preference-ranks")
    best = ranked.agg(F.max("parted")).first()[0]
    first, last = ranked.where(F.col("parted") == best).agg(F.min("at"), F.max(F.col("at") + F.col("n") - 1)).first()

    def middle(twice, at, n):
        """Mean of the utilities at the two ranks next to half of ``twice``."""
        ranks = (twice // 2, (twice + 1) // 2)
        return sum(ranked.where((F.col(at) <= r) & (F.col(at) + F.col(n) > r)).first().utility for r in ranks) / 2

    return middle(max(0, first - 1) + last, "at", "n"), middle(n_good - 1, "good_below", "good")


def fit(featured: DataFrame, labels: DataFrame, folds: int = 5, ridge: float = 1.0) -> Ranking:
    """Learn from all labelled documents outside the held-out fold; ``featured`` has their ``doc_id, features``.

    Null labels and labels without a document are ignored, repeated labels and documents count each.
    """
    chosen = labels.where(F.col("quality").isin(0, 1) & (crc_fold("doc_id", folds) != 0)).select(
        F.col("doc_id").alias("_doc"), F.col("quality").cast("long").alias("_label"))
    rows = stored(featured.join(chosen, F.col("doc_id") == F.col("_doc")).select("_label", "features"), "preference-rows")
    ranking, sums = Ranking(), summed(rows, _moments, N_FEATURES + 1)
    n_bad, n_good = (int(sums[label][-1]) if label in sums else 0 for label in (0, 1))
    if not n_good or not n_bad:  # nothing to compare
        return ranking
    n = n_good + n_bad
    ranking.mean = (sums[0] + sums[1])[:-1] / n
    ranking.scale = np.sqrt(np.maximum((sums[2] + sums[3])[:-1] / n - ranking.mean ** 2, 0)) + 1e-9
    for _ in range(25):
        step = _step(rows, ranking, float(n_good) * n_bad, ridge)
        ranking.weights = ranking.weights - step
        if np.abs(step).max() < 1e-3:  # below what the rounding of utilities changes
            break
    ranking.cut, middle = _line(rows, ranking, n_good, n_bad)
    ranking.slope = 4.0 / max(1e-6, middle - ranking.cut)
    return ranking


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per input row.

    Scores depend on the text alone; a null text scores as the empty one; repeated rows score alike; other columns
    are ignored. Without labels of both kinds every text scores alike, above the cut.
    """
    featured = stored(_features(docs), "preference-features")
    ranking = fit(featured, labels, folds)
    schema = schema_of(featured, ["doc_id"], "score double")

    def judge(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ranking.scores(_matrix(batch.column(1))))], names=schema.names)

    return map_batches(featured, judge, schema).select(
        "doc_id", (crc_fold("doc_id", folds) == 0).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_preferred(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text scores at or above the cut; columns and their order stay."""
    labelled = docs.select("doc_id", "text").join(labels.where("quality IN (0, 1)").select("doc_id"), "doc_id", "left_semi")
    ranking = fit(_features(labelled), labels)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))

    def judge(texts: list[str]) -> list:
        return [ranking.scores(np.array([features(t) for t in texts]))]

    held = docs.select(row.alias("_row"), "text")
    return map_texts(held, ["_row"], lambda: judge, "_score double").where(F.col("_score") >= CUT).select("_row.*")
