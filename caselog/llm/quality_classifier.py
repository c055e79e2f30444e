"""Quality classifier by positive-unlabelled learning.

Trusted positives (documents labelled good) and unlabelled web text train a logistic model by the
non-negative unbiased risk  prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)). The class prior is
estimated from how far the scores of unlabelled text reach into those of the positives. Negative
labels are not used. Features are Spark expressions over the text alone, and so is the score: one
projection, no user function. Texts are read once, into a table of features. The unlabelled side is every
training row: each step of a minimum is a job that sums risk, gradient and curvature over that table. At most
`positives` labelled rows, chosen by a hash of id and features, are held by the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, remainder, sealed, staged, table, words
from caselog.llm.quality_rules import STOP_WORDS
from caselog.sources.storage import save

MAX_POSITIVES = 8_000
#: Most steps to a minimum, each a reading of the table of features, and the least gain worth one.
MAX_STEPS, MIN_GAIN = 40, 1e-5
FOLDS = 5
THRESHOLD = 0.3

FEATURES = (
    "log_words word_length symbols shouts bars capitals digits stop_words distinct_words distinct_lines ends long_words doubled_words"
).split()


def with_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the features as one array column, `_f`; an empty text has defined values as any other."""
    t, w = F.col("_t"), F.col("_w")
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    df = staged(
        df,
        {"_t": or_empty(F.col(text))},
        {"_w": words(t), "_l": F.filter(F.split(t, "\n"), lambda x: x != "")},
        {
            "_n": F.greatest(F.size(w), F.lit(1)).cast("double"),
            "_c": F.greatest(F.length(F.array_join(w, "")), F.lit(1)).cast("double"),
            "_stop": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))),
            "_long": F.size(F.filter(w, lambda x: F.length(x) > 20)),
            "_doubled": F.size(F.filter(F.transform(w, lambda x, i: x == F.get(w, i - 1)), lambda same: same)),
            "_dw": F.size(F.array_distinct(w)),
            "_dl": F.size(F.array_distinct("_l")) / F.greatest(F.size("_l"), F.lit(1)),
        },
    )
    n, c = F.col("_n"), F.col("_c")
    values = {
        "log_words": F.log(n),
        "word_length": F.least(c / n, F.lit(30.0)),
        "symbols": F.least(count(r"[#*$%&<>]") / n, F.lit(3.0)),
        "shouts": F.least(count("!") / n, F.lit(3.0)),
        "bars": F.least(count(r"\|") / n, F.lit(3.0)),
        "capitals": count("[A-Z]") / c,
        "digits": count("[0-9]") / c,
        "stop_words": F.col("_stop") / n,
        "distinct_words": F.col("_dw") / n,
        "distinct_lines": F.col("_dl"),
        "ends": F.least(count("[.?]") / n, F.lit(3.0)),
        "long_words": F.col("_long") / n,
        "doubled_words": F.col("_doubled") / n,
    }
    made = F.array(*[values[f].cast("double") for f in FEATURES])
    return df.withColumn("_f", made).drop("_t", "_w", "_l", "_n", "_c", "_stop", "_long", "_doubled", "_dw", "_dl")


def expanded(x: np.ndarray) -> np.ndarray:
    """Standardised features and their squares."""
    return np.hstack([x, x * x])


def with_bias(x: np.ndarray, mean: list[float], scale: list[float]) -> np.ndarray:
    """The model's inputs of rows of features: standardised values, their squares, and one for the bias."""
    z = np.clip((x - np.array(mean)) / np.array(scale), -8, 8)
    return np.hstack([expanded(z), np.ones((len(z), 1))])


@dataclass(frozen=True)
class Risk:
    """A value, its gradient and its matrix of second derivatives by the weights. Risks add and scale as numbers do."""

    value: float
    gradient: np.ndarray
    curvature: np.ndarray

    def __add__(self, other: Risk) -> Risk:
        return Risk(self.value + other.value, self.gradient + other.gradient, self.curvature + other.curvature)

    def after(self, step: np.ndarray) -> float:
        """The value after a step, by the parabola."""
        return float(self.value + self.gradient @ step + step @ self.curvature @ step / 2)

    def __rmul__(self, k: float) -> Risk:
        return Risk(k * self.value, k * self.gradient, k * self.curvature)


def summed_risk(z: np.ndarray, weights: np.ndarray, label: int) -> Risk:
    """Logistic loss of the rows, summed, if all of them had the label, 1 or -1."""
    g = z @ weights
    share = 1 / (1 + np.exp(np.clip(label * g, -60, 60)))
    return Risk(float(np.logaddexp(0, -label * g).sum()), -label * (share @ z), (z * (share * (1 - share))[:, None]).T @ z)


def corpus_risk(rows: DataFrame, mean: list[float], scale: list[float], weights: np.ndarray) -> Risk:
    """`summed_risk` of all rows as negatives. Each task sends its sums only, which are added in a shuffle by their place."""
    size = len(weights)

    def summed(batches):
        total = Risk(0.0, np.zeros(size), np.zeros((size, size)))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            total += summed_risk(with_bias(x, mean, scale), weights, -1)
        values = np.concatenate([[total.value], total.gradient, total.curvature[np.triu_indices(size)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["place", "part"])

    parts = rows.select("_f").mapInArrow(summed, "place int, part double")
    values = np.zeros(1 + size + size * (size + 1) // 2)
    for r in parts.groupBy("place").agg(F.sum("part").alias("sum")).collect():
        values[r["place"]] = r["sum"]
    curvature = np.zeros((size, size))
    curvature[np.triu_indices(size)] = values[1 + size :]
    return Risk(values[0], values[1 : 1 + size], curvature + np.triu(curvature, 1).T)


def pu_risks(unlabelled: Risk, pos: np.ndarray, weights: np.ndarray, prior: float) -> tuple[Risk, Risk]:
    """The two parts of the unbiased risk: prior * R_p(+), and R_u(-) - prior * R_p(-), that on negatives."""
    share = prior / len(pos)
    return share * summed_risk(pos, weights, 1), unlabelled + -share * summed_risk(pos, weights, -1)


def best_step(plain: Risk, clipped: Risk) -> np.ndarray:
    """The step to the least  plain + max(0, clipped), both as parabolas about the present weights.

    That is the greatest, over a factor c of 0 to 1, of  plain + c * clipped, which is convex for each of them. Where the
    whole second part would fall below zero, the factor that brings it to zero is found by halving.
    """

    def to(c: float) -> np.ndarray:
        both = plain + c * clipped
        return -np.linalg.solve(both.curvature, both.gradient)

    low, high = 0.0, 1.0
    if clipped.after(to(1.0)) >= 0:
        return to(1.0)
    for _ in range(40):
        c = (low + high) / 2
        low, high = (c, high) if clipped.after(to(c)) >= 0 else (low, c)
    return to(low)


def minimise(parts: Callable[[np.ndarray], tuple[Risk, Risk]], size: int, floor: float, decay: float = 1e-4) -> np.ndarray:
    """Weights of the least  plain + max(0, clipped) + decay * |weights|^2 / 2, where `parts(weights)` are the first two.
    Newton's steps from zero. A step that doesn't lower the sum is halved, and so is one to weights at which the second
    part is below `floor`: an estimate of a risk that no true risk has, and thus overfitted.
    """

    def decayed(w: np.ndarray) -> tuple[Risk, Risk]:
        plain, clipped = parts(w)
        return plain + Risk(decay * w @ w / 2, decay * w, decay * np.eye(size)), clipped

    total = lambda plain, clipped: plain + max(0.0, clipped)
    w, rate, here = np.zeros(size), 1.0, decayed(np.zeros(size))
    for _ in range(MAX_STEPS):
        now, step = total(*(x.value for x in here)), best_step(*here)
        gain = now - total(*(x.after(step) for x in here))
        if gain < MIN_GAIN or rate < 1e-3:
            break
        there = decayed(w + rate * step)
        if there[1].value >= floor and total(*(x.value for x in there)) <= now - 1e-4 * rate * gain:
            w, here, rate = w + rate * step, there, min(1.0, 2 * rate)
        else:
            rate /= 2
    return w


def prior_cuts(pos: np.ndarray) -> np.ndarray:
    """Thresholds to estimate the prior at, ascending. Tails of under a tenth of the positives are too thin to judge by."""
    return np.quantile(pos, np.linspace(0.0, 0.9, 91))


def estimate_prior(pos: np.ndarray, cuts: np.ndarray, reached: np.ndarray, n_unl: int) -> float:
    """Largest share of positives that unlabelled text can hold: the least ratio, over thresholds, of
    unlabelled to positive scores from the threshold on. `reached` counts the unlabelled ones at each cut."""
    above_pos = np.array([(pos >= c).mean() for c in cuts])
    margin = np.sqrt(np.log(20) / (2 * n_unl)) + np.sqrt(np.log(20) / (2 * len(pos)))
    return float(np.clip(np.min((reached / n_unl + margin / 2) / above_pos), 0.05, 0.95))


@dataclass(frozen=True)
class Model:
    prior: float = 0.5
    mean: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    scale: list[float] = field(default_factory=lambda: [1.0] * len(FEATURES))
    weights: list[float] = field(default_factory=lambda: [0.0] * (2 * len(FEATURES) + 1))

    def margin(self, features: Column) -> Column:
        """The score's log odds, as a Spark expression over the feature array."""
        z = F.lit(self.weights[-1])
        for i in range(len(FEATURES)):
            x = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.get(features, i) - self.mean[i]) / self.scale[i]))
            z = z + x * (self.weights[i] + x * self.weights[len(FEATURES) + i])
        return z

    def score(self, features: Column) -> Column:
        """Probability of a good text."""
        z = self.margin(features)
        return 1 / (1 + F.exp(F.greatest(F.lit(-60.0), F.least(F.lit(60.0), -z))))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of each row, as a table without texts."""
    return save(with_features(docs.select("doc_id", "text")).select("doc_id", "_f"), "quality-features")


def statistics(rows: DataFrame) -> tuple[int, list[float], list[float]]:
    """Number of rows, and the mean and scale of each feature over all of them. Rounded, so that the order in which
    Spark adds doesn't show."""
    each = [F.get("_f", F.lit(i)) for i in range(len(FEATURES))]
    mean = F.array(*[F.round(F.avg(x), 9) for x in each]).alias("mean")
    scale = F.array(*[F.greatest(F.round(F.stddev_pop(x), 9), F.lit(1e-3)) for x in each]).alias("scale")
    got = rows.agg(F.count("*").alias("n"), mean, scale).first()
    return got["n"], got["mean"], got["scale"]


def reached(rows: DataFrame, model: Model, cuts: np.ndarray) -> np.ndarray:
    """How many of all rows score at least each cut; the driver sees one count per interval of them."""
    passed = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= F.col("_z")))
    scores = sealed(rows.select(model.margin(F.col("_f")).alias("_z")))
    counts = {r["passed"]: r["count"] for r in scores.groupBy(passed.alias("passed")).count().collect()}
    return np.array([sum(n for k, n in counts.items() if k > i) for i in range(len(cuts))])


def sample(rows: DataFrame, size: int) -> np.ndarray:
    """Features of at most `size` rows, chosen by a hash, so that a sample doesn't depend on the layout of the files.
    Equal features of one id count once, so an id of many copies doesn't fill the sample."""
    one = rows.select("doc_id", "_f").distinct().orderBy(F.xxhash64("doc_id", "_f"), "doc_id", "_f").limit(size)
    got = one.select("_f").toArrow()["_f"].to_pylist()
    return np.array(got, dtype=float).reshape(-1, len(FEATURES))


def fit(rows: DataFrame, labels: DataFrame, positives: int = MAX_POSITIVES) -> Model:
    """Learn from a table of (doc_id, `_f`) and (doc_id, quality), leaving out the held-out fold.

    At most `positives` labelled rows are sampled. The unlabelled side is every training row: means, scales, the
    scores that the class prior is estimated from, and the risk, for which each step reads the table of features once.
    Without positives or other rows the model says 0.5 for every text.
    """
    training = remainder(F.col("doc_id"), FOLDS) != 0
    trusted = labels.where((F.col("quality") == 1) & training).select("doc_id").distinct()
    trusted = trusted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives)
    rows = rows.where(training)
    n, mean, scale = statistics(rows)
    pos = with_bias(sample(rows.join(F.broadcast(trusted), "doc_id"), positives), mean, scale) if n else []
    if not len(pos):
        return Model()
    unlabelled = lambda w: (1 / n) * corpus_risk(rows, mean, scale, w)
    half = 0.5 / len(pos)
    plain = minimise(lambda w: (half * summed_risk(pos, w, 1), 0.5 * unlabelled(w)), pos.shape[1], 0.0)
    scores = pos @ plain
    cuts = prior_cuts(scores)
    prior = estimate_prior(scores, cuts, reached(rows, Model(0.5, mean, scale, plain.tolist()), cuts), n)
    # A mean over so few positives errs by about this much, so an estimate as far below zero is none of overfitting.
    error = 1 / np.sqrt(len(pos))
    weights = minimise(lambda w: pu_risks(unlabelled(w), pos, w, prior), pos.shape[1], -error)
    return Model(prior, mean, scale, weights.tolist())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The frame's own columns, `score` and `predicted`; every row by itself, empty texts too."""
    rows = with_features(docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text")), "_text")
    rows = rows.select("_row", model.score(F.col("_f")).alias("_score"))
    predicted = F.when(F.col("_score") >= THRESHOLD, 1).otherwise(0).alias("_predicted")
    return sealed(rows.select("_row", "_score", predicted))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of each row of (doc_id, text). Null texts count as empty; repeated rows
    are scored each; labels of unknown ids and other columns play no part."""
    rows = features(docs)
    found = sealed(rows.select("doc_id", fit(rows, labels).score(F.col("_f")).alias("score")))
    held_out = (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out")
    return found.select("doc_id", held_out, "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows predicted good, with all their columns."""
    return scored(docs, fit(features(docs), labels)).where("_predicted = 1").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
