"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation finds,
without any true label, how often each labeller is right among good and among bad documents, and
from that the probability that a document is good. Votes are counted by pattern on the executors;
there are at most 3 ** len(LABELLERS) patterns, whatever the number of documents, so EM runs on
that small table. The posterior labels then train a logistic scorer on hashed word features.
It learns from a bounded, hash-drawn sample; vote counts and scores cover every whole text.

Edge cases: null and empty texts get every vote that their lack of words brings and a score from
the bias alone; ties at 0.5 are kept; repeated rows are scored one by one; an empty table gives
an empty result; columns named like a result are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.word_hashes import word_hashes

#: Votes by SQL over the document's measures: (name, good if, bad if).
LABELLERS = (
    ("length", "words >= 60", "words < 20"),
    ("letters", "letters >= 0.75 * chars", "letters < 0.6 * chars"),
    ("word_length", "chars BETWEEN 4 * words AND 8 * words", "chars < 3 * words OR chars > 12 * words"),
    ("capitals", "capitals < 0.1 * letters", "capitals > 0.3 * letters"),
    ("signs", "signs < 0.06 * chars", "signs > 0.12 * chars"),
    ("repeats", "distinct_lines >= 0.9 * lines AND distinct_words >= 0.3 * words", "distinct_lines < 0.7 * lines OR distinct_words < 0.15 * words"),
    ("ends", "text RLIKE '[.!?\"]\\\\s*$'", "NOT text RLIKE '[.!?\"]\\\\s*$' AND words < 40"),
)
SAMPLE_ROWS = 2000
BUCKETS = 1 << 14
RESULTS = ("posterior", "score", "kept")


def _measured(docs: DataFrame) -> DataFrame:
    count = "length(regexp_replace(text, '{}', ''))"
    words = r"split(text, '\\s+')"
    lines = r"split(text, '\\n')"
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).selectExpr(
        "*",
        "greatest(length(text), 1) AS chars",
        f"{count.format(r'[^\\p{L}]+')} AS letters",
        f"{count.format(r'[^\\p{Lu}]+')} AS capitals",
        f"{count.format(r'[\\p{L}\\p{N}\\s]+')} AS signs",
        f"size({words}) AS words",
        f"size(array_distinct({words})) AS distinct_words",
        f"size({lines}) AS lines",
        f"size(array_distinct({lines})) AS distinct_lines",
    )


def voted(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep with pattern, the votes in order as text: g, b or - for each labeller."""
    votes = ", ".join(f"CASE WHEN {good} THEN 'g' WHEN {bad} THEN 'b' ELSE '-' END" for _, good, bad in LABELLERS)
    return _measured(docs.select("text", *[c for c in keep if c != "text"])).selectExpr(*keep, f"concat({votes}) AS pattern")


def accuracies(counts: dict[str, int], rounds: int = 100) -> tuple[float, np.ndarray]:
    """The share of good documents and, by class (bad, good), labeller and vote (b, -, g), the vote's probability."""
    patterns = np.array([["b-g".index(v) for v in p] for p in counts], int).reshape(len(counts), -1)
    n = np.array(list(counts.values()), float)
    good = 1 / (1 + np.exp(-(patterns - 1).sum(1)))  # majority vote to begin with
    share, chance = 0.5, np.full((2, patterns.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        share = float((n * good).sum() / n.sum())
        for c, weight in enumerate((n * (1 - good), n * good)):
            for k in range(patterns.shape[1]):
                chance[c, k] = (np.bincount(patterns[:, k], weight, 3) + 1) / (weight.sum() + 3)
        good = posteriors(patterns, share, chance)
    return share, chance


def posteriors(patterns: np.ndarray, share: float, chance: np.ndarray) -> np.ndarray:
    which = np.arange(patterns.shape[1])
    odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9)) + np.log(chance[1, which, patterns] / chance[0, which, patterns]).sum(1)
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def pattern_posteriors(counts: dict[str, int]) -> dict[str, float]:
    if not counts:
        return {}
    share, chance = accuracies(counts)
    patterns = np.array([["b-g".index(v) for v in p] for p in counts], int)
    return dict(zip(counts, posteriors(patterns, share, chance).tolist()))


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the buckets of its words and their weights: square roots of counts, of length 1 together."""
    for _, hashes, bounds in word_hashes(column):
        buckets = (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
        for begin, end in zip(bounds[:-1], bounds[1:]):
            bucket, n = np.unique(buckets[begin:end], return_counts=True)
            weight = np.sqrt(n)
            yield bucket, weight / max(np.sqrt((weight**2).sum()), 1e-9)


def trained(texts: list[str], labels: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Weights of the buckets and the bias, by AdaGrad on the log loss of soft labels."""
    rows = list(features(pa.array(texts, pa.string())))
    weights, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-3)
    balance = {True: 0.5 / max((labels >= 0.5).mean(), 1e-3), False: 0.5 / max((labels < 0.5).mean(), 1e-3)}
    for _ in range(rounds):
        for (bucket, value), label in zip(rows, labels):
            odds = weights[bucket] @ value + weights[-1]
            slope = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - label) * balance[bool(label >= 0.5)]
            step = slope * value + 1e-6 * weights[bucket]
            squares[bucket] += step**2
            weights[bucket] -= 0.3 * step / np.sqrt(squares[bucket])
            squares[-1] += slope**2
            weights[-1] -= 0.3 * slope / np.sqrt(squares[-1])
    return weights


def learnt(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Posterior by vote pattern and the scorer's weights.

    The scorer learns from about sample_rows documents, drawn by hash with the same chance:
    that is its documented bound.
    """
    votes = voted(docs, ["doc_id"])
    counts = {r["pattern"]: r["n"] for r in votes.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    posterior = pattern_posteriors(dict(sorted(counts.items())))
    total = sum(counts.values())
    if not total:
        return posterior, np.zeros(BUCKETS + 1)
    drawn = docs.where(f"pmod(xxhash64(doc_id, 5), 1000003) < {min(1.0, sample_rows / total) * 1000003!r}")
    sample = sorted(tuple(r) for r in voted(drawn, ["text"]).collect())
    labels = np.array([posterior[p] for _, p in sample])
    return posterior, trained([t for t, _ in sample], labels) if sample else np.zeros(BUCKETS + 1)


def _scorer(shared, columns: list[str]) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posterior, weights = shared.value
        for batch in batches:
            odds = [weights[b] @ v + weights[-1] for b, v in features(batch.column("__text"))]
            scores = 1 / (1 + np.exp(-np.clip(np.array(odds, float), -50, 50)))
            of = np.array([posterior.get(p, 0.5) for p in batch.column("__pattern").to_pylist()], float)
            # Votes and words see different faults: a document goes if both together speak against it.
            out = [pa.array(of), pa.array(scores), pa.array(of + scores >= 1.0)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *out], [*columns, *RESULTS])

    return score


def scored(docs: DataFrame, keep: list[str], model: tuple[dict[str, float], np.ndarray]) -> DataFrame:
    """keep with posterior (from the votes), score (from the words) and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep).schema
    rows = voted(docs, [*dict.fromkeys([*keep, "text"])])
    rows = rows.select(*keep, F.col("pattern").alias("__pattern"), F.col("text").alias("__text"))
    results = [T.StructField("posterior", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return rows.mapInArrow(_scorer(shared, keep), T.StructType([*kept, *results]))
