"""Quality from weak labels: overlapping heuristics, their accuracies by EM, and a hashed linear scorer.

Each labeller votes good, bad or nothing. Documents with the same votes form one pattern, and there are at
most 3 ^ labellers of them, so expectation-maximisation runs over pattern counts of the whole corpus: it
estimates how often each labeller that votes is right about good and about bad documents, and the posterior
of every pattern. A linear model on hashed features then learns the posteriors and scores all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.llm.common import small_batches
from qualitymart.llm.token_counts import texts_of

#: The scorer is trained on about this many documents at most, taken by a hash of their text.
TRAINED = 20_000
#: Buckets of hashed features.
BUCKETS = 1 << 14

# Frequent words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset(
    """the of and to in a is that it for on with as was are be by or an at this from
    der die das und in zu den ist von mit im für auf nicht ein eine des dem sich auch es
    le la les de des et un une en du que est pour dans qui au sur pas par plus il
    el los las y en un una que se por con del al lo para es no su""".split()
)
FUNCTION_FORMS = sorted(FUNCTION_WORDS | {w.capitalize() for w in FUNCTION_WORDS})
SYMBOLS = re.compile(r"[^\w\s.,;:'\"()?!-]+")
CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]{2,}")
ENDS = re.compile(r"[.!?](?=\s|$)")


def measures(text: str) -> dict[str, float]:
    """What the labellers look at, of a whole text."""
    words = text.split()
    counts = Counter(words)
    n = max(len(words), 1)
    letters = max(len(text) - n + 1, 1)
    lines = [x for x in text.split("\n") if x.strip()]
    common = counts.most_common(12)
    return {
        "words": len(words),
        "top": next((v for w, v in common if w.lower() not in FUNCTION_WORDS), 0) / n,
        "stutter": sum(map(eq, words, words[1:])) / n,
        "upper": sum(map(len, CAPITALS.findall(text))) / letters,
        "symbols": sum(map(len, SYMBOLS.findall(text))) / letters,
        "function": sum(counts[w] for w in FUNCTION_FORMS if w in counts) / n,
        "ends": len(ENDS.findall(text)) / n,
        "loud": text.count("!!") / n,
        "lines": len(lines),
        "repeated": 1 - len(set(lines)) / max(len(lines), 1),
        "distinct": len(counts) / n**0.8,
        "piped": text.count("|") / n,
    }


#: Each labeller by name: when it votes good, when bad; otherwise it has no vote.
LABELLERS = {
    "dominant word": (lambda m: m["words"] >= 20 and m["top"] < 0.08, lambda m: m["words"] >= 10 and m["top"] > 0.2),
    "stutter": (lambda m: m["words"] >= 20 and m["stutter"] < 0.02, lambda m: m["words"] >= 10 and m["stutter"] > 0.2),
    "capitals": (lambda m: m["upper"] < 0.05, lambda m: m["words"] >= 5 and m["upper"] > 0.3),
    "symbols": (lambda m: m["symbols"] < 0.03, lambda m: m["words"] >= 5 and m["symbols"] > 0.12),
    "function words": (lambda m: m["function"] > 0.15, lambda m: m["words"] >= 40 and m["function"] < 0.01),
    "sentences": (lambda m: 0.02 < m["ends"] < 0.3, lambda m: m["words"] >= 60 and m["ends"] < 0.003),
    "shouting": (lambda m: m["loud"] == 0, lambda m: m["words"] >= 5 and m["loud"] > 0.1),
    "columns": (lambda m: m["piped"] == 0, lambda m: m["words"] >= 5 and m["piped"] > 0.2),
    "repeated lines": (lambda m: m["lines"] >= 3 and m["repeated"] < 0.1, lambda m: m["lines"] >= 4 and m["repeated"] > 0.5),
    "vocabulary": (lambda m: m["words"] >= 20 and m["distinct"] > 1, lambda m: m["words"] >= 20 and m["distinct"] < 0.4),
}


def votes_of(m: dict[str, float]) -> str:
    return "".join("-" if bad(m) else "+" if good(m) else "0" for good, bad in LABELLERS.values())


def kind(c: str) -> str:
    return "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c


@lru_cache(maxsize=100_000)
def outline(edges: str) -> int:
    """Bucket of the kinds of a word's first and last two characters."""
    return zlib.crc32("".join(map(kind, edges)).encode("utf-8", "replace")) % (BUCKETS // 2)


@lru_cache(maxsize=10_000)
def step_bucket(name: str, step: int) -> int:
    return BUCKETS // 2 + zlib.crc32(f"{name} {step}".encode()) % (BUCKETS // 2)


def features(text: str, m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: shares of word outlines in the lower half, steps of the measures in the upper."""
    edges = Counter([w[0] + w[-2:] for w in text.split()])
    total = max(m["words"], 1)
    found: dict[int, float] = {}
    for e, n in edges.items():
        found[outline(e)] = found.get(outline(e), 0.0) + n / total
    buckets = [*found, *(step_bucket(k, int(np.log2(v + 1) * 2) if k in ("words", "lines") else int(min(v, 2) * 20)) for k, v in m.items())]
    values = np.concatenate([np.sqrt(np.fromiter(found.values(), np.float32, len(found))), np.full(len(m), 0.5, np.float32)])
    return np.array(buckets, np.int32), values


def accuracies(patterns: dict[str, int], steps: int = 100) -> tuple[float, np.ndarray, dict[str, float]]:
    """EM over ``{votes: documents}``: the share of good documents, the chance of each vote (labeller, class,
    vote) and the posterior of good per pattern. It starts from the view that any vote for bad is right, and
    smoothing towards labellers that are mostly right keeps the classes from changing places."""
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    votes = np.array([["-0+".index(c) for c in k] for k in keys]).reshape(len(keys), -1)
    good = np.where((votes == 0).any(1), 0.05, 0.95)
    prior = np.array([[[0.2, 0, 1.8], [1.8, 0, 0.2]]]) * 0.002 * n.sum()  # [good, bad][vote]
    chance, share = np.zeros(0), 0.5
    for _ in range(steps):
        share = float(np.clip((good * n).sum() / n.sum(), 0.02, 0.98))
        chance = np.repeat(prior, votes.shape[1], 0)
        for k in range(votes.shape[1]):
            chance[k, 0] += np.bincount(votes[:, k], good * n, 3)
            chance[k, 1] += np.bincount(votes[:, k], (1 - good) * n, 3)
        chance[:, :, 1] = 0
        chance /= chance.sum(2, keepdims=True)
        logs = np.log(chance + 1e-12)
        logs[:, :, 1] = 0  # no vote says nothing
        like = [sum(logs[k, c][votes[:, k]] for k in range(votes.shape[1])) for c in (0, 1)]
        good = 1 / (1 + np.exp(np.clip(np.log((1 - share) / share) + like[1] - like[0], -500, 500)))
    return share, chance, dict(zip(keys, good.tolist(), strict=True))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 12) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels by AdaGrad, in a fixed order."""
    weights, bias, seen = np.zeros(BUCKETS), 0.0, np.full(BUCKETS + 1, 1e-6)
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            buckets, values, target = rows[k]
            gap = 1 / (1 + np.exp(-np.clip(bias + weights[buckets] @ values, -30, 30))) - target
            slope = gap * values + 1e-5 * weights[buckets]
            seen[buckets] += slope * slope
            weights[buckets] -= 0.3 * slope / np.sqrt(seen[buckets])
            seen[-1] += gap * gap
            bias -= 0.3 * gap / np.sqrt(seen[-1])
    return weights, bias


def learn(texts: DataFrame, text_column: str, trained: int = TRAINED) -> tuple[np.ndarray, float] | None:
    """The scorer's weights and bias, learned from the texts alone; None for an empty table."""
    small_batches(texts.sparkSession)
    rows = texts.select(F.coalesce(text_column, F.lit("")).alias("_text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter(votes_of(measures(text)) for _, text in texts_of(batch, 0))
            yield pa.record_batch([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["votes", "n"])

    counted = rows.mapInArrow(judge, "votes string, n long").groupBy("votes").agg(F.sum("n")).collect()
    if not counted:
        return None
    _, _, posterior = accuracies({r[0]: r[1] for r in counted})
    share = min(1.0, trained / sum(r[1] for r in counted))
    sample = rows.where(F.pmod(F.xxhash64("_text"), F.lit(1_000_000)) < int(np.ceil(share * 1_000_000)))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, text in texts_of(batch, 0):
                m = measures(text)
                out.append((*features(text, m), votes_of(m)))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = [pa.list_(pa.int32()), pa.list_(pa.float32()), pa.string()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["buckets", "vals", "votes"])

    # texts with the same features are one example, however often they occur, so the number is a bound
    examples = sample.mapInArrow(featured, "buckets array<int>, vals array<float>, votes string").distinct()
    table = examples.orderBy(F.xxhash64("buckets", "vals"), "votes").limit(trained).toArrow()
    examples = [(np.asarray(b.values), np.asarray(v.values), posterior.get(p.as_py(), 0.5)) for b, v, p in zip(table["buckets"], table["vals"], table["votes"], strict=True)]
    return fit_scorer(sorted(examples, key=lambda e: (e[2], e[0].tobytes(), e[1].tobytes())))


def good_chance(text: str, weights: np.ndarray, bias: float) -> float:
    buckets, values = features(text, measures(text))
    return float(1 / (1 + np.exp(-np.clip(bias + weights[buckets] @ values, -30, 30))))


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.5) -> DataFrame:
    """``doc_id, quality_score, keep`` of every row; ``keep`` is a score of at least ``least``.

    Null and empty texts and those without a letter have score 0 and aren't kept. Ids aren't looked at;
    repeated rows are scored as often as they occur. An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, text_column))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([good_chance(t, *model.value) if any(map(str.isalpha, t)) else 0.0 for _, t in texts_of(batch, 1)])
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64()), pa.array(scores >= least, pa.bool_())], ["doc_id", "quality_score", "keep"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(judge, f"doc_id {kind}, quality_score double, keep boolean")


def keep_good(docs: DataFrame, text_column: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, columns as they are."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, text_column))

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        batch = pa.record_batch([texts], ["text"])
        return pa.array([any(map(str.isalpha, t)) and good_chance(t, *model.value) >= least for _, t in texts_of(batch, 0)], pa.bool_())

    return docs.where(good(F.col(text_column)))
