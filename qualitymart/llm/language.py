"""Languages of a document as a mixture, inferred by expectation-maximisation.

Every language is a distribution over hashed byte trigrams, counted over all training texts. A document is
a mixture of languages: EM finds the shares under which its trigrams are most likely. Languages enter the
document's set in order of their share as long as the likelihood, refitted with each, rises by more than
a penalty that grows with the logarithm of the text's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitymart.llm.common import small_batches
from qualitymart.llm.token_counts import texts_of

#: Buckets of hashed trigrams.
BUCKETS = 1 << 15
#: Overlapping trigrams repeat what their neighbours say, so each counts as this part of an observation.
WEIGHT = 1 / 3
UNDETERMINED = "und"
#: At most this many languages are learned; the model has 256 KB for each, so it has at most 125 MB.
LANGUAGES = 500
#: Languages whose counts a task holds before it passes them on.
HELD = 64


def trigrams(text: str) -> np.ndarray:
    """How often each bucket occurs among the byte trigrams of the lower-cased text."""
    raw = np.frombuffer(re.sub(r"[\s\d]+", " ", text.lower()).encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        raw = np.concatenate([np.full(3 - len(raw), 32, np.uint32), raw])
    codes = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761)
    return np.bincount(codes >> 17, minlength=BUCKETS)


def learn(texts: DataFrame, text_column: str, language_column: str, most: int = LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order, and the probability of each bucket (row) in each language (column).

    Rows with a null text or language teach nothing. If the rows name more than ``most`` languages, as faulty labels
    can, those that most rows name are learned (of equally many, the first in the alphabet), from all of their texts.
    What comes to the driver is one number per learned language and bucket.
    """
    small_batches(texts.sparkSession)
    rows = texts.select(F.col(language_column).alias("_lang"), F.col(text_column).alias("_text")).where("_lang is not null")
    named = rows.groupBy("_lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "_lang").limit(most).select("_lang")
    rows = rows.where("_text is not null").join(F.broadcast(named), "_lang", "left_semi").select("_lang", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for language, counts in held.items():
                full = np.flatnonzero(counts)
                yield pa.record_batch([pa.array([language] * len(full), pa.string()), pa.array(full.astype(np.int32)), pa.array(counts[full])], ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            languages = batch.column(0).to_pylist()
            for k, text in texts_of(batch, 1):
                if languages[k] not in held and len(held) >= HELD:
                    yield from told()
                held.setdefault(languages[k], np.zeros(BUCKETS, np.int64))
                held[languages[k]] += trigrams(text)
        yield from told()

    summed = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    counts = np.zeros((BUCKETS, len(languages)))
    place = {language: k for k, language in enumerate(languages)}
    counts[found["bucket"].to_numpy(), [place[x] for x in found["lang"].to_pylist()]] = found["n"].to_numpy()
    counts += 0.5
    return languages, counts / counts.sum(0)


def shares(chances: np.ndarray, counts: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """EM: shares of the columns of ``chances`` in a document, and its log-likelihood."""
    total, languages = counts.sum(), chances.shape[1]
    share = np.full(languages, 1 / languages)
    for _ in range(steps if languages > 1 else 0):
        each = chances * share
        last, share = share, (counts / each.sum(1)) @ each / total
        if abs(share - last).max() < 1e-4:
            break
    return share, float(counts @ np.log(chances @ share + 1e-300))


def infer(text: str, chances: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Shares of all languages, and the selected ones in order of their share."""
    counts = trigrams(text)
    full = np.flatnonzero(counts)
    seen, counts = chances[full], counts[full].astype(float) * WEIGHT
    share, _ = shares(seen, counts, 20)
    order = np.argsort(-share, kind="stable")
    penalty = np.log(counts.sum() + 2)
    chosen, best = 1, shares(seen[:, order[:1]], counts, 0)[1]
    while chosen < len(order) and share[order[chosen]] > 0.01:  # a smaller part isn't a language of the document
        likelihood = shares(seen[:, order[: chosen + 1]], counts, 12)[1]
        if likelihood - best <= penalty:
            break
        chosen, best = chosen + 1, likelihood
    return share, [int(k) for k in order[:chosen]]


def mostly_one(text: str, chances: np.ndarray, least: float) -> bool:
    """Whether one language is selected, or the first of several has at least ``least`` of the text."""
    share, chosen = infer(text, chances)
    return len(chosen) == 1 or bool(share[chosen[0]] >= least)


def identify(docs: DataFrame, languages: list[str], chances: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, languages, shares`` of every row.

    ``score`` is the predicted language's share. A null text, one without a letter, and every text if no
    language was learned is ``und`` with score 0. Ids aren't looked at and may be null or repeated.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast((languages, chances))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = model.value
        for batch in batches:
            predicted, scores, sets, parts = [], [], [], []
            for _, text in texts_of(batch, 1):
                if not names or not any(map(str.isalpha, text)):
                    found = (UNDETERMINED, 0.0, [], [])
                else:
                    share, chosen = infer(text, table)
                    found = (names[chosen[0]], float(min(max(share[chosen[0]], 0.0), 1.0)), [names[k] for k in chosen], [float(share[k]) for k in chosen])
                for column, value in zip((predicted, scores, sets, parts), found, strict=True):
                    column.append(value)
            out = [batch.column(0), pa.array(predicted, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64()))]
            yield pa.record_batch(out, ["doc_id", "lang_pred", "score", "languages", "shares"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double, languages array<string>, shares array<double>")


def held_out(doc_id: Column) -> Column:
    """A third of the ids, for testing; null ids aren't in it."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def keep_known(docs: DataFrame, least: float = 0.5, text_column: str = "text", language_column: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are in one language, or have at least ``least`` of their text in one; columns as
    they are.

    The languages are learned from the rows that name one. Null texts and those without a letter go, and
    all rows if no language was learned.
    """
    languages, chances = learn(docs, text_column, language_column)
    model = docs.sparkSession.sparkContext.broadcast((languages, chances))

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        names, table = model.value
        batch = pa.record_batch([texts], ["text"])
        return pa.array([bool(names) and any(map(str.isalpha, t)) and mostly_one(t, table, least) for _, t in texts_of(batch, 0)], pa.bool_())

    return docs.where(known(F.col(text_column)))
