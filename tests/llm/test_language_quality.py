"""Languages and quality against plain recomputation, planted cases and held-out rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import GERMAN, frame, odd_rows, prose
from pyspark.sql import functions as F

from qualitymart.llm import language, quality
from qualitymart.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, prose(k, 80), "en") for k in range(60)] + [(100 + k, prose(k, 80, GERMAN), "de") for k in range(60)]
    return language.learn(frame(spark, rows), "text", "lang")


def test_counts_are_those_of_all_texts(spark, odd, model):
    names, chances = model
    assert names == ["de", "en"] and np.allclose(chances.sum(0), 1)
    names, chances = language.learn(odd, "text", "lang")
    expected = {}
    for r in odd_rows():
        if r[1] is not None and r[2] is not None:
            expected[r[2]] = expected.get(r[2], np.full(language.BUCKETS, 0.5)) + language.trigrams(r[1])
    assert names == sorted(expected)
    assert np.allclose(chances, np.stack([expected[n] / expected[n].sum() for n in names], 1))


def test_languages_held_in_turn(spark, odd, monkeypatch):
    whole = language.learn(odd, "text", "lang")
    monkeypatch.setattr(language, "HELD", 1)
    again = language.learn(odd, "text", "lang")
    assert whole[0] == again[0] and (whole[1] == again[1]).all()


def test_faulty_labels_are_bounded(spark):
    """Of more languages than asked for, those named by most rows are learned, from all of their texts."""
    rows = [(k, prose(k, 40), "en") for k in range(30)] + [(100 + k, prose(k, 40, GERMAN), "de") for k in range(30)]
    junk = [(1000 + k, prose(k, 3), f"label {k:04}") for k in range(700)] + [(2000, None, "zz"), (2001, None, "zz")]
    names, chances = language.learn(frame(spark, rows + junk), "text", "lang", most=3)
    assert names == ["de", "en"]  # the third most frequent has null texts alone
    assert np.allclose(chances, language.learn(frame(spark, rows), "text", "lang")[1])
    names, chances = language.learn(frame(spark, rows + junk), "text", "lang")
    assert names == ["de", "en", *(f"label {k:04}" for k in range(497))] and chances.shape == (language.BUCKETS, 499)


def test_em_raises_the_likelihood(model):
    counts = language.trigrams(prose(7, 60) + prose(8, 60, GERMAN))
    full = np.flatnonzero(counts)
    likelihoods = [language.shares(model[1][full], counts[full].astype(float), n)[1] for n in range(0, 12)]
    assert all(b >= a - 1e-9 for a, b in zip(likelihoods, likelihoods[1:], strict=False))


def test_mixtures(model):
    names, chances = model
    share, chosen = language.infer(prose(501, 200), chances)
    assert [names[k] for k in chosen] == ["en"] and share[1] > 0.9
    share, chosen = language.infer(prose(501, 300) + " " + prose(502, 100, GERMAN), chances)
    assert [names[k] for k in chosen] == ["en", "de"] and 0.6 < share[1] < 0.9


def test_odd_documents(odd, none, model):
    found = language.identify(odd, *model).collect()
    assert len(found) == len(odd_rows())
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for k in (1, 2, 3, 4):
        assert (by_id[k].lang_pred, by_id[k].score) == ("und", 0.0)
    assert by_id[5].lang_pred == "en" and by_id[11].lang_pred == "de"
    assert all(0 <= r.score <= 1 and r.lang_pred in ("und", "en", "de") for r in found)
    assert language.identify(none, *model).collect() == []
    assert {r.lang_pred for r in language.identify(odd, *language.learn(none, "text", "lang")).collect()} == {"und"}


def test_stage_keeps_rows_whole(odd, none):
    kept = language.keep_known(odd)
    assert kept.columns == odd.columns and language.keep_known(none).collect() == []
    expected = Counter(r for r in odd_rows() if any(map(str.isalpha, r[1] or "")))
    assert set(map(tuple, kept.collect())) <= set(expected)
    assert sum(expected.values()) - kept.count() <= 3  # only mixtures without a half


def test_query_predicts_held_out_rows(spark, sf_dir):
    rows = QUERIES["op7_language_id"](spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert sum(right) / len(right) > 0.95


def test_held_out_rows_teach_nothing(spark):
    ids = [k for k in range(40) if zlib.crc32(str(k).encode()) % 3 == 1]
    docs = frame(spark, [(k, prose(k, 30), "xx" if k in ids else "en") for k in range(40)])
    names, _ = language.learn(docs.where(~language.held_out(F.col("doc_id"))), "text", "lang")
    assert names == ["en"]


JUNK = {
    "stutter": "Thhaen " * 60 + "be " * 30,
    "shouting": " ".join(w.upper() + "!!" for w in prose(1, 120).split()),
    "symbols": " ".join(w + "***" for w in prose(2, 120).split()),
    "columns": " | ".join(w for w in prose(3, 120).split()),
}


def corpus():
    good = [(k, prose(k, 30 + k)) for k in range(160)]
    bad = [(1000 + k, list(JUNK.values())[k % 4] + " " + prose(k, 5)) for k in range(32)]
    return good, bad


def test_posteriors_find_junk_without_labels():
    good, bad = corpus()
    votes = {i: quality.votes_of(quality.measures(t)) for i, t in good + bad}
    share, chance, posterior = quality.accuracies(Counter(votes.values()))
    assert all(posterior[votes[i]] > 0.5 for i, _ in good) and all(posterior[votes[i]] < 0.5 for i, _ in bad)
    assert abs(share - 160 / 192) < 0.1
    # labellers that vote on both kinds are found to be better than chance
    assert all(c[0][2] >= c[1][2] - 1e-9 for c in chance)


def test_scorer_follows_posteriors(spark):
    good, bad = corpus()
    rows = {r.doc_id: r for r in quality.score(frame(spark, good + bad)).collect()}
    assert all(rows[i].keep for i, _ in good) and not any(rows[i].keep for i, _ in bad)
    assert all(r.keep == (r.quality_score >= 0.5) for r in rows.values())
    kept = quality.keep_good(frame(spark, good + bad))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in good}


def test_quality_of_odd_documents(odd, none):
    rows = quality.score(odd).collect()
    assert len(rows) == len(odd_rows())
    scores = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(scores[k].quality_score == 0 and not scores[k].keep for k in (1, 2, 3, 4))
    assert scores[5].keep and scores[6].keep and not scores[16].keep
    assert quality.score(none).collect() == [] and quality.keep_good(none).collect() == []
    assert quality.keep_good(odd).columns == odd.columns


def test_query_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op2_quality_classifier"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    counts = {(r.quality, r.keep): r["count"] for r in rows.groupBy("quality", "keep").count().collect()}
    assert counts[1, True] / (counts[1, True] + counts.get((1, False), 0)) > 0.99
    assert counts[0, False] / (counts[0, False] + counts.get((0, True), 0)) > 0.9


def test_training_rows_are_bounded(spark, monkeypatch):
    """Copies of one text are one example, and no more examples than asked for reach the driver."""
    rows = [(k, prose(1, 80)) for k in range(300)] + [(1000 + k, prose(k, 30 + k)) for k in range(40)]
    seen = []
    fit = quality.fit_scorer
    monkeypatch.setattr(quality, "fit_scorer", lambda examples, **how: seen.append(len(examples)) or fit(examples, **how))
    quality.learn(frame(spark, rows), "text")
    quality.learn(frame(spark, rows), "text", trained=15)
    assert 30 <= seen[0] <= 41 and seen[1] <= 15



# --- plain recomputations of whole queries ----------------------------------


def plain_trigrams(text):
    raw = re.sub(r"[\s\d]+", " ", text.lower()).encode("utf-8", "replace")
    raw = b" " * (3 - len(raw)) + raw
    found = Counter()
    for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
        found[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 17] += 1
    return found


def plain_shares(counts, chances, steps):
    """Shares of languages and the log-likelihood, one trigram and one language at a time."""
    total, languages = sum(counts.values()), range(len(chances))
    share = [1 / len(chances) for _ in languages]
    for _ in range(steps if len(chances) > 1 else 0):
        new = [0.0 for _ in languages]
        for bucket, n in counts.items():
            parts = [chances[k](bucket) * share[k] for k in languages]
            for k in languages:
                new[k] += n * parts[k] / sum(parts) / total
        moved, share = max(abs(a - b) for a, b in zip(new, share, strict=True)), new
        if moved < 1e-4:
            break
    return share, sum(n * math.log(sum(chances[k](bucket) * share[k] for k in languages)) for bucket, n in counts.items())


def plain_languages(text, names, chances):
    counts = {b: n / 3 for b, n in plain_trigrams(text).items()}
    share, _ = plain_shares(counts, chances, 20)
    order = sorted(range(len(names)), key=lambda k: -share[k])
    chosen, best = order[:1], plain_shares(counts, [chances[order[0]]], 0)[1]
    for k in order[1:]:
        likelihood = plain_shares(counts, [chances[j] for j in [*chosen, k]], 12)[1]
        if share[k] <= 0.01 or likelihood - best <= math.log(sum(counts.values()) + 2):
            break
        chosen, best = [*chosen, k], likelihood
    return [names[k] for k in chosen], [share[k] for k in chosen]


def test_query_of_languages_against_plain_em(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    seen = {}
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None and r.text is not None:
            seen.setdefault(r.lang, Counter()).update(plain_trigrams(r.text))
    names = sorted(seen)
    chance = lambda c, total: lambda bucket: (c[bucket] + 0.5) / total
    chances = [chance(seen[n], seen[n].total() + 0.5 * language.BUCKETS) for n in names]
    found = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for r in docs:
        if not any(map(str.isalpha, r.text or "")):
            assert (found[r.doc_id].lang_pred, found[r.doc_id].score) == ("und", 0.0)
            continue
        expected, shares = plain_languages(r.text, names, chances)
        assert found[r.doc_id].languages == expected and found[r.doc_id].lang_pred == expected[0]
        assert np.allclose(found[r.doc_id].shares, shares, atol=1e-6) and abs(found[r.doc_id].score - shares[0]) < 1e-6


def plain_accuracies(votes, steps=100):
    """EM one document at a time: the share of good ones, each labeller's chances of a vote per class, and each document's posterior."""
    labellers = range(len(votes[0]))
    good = [0.05 if "-" in v else 0.95 for v in votes]
    for _ in range(steps):
        share = min(max(sum(good) / len(votes), 0.02), 0.98)
        chance = []
        for k in labellers:
            for_good, for_bad = ({"-": a * 0.002 * len(votes), "+": b * 0.002 * len(votes)} for a, b in ((0.2, 1.8), (1.8, 0.2)))
            for v, g in zip(votes, good, strict=True):
                if v[k] != "0":
                    for_good[v[k]] += g
                    for_bad[v[k]] += 1 - g
            chance.append([{x: n / sum(c.values()) for x, n in c.items()} for c in (for_good, for_bad)])
        for d, v in enumerate(votes):
            odds = math.log(share / (1 - share))
            for k in labellers:
                if v[k] != "0":
                    odds += math.log(chance[k][0][v[k]] + 1e-12) - math.log(chance[k][1][v[k]] + 1e-12)
            good[d] = 1 / (1 + math.exp(-odds))
    return share, chance, good


def plain_scorer(examples, epochs=12):
    """AdaGrad on one feature at a time; a feature listed twice counts twice and is moved by its last value."""
    weights, bias, seen, seen_bias, order = Counter(), 0.0, Counter(), 1e-6, np.random.default_rng(11)
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            features, target = examples[k]
            total = bias + sum(weights[b] * v for b, v in features)
            gap = 1 / (1 + math.exp(-min(max(total, -30), 30))) - target
            moved = {}
            for b, v in features:
                slope = gap * v + 1e-5 * weights[b]
                squares = seen[b] + slope * slope
                moved[b] = (weights[b] - 0.3 * slope / math.sqrt(squares + 1e-6), squares)
            for b, (weight, squares) in moved.items():
                weights[b], seen[b] = weight, squares
            seen_bias += gap * gap
            bias -= 0.3 * gap / math.sqrt(seen_bias)
    return weights, bias


def test_accuracies_against_plain_em():
    good, bad = corpus()
    votes = [quality.votes_of(quality.measures(t)) for _, t in good + bad]
    share, chance, posterior = quality.accuracies(Counter(votes))
    plain_share, plain_chance, plain_good = plain_accuracies(votes)
    assert abs(share - plain_share) < 1e-6
    assert np.allclose([posterior[v] for v in votes], plain_good, atol=1e-6)
    for k, (for_good, for_bad) in enumerate(plain_chance):
        assert np.allclose(chance[k][:, [0, 2]], [[c["-"], c["+"]] for c in (for_good, for_bad)], atol=1e-6)


def test_query_of_quality_against_plain_em_and_scorer(spark, sf_dir):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    votes = [quality.votes_of(quality.measures(t)) for _, t in docs]
    posterior = dict(zip(votes, plain_accuracies(votes)[2], strict=True))
    rows = {}
    for (_, text), vote in zip(docs, votes, strict=True):
        buckets, values = quality.features(text, quality.measures(text))
        rows[buckets.tobytes(), values.tobytes(), vote] = (list(zip(buckets.tolist(), values.tolist(), strict=True)), posterior[vote])
    rank = quality.accuracies(Counter(votes))[2]  # the order of examples only: posteriors can differ in their last digit
    examples = [rows[k] for k in sorted(rows, key=lambda k: (rank[k[2]], k[0], k[1]))]
    weights, bias = plain_scorer(examples)
    found = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    gaps = []
    for doc_id, text in docs:
        buckets, values = quality.features(text, quality.measures(text))
        total = bias + sum(weights[b] * v for b, v in zip(buckets.tolist(), values.tolist(), strict=True))
        expected = 1 / (1 + math.exp(-total)) if any(map(str.isalpha, text)) else 0.0
        gaps.append(abs(found[doc_id].quality_score - expected))
        assert found[doc_id].keep == (found[doc_id].quality_score >= 0.5)
    assert max(gaps) < 1e-6
