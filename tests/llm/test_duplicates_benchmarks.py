"""Near duplicates and benchmark items against brute force, and the stages of the pipeline."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import regex
from conftest import frame, odd_rows, prose
from pyspark.sql import functions as F

from qualitymart.llm import common, decontaminate, jaccard_join
from qualitymart.llm.components import components


def grams(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def linked_components(rows, n, threshold):
    """Smallest reachable id of every id, by comparing all pairs."""
    sets, parent = {}, {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets.setdefault(doc_id, []).append(grams(text, n))
            parent[doc_id] = doc_id

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= threshold * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def check_components(spark, rows, found, n, threshold):
    expected = linked_components(rows, n, threshold)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter((i, len(grams(t, n)), expected.get(i)) for i, t in rows)


def family(seed, copies, length, changes):
    """A text and copies that each differ from the one before in some words: chains and near copies."""
    rnd = random.Random(seed)
    words = prose(seed, length).split()
    out = [" ".join(words)]
    for _ in range(copies):
        for _ in range(changes):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("n", "threshold"), [(4, 85), (5, 80)])
def test_links_of_families(spark, n, threshold):
    texts = [t for seed in range(14) for t in family(seed, 7, 30 + 37 * seed, 1 + seed // 3)]
    shared = prose(99, 60)
    texts += [prose(200 + k, 10 + 9 * k) + " " + shared for k in range(12)]
    texts += ["a b c", "A  b C", "a", "a", "b", "a b", " ".join(["go"] * 50), " ".join(["go"] * 9)]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    rows = [(order[k], t) for k, t in enumerate(texts)]
    found = jaccard_join.near_duplicates(frame(spark, rows).repartition(4), n, threshold).collect()
    check_components(spark, rows, found, n, threshold)


def test_links_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SENT", 0)
    rows = [(k, t) for k, t in enumerate(t for seed in range(5) for t in family(seed, 5, 60, 1))]
    check_components(spark, rows, jaccard_join.near_duplicates(frame(spark, rows)).collect(), 4, 85)


def test_large_keys_are_compared_in_blocks(spark, monkeypatch):
    """Of a key's pairs of different components, each is in one group; no group is larger than about two blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 40)
    parts = {1: [0] * 500 + [7] * 90 + list(range(1000, 1170)), 2: [0] * 300 + [5], 3: list(range(2000, 2200)), 4: [1, 2, 2]}
    table = spark.createDataFrame([(key, node, c) for key, of in parts.items() for node, c in enumerate(of)], "key long, node long, component long")
    keys = spark.createDataFrame([(key, len(of)) for key, of in parts.items()], "key long, n long")
    groups = {}
    for r in jaccard_join.compared(table, keys).collect():
        groups.setdefault(r.group, []).append((r.node, r.side, r.component))
    assert max(map(len, groups.values())) <= 3 * 40
    met = Counter()
    for members in groups.values():
        assert len({c for *_, c in members}) > 1 or len(members) == 1
        met.update((min(m, n), max(m, n)) for k, (m, s, c) in enumerate(members) for n, t, d in members[:k] if c != d and (s < 0 or s != t))
    assert met == Counter((m, n) for of in parts.values() for n, d in enumerate(of) for m, c in enumerate(of[:n]) if c != d)


@pytest.mark.parametrize("block", [3, 20])
def test_links_of_a_templated_family(spark, monkeypatch, block):
    """Near copies, variants around the threshold and members that are all just under it, in blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rnd = random.Random(4)
    base = prose(61, 150).split()

    def variant(changes):
        words = list(base)
        for at in rnd.sample(range(3, 147), changes):
            words[at] = f"v{rnd.randrange(10**6)}"
        return " ".join(words)

    texts = [variant(1) for _ in range(40)] + [variant(k) for k in range(3, 9) for _ in range(8)]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    found = jaccard_join.near_duplicates(frame(spark, rows).repartition(3)).collect()
    check_components(spark, rows, found, 4, 85)
    assert len({r.component_id for r in found}) > 2


def test_links_of_odd_documents(spark, odd, none):
    rows = [(r[0], r[1]) for r in odd_rows()]
    check_components(spark, rows, jaccard_join.near_duplicates(odd).collect(), 4, 85)
    assert jaccard_join.near_duplicates(none).collect() == []


def test_a_null_id_takes_no_links_away(spark):
    """All rows in one task, the null id ahead of the valid one with the same text."""
    near = family(31, 1, 80, 1)
    rows = [(None, near[0]), (1, near[0]), (2, near[1]), (None, near[1])]
    found = jaccard_join.near_duplicates(frame(spark, rows).coalesce(1)).collect()
    check_components(spark, rows, found, 4, 85)
    assert {r.doc_id: r.component_id for r in found} == {None: None, 1: 1, 2: 1}


def test_linked_sets_share_a_key():
    """The pigeonhole: sets at the threshold agree in a group, whatever their sizes."""
    rnd = np.random.default_rng(6)
    for _ in range(400):
        size = int(rnd.integers(1, 400))
        a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
        keep = int(np.ceil(len(a) * rnd.uniform(0.85, 1)))
        same = a[:keep]
        b = np.unique(np.concatenate([same, rnd.integers(0, 2**63, int(rnd.integers(0, max(1, len(a) // 6)))).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 85 * (len(a) + len(b) - shared):
            assert len(np.intersect1d(jaccard_join.group_keys(a, 85), jaccard_join.group_keys(b, 85)))
            assert jaccard_join.can_link(jaccard_join.count_vector(a)[None], jaccard_join.count_vector(b)[None], len(a), np.array([len(b)]), 85).all()
            assert shared <= jaccard_join.fine_overlap(jaccard_join.fine_vector(a), jaccard_join.fine_vector(b)) <= min(len(a), len(b))


def test_tree_finds_all_that_the_bound_allows():
    rnd = np.random.default_rng(8)
    base = rnd.poisson(2, (20, jaccard_join.AXES))
    points = np.repeat(base, 15, 0) + (rnd.random((300, jaccard_join.AXES)) < 0.02)
    points = points.astype(np.uint8)
    sizes = points.sum(1).astype(np.int64)
    tree = jaccard_join.Tree(points, sizes)
    for k in range(300):
        expected = np.flatnonzero(jaccard_join.can_link(points, points[k], int(sizes[k]), sizes, 85))
        assert sorted(tree.reach(points[k], int(sizes[k]), 85)) == expected.tolist()


def test_fine_vectors_bound_the_overlap_closely():
    rnd = np.random.default_rng(3)
    for size, other in ((1, 1), (300, 300), (3000, 2600), (100_000, 90_000)):
        a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: other // 2], rnd.integers(0, 2**63, other - other // 2).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        bound = jaccard_join.fine_overlap(jaccard_join.fine_vector(a), jaccard_join.fine_vector(b))
        assert shared <= bound <= min(len(a), len(b)) and bound <= shared + 0.35 * min(len(a), len(b)) + 1


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(60)] + [(200, 300), (200, 250), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {k: 0 for k in range(61)} | {k: 200 for k in (200, 250, 300)}


def test_one_of_each(spark, odd, none):
    kept = jaccard_join.one_of_each(odd)
    assert kept.columns == odd.columns and jaccard_join.one_of_each(none).collect() == []
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[6] == 1 and not ids[7] and not ids[8] and ids[None] == 2 and ids[9] == 1 and not ids[10]
    rows = [(5, "x y z w v u"), (5, "x y z w v u"), (5, "x y z w v u"), (6, "x y z w v u"), (7, "other text here")]
    assert sorted(r.doc_id for r in jaccard_join.one_of_each(frame(spark, rows)).collect()) == [5, 7]


def test_different_texts_under_one_id(spark):
    """Each text keeps its links: ids reached through either are one component, and neither text takes the other's place."""
    a, b, c = prose(31, 80), prose(32, 80), prose(33, 80)
    near = lambda text: text.replace(text.split()[40], "changed", 1)
    rows = [(1, a), (1, b), (1, b), (1, None), (2, near(a)), (3, near(b)), (4, c), (0, near(c)), (7, c)]
    check_components(spark, rows, jaccard_join.near_duplicates(frame(spark, rows).repartition(3)).collect(), 4, 85)
    kept = Counter((r.doc_id, r.text) for r in jaccard_join.one_of_each(frame(spark, rows)).collect())
    assert kept == Counter([(1, None), (2, near(a)), (3, near(b)), (0, near(c))])


WORDS = regex.compile(r"[\p{L}\p{N}]+")


def brute_items(docs, items, n=5, least=0.8):
    found = {}
    for doc_id, text in docs:
        for item_id, item in items:
            words, target = WORDS.findall((text or "").lower()), WORDS.findall((item or "").lower())
            k = min(n, len(target))
            if not k:
                continue
            have, want = ([tuple(w[j : j + k]) for j in range(len(w) - k + 1)] for w in (words, target))
            for at in range(len(have)):
                window = have[at : at + len(want)]
                shared = sum((Counter(window) & Counter(want)).values())
                similarity = shared / (len(window) + len(want) - shared)
                if similarity >= least - 1e-12:
                    found[doc_id, item_id] = max(similarity, found.get((doc_id, item_id), 0))
    return found


def contaminated():
    items = [(k, prose(700 + k, 12 + 5 * k)) for k in range(12)] + [(50, "two words"), (51, "Solo"), (52, ""), (53, None), (None, prose(790, 30)), (54, "la la la la la la la la la la la la")]
    docs = []
    for k in range(12):
        passage = items[k][1]
        words = passage.split()
        docs += [(10 * k, prose(k, 40) + "\n" + passage.upper() + " " + prose(k + 1, 20)), (10 * k + 1, passage), (10 * k + 2, " ".join(words[1:])), (10 * k + 3, " ".join(words[: len(words) // 2]))]
        words[len(words) // 2] = "changed"
        docs += [(10 * k + 4, prose(k + 5, 9) + " " + " ".join(words)), (10 * k + 5, prose(900 + k, 60))]
    return docs + [(500, "say two words now"), (501, "he went solo."), (502, "la " * 11), (503, "la " * 40), (504, None), (505, ""), (None, items[3][1]), (0, docs[0][1])], items


def pairs_of(rows):
    return {(r.doc_id, r.item_id): r.similarity for r in rows}


@pytest.mark.parametrize("sent", [decontaminate.SENT, 0])
def test_items_are_found(spark, monkeypatch, sent):
    monkeypatch.setattr(decontaminate, "SENT", sent)
    docs, items = contaminated()
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = decontaminate.find_items(frame(spark, docs), table).collect()
    expected = brute_items(docs, items)
    got = pairs_of(found)
    assert set(got) == set(expected) and len(found) == len(got)
    assert all(abs(got[k] - v) < 1e-9 for k, v in expected.items())
    assert {(10 * k, k) for k in range(12)} <= set(got) and not any((10 * k + 5, k) in got for k in range(12))


def test_long_items_are_not_sent_by_their_rows(spark, monkeypatch):
    """What is sent to all tasks is bounded by bytes; item blocks are sent without the items' n-grams."""
    asked = []
    ask = decontaminate.sent
    monkeypatch.setattr(decontaminate, "sent", lambda small: asked.append(small.columns) or ask(small))
    docs, items = contaminated()
    items = [*items, (0, items[1][1]), (1, items[1][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = pairs_of(decontaminate.find_items(frame(spark, docs), table).collect())
    assert got == pytest.approx(brute_items(docs, items))
    assert not any({"_iv", "_grams"} <= set(columns) for columns in asked)
    long = spark.range(60).select("id", F.sequence(F.lit(1), F.lit(1000)).cast("array<long>").alias("_grams"))
    assert decontaminate.sent(long) is not long
    monkeypatch.setattr(decontaminate, "SENT_BYTES", 400_000)
    assert decontaminate.sent(long) is long


def test_windows_meet_few_items(spark):
    """Items of one length: a window meets those that share its first n-gram, not all of its length."""
    items = spark.createDataFrame([(k, prose(3000 + k, 24)) for k in range(400)], "item_id long, text string")
    grams = items.select("item_id", decontaminate.words_of("text").alias("_w")).select("item_id", F.size("_w").alias("_n"), F.lit(5).alias("_k"), decontaminate.ngrams("_w", 5).alias("_grams"))
    index = decontaminate.candidates(grams.withColumn("_item_print", decontaminate.simhash("_grams")), decontaminate.RADIUS)
    assert index.groupBy("_ig", "_ib", "_iv", "_in", "_ik").count().agg(F.max("count")).first()[0] <= 4


def test_fingerprints_and_blocks(spark):
    rnd = random.Random(2)
    values = [[rnd.getrandbits(64) - 2**63 for _ in range(n)] for n in (1, 2, 7, 40)]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, h array<long>")
    for r in rows.select("k", decontaminate.simhash("h").alias("p")).collect():
        hashes = [v % 2**64 for v in values[r.k]]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert r.p % 2**64 == bits
    # any two prints within the radius share a block
    prints = [(rnd.getrandbits(64) - 2**63, rnd.sample(range(64), decontaminate.RADIUS)) for _ in range(50)]
    rows = spark.createDataFrame([(p, (p ^ sum(1 << b for b in bits) + 2**63) % 2**64 - 2**63) for p, bits in prints], "p long, q long")
    same = rows.select(decontaminate.block_values("p", 19).alias("a"), decontaminate.block_values("q", 19).alias("b")).collect()
    spans = decontaminate.blocks(19)
    assert sum(w for _, w in spans) == 64 and len(spans) == 20
    for (p, bits), r in zip(prints, same, strict=True):
        apart = {k for k, (a, w) in enumerate(spans) for b in bits if a <= b < a + w}
        assert len(apart) < 20 and len(r.a) == 20


def test_odd_documents_and_tables(spark, odd, none):
    items = spark.createDataFrame([(1, odd_rows()[5][1]), (2, "one two"), (3, None), (4, "buy buy buy buy buy buy buy")], "item_id long, text string")
    source = [(r[0], r[1]) for r in odd_rows() if r[0] is not None and r[0] not in (5, 12)]
    got = pairs_of(decontaminate.find_items(odd, items).collect())
    expected = brute_items(source, [(1, odd_rows()[5][1]), (2, "one two"), (4, "buy buy buy buy buy buy buy")])
    assert {k: v for k, v in got.items() if k[0] is not None and k[0] not in (5, 12)} == pytest.approx(expected)
    assert decontaminate.find_items(none, items).collect() == []
    assert decontaminate.find_items(odd, items.limit(0)).collect() == []
    kept = decontaminate.remove_contaminated(odd, items)
    assert kept.columns == odd.columns
    left = Counter(r.doc_id for r in kept.collect())
    assert not any(left[k] for k in (6, 7, 8, 9, 10, 16)) and left[None] == 2 and left[1] == 1 and left[11] == 1
    assert decontaminate.remove_contaminated(none, items).collect() == []


def test_benchmark_query_against_brute_force(spark, sf_dir):
    from qualitymart.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if len(r.text) < 20_000]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    short = {d for d, _ in docs}
    got = pairs_of(QUERIES["op5_benchmark_decontamination"](spark, sf_dir).collect())
    likely = [(d, t) for d, t in docs if any(" ".join(i.split()[3:8]) in " ".join(t.split()) or " ".join(i.split()[-8:-3]) in " ".join(t.split()) for _, i in items)]
    expected = brute_items(likely, items)
    assert {k: v for k, v in got.items() if k[0] in short} == pytest.approx(expected)


def test_join_query_against_brute_force(spark, sf_dir):
    from qualitymart.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check_components(spark, rows, QUERIES["op8_ngram_jaccard_join"](spark, sf_dir).collect(), 4, 85)


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Each stage against what it should do with what it was given; the last one's pieces cover what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    seen = {}
    frames = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = frames
        frames = common.stored(stage(spark, frames, sf_dir), name)
        assert frames.columns == docs.columns
        seen[name] = ({r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in frames.collect()})
    before, after = seen["language_id"]
    assert len(before) - len(after) <= 2
    before, after = seen["quality_classifier"]
    assert all((labels[i] == 1) >= (i in after) for i in before if i in labels and (labels[i] == 0)) or sum(labels.get(i) == 0 for i in after) <= 2
    assert sum(labels.get(i) == 1 for i in after) == sum(labels.get(i) == 1 for i in before)
    before, after = seen["near_duplicates"]
    expected = linked_components(list(before.items()), 5, 80)
    assert set(after) == {i for i, c in expected.items() if i == c}
    before, after = seen["benchmark_decontamination"]
    gone = {i for i in before if i not in after}
    found = brute_items([(i, t) for i, t in before.items() if i in gone], items)
    assert {i for i, _ in found} == gone
    pieces = corpus_pipeline.STAGES[-1][1](spark, frames, sf_dir).collect()
    assert {p.doc_id for p in pieces} == set(after)
    assert sum(p.length for p in pieces) <= 1024 * len({p.sequence_id for p in pieces})


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_odd_and_empty_documents(spark, sf_dir, odd, none, stage):
    name, run = stage
    assert run(spark, none, sf_dir).count() == 0
    found = run(spark, odd, sf_dir)
    assert found.count() > 0 and (name == "best_fit_packing" or found.columns == odd.columns)
