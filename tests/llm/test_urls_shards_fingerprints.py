"""URL verdicts, shards and fingerprints against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import frame, odd_rows, prose
from pyspark.sql import functions as F

from qualitymart.llm import fingerprint, sharding, url_filter
from qualitymart.llm.queries import RULES


def host_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def rule_of(host, path):
    fitting = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(r.host + r.path), default=None)


URLS = [
    None, "", "example.com/en/", "https://example.com/en/1", "https://WWW.Example.COM/en/1?x=/y#z", "http://a.net/es/2", "http://net/es/", "http://a.net/de/",
    "https://notexample.com/en/9", "http://a.net?q=/es/", "ftp://x.net#/es/", "http://é.ÀB.net/fr/ü", "a://b://c.net/es/1", "http://com", "http://com/", "x" * 5000, "http://h.org/\nnext/line?a&b=1&c=2",
]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(k, u, "<p>", "h") for k, u in enumerate(URLS)] + [(3, URLS[3], "", ""), (None, None, None, None)], "page_id long, url string, html string, host string")
    labelled = spark.createDataFrame([(f"https://spam{k}.biz/a?x={k}&y=1&z=2", True) for k in range(40)] + [(f"https://good.org/text/{k}", False) for k in range(40)] + [("http://q", None)], "url string, block boolean")
    rows = url_filter.judge(pages, RULES, labelled, trees=5).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = None if r.page_id is None else URLS[r.page_id]
        assert (r.host, r.path) == host_path(url), url
        rule = rule_of(*host_path(url))
        assert r.rule == (rule.host + rule.path if rule else None)
        assert r.verdict == (rule.verdict if rule else "block" if r.block_score > 0.5 else "allow")


def test_trees_learn_labels(spark):
    bad = [f"https://w{k}-win.biz/p{k * 77}/x{k}?id={k}&u=1&v=2" for k in range(120)]
    good = [f"https://news.org/story/{chr(97 + k % 20)}title" for k in range(120)]
    labelled = spark.createDataFrame([(u, True) for u in bad[::2]] + [(u, False) for u in good[::2]], "url string, block boolean")
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(bad[1::2] + good[1::2])], "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in url_filter.judge(pages, [], labelled, trees=5).collect()}
    assert all(v == ("block" if k < 60 else "allow") for k, v in verdicts.items())


def test_few_distinct_labelled_urls(spark):
    """Many rows of two urls, of which each label keeps one however few may train."""
    labelled = spark.createDataFrame([("https://bad.biz/?a=1&b=2", True)] * 70 + [("https://good.org/a", False)] * 30, "url string, block boolean")
    pages = spark.createDataFrame([(1, "https://bad.biz/?a=1&b=2"), (2, "https://good.org/a")], "page_id long, url string")
    for trained in (1, 3, 200):
        assert len(url_filter.judge(pages, [], labelled, trees=3, trained=trained).collect()) == 2


def test_features_against_plain_python(spark):
    """Entropy, lengths, depth, digits and parameters of every odd url."""
    rows = spark.createDataFrame([(u,) for u in URLS if u is not None], "_url string")
    plan = url_filter.parsed(rows)
    for r in plan.select("_url", "_host", "_path", *(F.expr(v).cast("double").alias(k) for k, v in url_filter.FEATURES.items())).collect():
        url, (host, path) = r["_url"], host_path(r["_url"])
        counts = Counter(url)
        expected = {
            "f_length": len(url), "f_host_length": len(host), "f_labels": host.count(".") + 1, "f_depth": path.count("/"),
            "f_last_segment": len(path.rsplit("/", 1)[-1]), "f_digits": sum(c in "0123456789" for c in url) / max(1, len(url)),
            "f_path_digits": sum(c in "0123456789" for c in path), "f_parameters": url.count("&") + url.count("?"),
            "f_marks": sum(not (c.isascii() and c.isalnum()) for c in url) / max(1, len(url)), "f_fragment": float("#" in url),
            "f_secure": float(url.startswith("https:")), "f_capitals": sum("A" <= c <= "Z" for c in url),
            "f_entropy": -sum(n / len(url) * math.log2(n / len(url)) for n in counts.values()) if url else 0.0,
        }
        for name, value in expected.items():
            if "\n" not in url or name != "f_last_segment":
                assert r[name] == pytest.approx(value, abs=1e-9), (name, url)


def test_statistics_of_labels_are_not_shuffled_to(spark):
    """A few last labels hold nearly all urls: the pages stay where they are."""
    suffixes = spark.createDataFrame([("com", 5, 1.0)], "_suffix string, _n long, _bad double")
    urls = url_filter.parsed(spark.range(10).selectExpr("concat('https://a.com/', id) as _url"))
    plan = url_filter.with_features(urls, suffixes, 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize(("labels", "verdict"), [([], "allow"), ([("http://a.org/", True)], "block"), ([("http://a.org/", False)], "allow")])
def test_one_kind_of_label(spark, labels, verdict):
    labelled = spark.createDataFrame(labels, "url string, block boolean")
    pages = spark.createDataFrame([(1, "http://b.org/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(pages, RULES, labelled).collect()] == [verdict]
    assert url_filter.judge(pages.limit(0), RULES, labelled).collect() == []


def check_shards(rows, source, shards):
    texts = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in source)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts
    slots, sizes, homes = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        homes[r.text_crc32, r.size].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes, homes


def test_shards_of_odd_documents(odd):
    source = [(r[0], r[1]) for r in odd_rows()]
    sizes, homes = check_shards(sharding.shard(odd, 3).collect(), source, 3)
    # the longest text outweighs all others, so it has a shard of its own
    assert max(sizes.values()) == 8 + max(len((t or "").encode()) for _, t in source)
    assert all(len(h) == 1 for key, h in homes.items() if key[1] > 8)


def test_shards_are_even_around_a_hot_text(spark):
    rows = [(k, prose(k, 20 + k % 60)) for k in range(400)] + [(1000 + k, "the same text") for k in range(200)]
    sizes, homes = check_shards(sharding.shard(frame(spark, rows), 8).collect(), rows, 8)
    assert len(sizes) == 8 and max(sizes.values()) / min(sizes.values()) < 1.02
    assert all(len(h) == 1 for h in homes.values())


def test_fixed_capacity(spark):
    rows = [(k, "a" * (k % 90)) for k in range(300)] + [(999, "b" * 5000)]
    found = sharding.shard(frame(spark, rows), shards=None, capacity=2000).collect()
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    assert sum(v > 2000 for v in sizes.values()) == 1 and len(found) == 301
    assert len(sizes) <= sum(v for v in sizes.values() if v <= 2000) / 2000 * 1.15 + 2


def test_fixed_capacity_holds_for_mixed_sizes(spark):
    """Texts of two sizes in one class of sizes: no shard is larger than its capacity."""
    rows = [(k, chr(97 + k % 26) + f"{k:05d}" + "x" * (9_990 + 4 * (k % 2))) for k in range(400)]
    found = sharding.shard(frame(spark, rows), shards=None, capacity=1_000_000).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert max(r.n for r in found) <= 1_000_000 and len(found) <= 5


def test_shards_of_nothing(none):
    assert sharding.shard(none, 24).collect() == []


def test_plan_takes_the_tightest_shard():
    rnd = random.Random(4)
    for _ in range(100):
        classes = [(size, rnd.randint(1, 6), float(size)) for size in rnd.sample(range(1, 60), 8)]
        classes.sort(key=lambda c: -c[2])
        bins = []
        for size, n, _ in classes:
            for _ in range(n):
                fitting = [k for k, space in enumerate(bins) if space >= size]
                if fitting:
                    bins[min(fitting, key=lambda k: bins[k])] -= size
                else:
                    bins.append(100 - size)
        assert sharding.place(classes, 100, None)[1] == len(bins)


def check_edits(rows, source):
    """``source`` in descending order of id."""
    expected = []
    for k, (doc_id, text) in enumerate(source):
        text, after = text or "", source[(k + 1) % len(source)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == Counter(expected)
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))


def test_edits_in_order_of_ids(spark):
    rows = [(k * 7 % 101, prose(k, 3 + k % 40) if k % 9 else ("" if k % 2 else None)) for k in range(101)]
    found = fingerprint.edit_report(frame(spark, rows).repartition(5)).collect()
    check_edits(found, sorted(rows, reverse=True, key=lambda r: r[0]))


def test_edits_of_odd_documents(odd, spark, none):
    distinct = {}
    for r in odd_rows():
        if r[0] is not None:
            distinct[r[0]] = r[1]
    one_each = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_edits(fingerprint.edit_report(one_each).collect(), sorted(distinct.items(), reverse=True))
    rows = fingerprint.edit_report(odd).collect()
    assert len(rows) == len(odd_rows())
    same = defaultdict(set)
    for r in rows:
        same[r.doc_id].add(r.fingerprint)
    assert same[6] == same[7] and same[1] == same[2] and len(same[8] | same[6]) == 2
    assert fingerprint.edit_report(none).collect() == []
    single = fingerprint.edit_report(frame(spark, [(5, "abcd")])).collect()
    check_edits(single, [(5, "abcd")])
    assert single[0].near_next == 1.0


def test_edits_with_hot_ids(spark):
    """Rows without an id, or that share one, are cut into ranges too, and follow the order of a hash of their text."""
    rows = [(None, prose(k, 5)) for k in range(300)] + [(7, prose(1000 + k, 5)) for k in range(300)] + [(k * 10, prose(2000 + k, 5)) for k in range(300)]
    docs = frame(spark, rows).repartition(4)
    found = fingerprint.edit_report(docs).collect()
    ties = {(r[0], r[1]): r[2] for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()}
    down = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, ties[r]), reverse=True)
    check_edits(found, down)
    placed = fingerprint.texts(docs, "doc_id", "text").withColumn("_tie", F.xxhash64("_text"))
    bounds = fingerprint.cuts(placed, "doc_id", "_tie", 16)
    sizes = placed.groupBy(fingerprint.range_of(bounds, fingerprint.position("doc_id", "_tie"))).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 2 * len(rows) / 16


def test_order_of_paragraphs_insertion_and_deletion(spark):
    a, b, c = (prose(k, 30) for k in range(3))
    rows = frame(spark, [(1, f"{a}\n{b}\n{c}"), (2, f"{c}\n{a}\n{b}"), (3, f"{a}\n{b}"), (4, c), (5, f"{a}\n{a}\n{b}")])
    lanes = {r.doc_id: r for r in fingerprint.fingerprints(rows).collect()}
    assert lanes[1].lanes == lanes[2].lanes != lanes[3].lanes != lanes[5].lanes
    both = spark.createDataFrame([(lanes[3].lanes, lanes[4].lanes, lanes[1].lanes)], "x array<long>, y array<long>, z array<long>")
    sums = both.select(fingerprint.combine("x", "y"), fingerprint.combine("z", "y", -1)).first()
    assert sums[0] == lanes[1].lanes and sums[1] == lanes[3].lanes


def test_likeness_follows_what_is_shared(spark):
    sentences = [prose(k, 12) for k in range(200)]
    rows = frame(spark, [(k, " ".join(sentences[: 100 - k] + sentences[100 : 100 + k])) for k in (0, 10, 50, 90)])
    wide = fingerprint.fingerprints(rows).withColumn("base", F.first("lanes").over(fingerprint.Window.orderBy("doc_id")))
    found = {r.doc_id: r[1] for r in wide.select("doc_id", fingerprint.likeness("base", "lanes")).collect()}
    assert found[0] == 1.0 and abs(found[10] - 0.9) < 0.1 and abs(found[50] - 0.5) < 0.2 and found[90] < 0.35
