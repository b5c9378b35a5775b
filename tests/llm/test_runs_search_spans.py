"""Periodic runs, ranked search and repeated spans against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from conftest import frame, odd_rows, prose
from pyspark.sql import functions as F

from qualitymart.llm import lexical_search, periodic_runs, queries, repeated_spans

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall((text or "").encode())


def sha(data):
    return hashlib.sha256(data).hexdigest()


# --- periodic runs --------------------------------------------------------------


def all_runs(words, least=24, times=3):
    """Maximal stretches per period, without those that have a smaller one; every place and period is tried."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                stretch = words[i : i + length]
                if not any(all(stretch[k] == stretch[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def without_repetitions(words, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def check_runs(rows, found):
    expected = Counter()
    for doc_id, text in rows:
        words = words_of(text)
        runs = all_runs(words)
        expected[doc_id, len(words), tuple(runs), without_repetitions(words, runs)] += 1
    assert Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed.encode()) for r in found) == expected


def periodic_text(rnd):
    """Runs of many periods, some with runs inside, some cut short or broken by one word."""
    out = []
    for _ in range(rnd.randint(1, 4)):
        out += prose(rnd.randrange(10**6), rnd.randint(0, 40)).split()
        period = rnd.choice([1, 1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 23, 31, 32, 33, 50, 64, 70])
        part = [rnd.choice("abcd") for _ in range(period)] if rnd.random() < 0.5 else prose(rnd.randrange(10**6), period).split()
        if rnd.random() < 0.3:
            part = part + ["x"] * rnd.randint(8, 30)
        run = (part * 12)[: rnd.randint(2 * len(part), 5 * len(part) + 20)]
        if rnd.random() < 0.2:
            run[rnd.randrange(len(run))] = "broken"
        out += run
    return " ".join(out)


def test_runs_against_all_places_and_periods(spark):
    rnd = random.Random(3)
    texts = [periodic_text(rnd) for _ in range(150)]
    texts += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(20, 150))) for _ in range(60)]
    texts += [" ".join(["w"] * n) for n in (22, 23, 24, 25, 48, 100, 1000)]
    texts += [" ".join((["a"] * 30 + ["b"]) * 6), " ".join((["a", "b"] * 14 + ["c"]) * 4 + ["a", "b"] * 9)]
    rows = list(enumerate(texts))
    check_runs(rows, periodic_runs.find_runs(frame(spark, rows).repartition(3)).collect())


def test_runs_of_long_periods(spark):
    rnd = random.Random(8)
    rows = []
    for k, period in enumerate((127, 128, 129, 255, 400, 511, 512)):
        part = prose(900 + k, period).split()[:period]
        rows.append((k, " ".join(prose(950 + k, 30).split() + (part * 4)[: rnd.randint(3 * period - 1, 3 * period + 60)] + prose(970 + k, rnd.choice([0, 25])).split())))
    check_runs(rows, periodic_runs.find_runs(frame(spark, rows)).collect())


def test_runs_of_odd_documents(spark, odd, none, monkeypatch):
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] != 5]
    found = periodic_runs.find_runs(odd.where("doc_id is null or doc_id <> 5")).collect()
    check_runs(rows, found)
    monkeypatch.setattr(periodic_runs, "SENT", -1)  # without a broadcast
    assert sorted(map(str, periodic_runs.find_runs(odd.where("doc_id is null or doc_id <> 5")).collect())) == sorted(map(str, found))
    assert periodic_runs.find_runs(odd.where("doc_id = 5")).first().n_words == 30_000
    assert not periodic_runs.find_runs(none).collect()
    with pytest.raises(ValueError, match="24 words"):
        periodic_runs.find_runs(odd, least=10)


def test_query_of_runs(spark, tmp_path):
    rows = [(k, prose(k, 20 + 3 * k)) for k in range(120)] + [(500, None), (501, "a " * 40)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    for doc_id, text in rows:
        words, h = words_of(text), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, r = all_runs(words), found.pop(doc_id)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode())
        assert r.collapsed_sha256 == sha(without_repetitions(words, runs))
    assert not found


# --- ranked search ---------------------------------------------------------------


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def ranked(docs, items, top):
    """``item, rank, id, score`` by scoring every document."""
    found = [(i, terms(t)) for i, t in docs]
    found = [(i, t) for i, t in found if t]
    n_docs, n_terms = len(found), sum(len(t) for _, t in found)
    df = Counter(x for _, t in found for x in set(t))
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, of in wanted.items():
        scores = []
        for i, t in found:
            tf, m = Counter(t), 50 + 50 * len(t) * n_docs // n_terms
            value = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 20 * m)) for x in of if tf[x])
            if value > 0:
                scores.append((-value, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def test_ranking_against_all_scores(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK", 90)
    rnd = random.Random(5)
    vocabulary = sorted({w.strip(".") for w in prose(77, 400).split()})
    chances = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(k, " ".join(rnd.choices(vocabulary, chances, k=rnd.randint(1, 120)))) for k in range(600)]
    docs += [(1000 + k, docs[5][1]) for k in range(80)] + [(k, docs[9][1]) for k in (40, 41, 41)]
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 40)))) for k in range(25)] + [(90, docs[5][1]), (91, "nowhere"), (92, vocabulary[0])]
    rnd.shuffle(docs)
    for top in (7, 50):
        found = lexical_search.search(frame(spark, docs).repartition(3), spark.createDataFrame(items, "item_id long, text string"), top)
        assert sorted(map(tuple, found.collect()), key=str) == ranked(docs, items, top)


def test_ranking_of_odd_documents(spark, odd, none, monkeypatch):
    docs = [(r[0], r[1]) for r in odd_rows()]
    items = [(1, "one two the man"), (1, "buy WORD"), (2, None), (3, ""), (None, "İΣ 漢字 1²"), (4, "near old river, the house!"), (5, "... ?"), (6, docs[10][1])]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash")).withColumn("score", F.lit(1))
    assert sorted(map(tuple, lexical_search.search(odd, table).collect()), key=str) == ranked(docs, items, 50)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 100)  # many blocks of items
    assert sorted(map(tuple, lexical_search.search(odd, table, top=3).collect()), key=str) == ranked(docs, items, 3)
    assert not lexical_search.search(none, table).collect()
    assert not lexical_search.search(odd, table.where("item_id = 5")).collect()
    assert not lexical_search.search(odd, table.limit(0)).collect()


def test_tree_with_nested_paths():
    """Every path begins the next one; the tree stays shallow and bounds what is below."""
    paths = [(tuple(range(k)), ({t: 1 + k % 3 for t in range(k)}, 60 + k, [(0, k)])) for k in range(1, 1500)]
    deepest, stack = 0, [(lexical_search.tree_of(paths), 1)]
    while stack:
        node, depth = stack.pop()
        deepest = max(deepest, depth)
        for child in node.children:
            assert child.least_m >= node.least_m
            assert all(node.maxima[t] >= tf for t, tf in child.maxima.items())
            stack.append((child, depth + 1))
    assert deepest < 400


# --- repeated spans ----------------------------------------------------------------


def without_repeats(rows, n=20):
    """``id, n_words, n_removed, sha256`` of distinct documents by a scan in their order."""
    seen, out = set(), {}
    for doc_id, text in rows:
        words = words_of(text)
        gone = set()
        for k in range(len(words) - n + 1):
            window = tuple(words[k : k + n])
            if window in seen:
                gone.update(range(k, k + n))
            seen.add(window)
        out[doc_id, text] = (doc_id, len(words), len(gone), sha(b" ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def check_spans(rows, found, n=20):
    """Ids are distinct, or all rows of an id have the same text; null comes last."""
    expected = without_repeats(sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)), n)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == Counter(expected[r] for r in rows)
    for r in found:
        assert sum(s.end - s.start for s in r.spans or []) == r.n_removed


def shared_texts(seed):
    rnd = random.Random(seed)
    passages = [prose(seed * 100 + k, rnd.choice([19, 20, 21, 30, 90])).split() for k in range(8)]
    out = []
    for k in range(120):
        words = prose(seed * 1000 + k, rnd.randint(0, 60)).split()
        for _ in range(rnd.randint(0, 3)):
            at, part = rnd.randint(0, len(words)), list(rnd.choice(passages))
            if rnd.random() < 0.3:
                part[rnd.randrange(len(part))] = "edited"
            words[at:at] = part[rnd.choice([0, 0, 5]) :]
        out.append(" \n".join(words))
    out += [out[3]] * 10 + ["go " * n for n in (19, 20, 21, 22, 60)] + ["a b " * 30, "b a " * 30, "a b c " * 30]
    rnd.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spans_against_a_scan(spark, seed):
    rows = shared_texts(seed)
    check_spans(rows, repeated_spans.remove_repeats(frame(spark, rows).repartition(5)).collect())


def test_spans_with_hot_minimizers_and_without_broadcasts(spark, monkeypatch):
    """Where paths meet doesn't change what is found: all minimizers hot, tasks that pass their pieces on early, shuffles only."""
    rows = shared_texts(4)
    monkeypatch.setattr(repeated_spans, "SENT", 0)
    monkeypatch.setattr(repeated_spans, "HELD", 200)
    monkeypatch.setattr(repeated_spans, "AT_ONCE", 100)
    monkeypatch.setattr(repeated_spans, "hot_minimizers", lambda paths: paths.select("m").distinct().withColumn("_hot", F.lit(True)))
    check_spans(rows, repeated_spans.remove_repeats(frame(spark, rows).repartition(4)).collect())


def test_spans_of_odd_documents(spark, odd, none):
    rows = [(r[0], r[1]) for r in odd_rows()]
    rows = [r for r in rows if r[0] is not None] + [(None, t) for i, t in rows if i is None and t]
    check_spans(rows, repeated_spans.remove_repeats(odd.where("doc_id is not null or text is not null")).collect())
    assert not repeated_spans.remove_repeats(none).collect()
    assert {r.doc_id for r in repeated_spans.remove_repeats(odd).collect()} == {r[0] for r in odd_rows()}


def test_spans_of_repeated_ids(spark):
    """Different texts under one id are documents of their own, of which one keeps the shared passage."""
    shared = prose(1, 40)
    rows = [(1, prose(2, 30) + " " + shared), (1, prose(3, 30) + " " + shared), (1, prose(3, 30) + " " + shared), (2, shared)]
    found = repeated_spans.remove_repeats(frame(spark, rows)).collect()
    gone = Counter((r.doc_id, r.n_removed > 0) for r in found)
    assert gone[2, True] == 1
    assert sorted(gone.items()) in ([((1, False), 1), ((1, True), 2), ((2, True), 1)], [((1, False), 2), ((1, True), 1), ((2, True), 1)])


def test_spans_that_differ_at_their_source_stay(spark, monkeypatch):
    """Without verification a bad hash would remove words."""
    monkeypatch.setattr(repeated_spans, "compacted", lambda pieces, to=repeated_spans.compacted: to(pieces).unionByName(spark.sql("select 1L doc, 0L tie, 2 start, 25 words, 0L from_doc, 0L from_tie, 3 from_start")))
    rows = [(0, prose(1, 60)), (1, prose(2, 60)), (2, prose(1, 60))]
    found = {r.doc_id: r.n_removed for r in repeated_spans.remove_repeats(frame(spark, rows)).collect()}
    assert found == {0: 0, 1: 0, 2: 60}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = con.execute(queries.ORACLES[name])
    names = sorted(d[0] for d in expected.description)
    wanted = Counter(map(tuple, con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES[name]})").fetchall()))
    assert Counter(map(tuple, queries.QUERIES[name](spark, sf_dir).select(names).collect())) == wanted
