"""Token counts, packing and wavelet shards against the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import frame, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from qualitymart.llm import common, packing, token_counts, tokens, wavelet

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
BYTE, WORD = map(public_tokenizers.path, FILES)


def plain(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_ids_are_the_librarys(path, text):
    expected = plain_cache(path).encode(text, add_special_tokens=False).ids
    encoder = tokens.load(path)
    assert encoder.ids(text).tolist() == expected
    assert sum(encoder.pieces(encoder.pretokens(text))) == len(expected)


_CACHE = {}


def plain_cache(path):
    return _CACHE.setdefault(path, plain(path))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_of_latin_text_and_special_strings(path):
    rnd = random.Random(3)
    letters = [chr(c) for c in [*range(1, 0x234), *range(0x2010, 0x2060), 0x20AC]] + [" "] * 150 + ["\n"] * 40
    texts = ["".join(rnd.choice(letters) for _ in range(40)) for _ in range(1500)] + [t or "" for _, t, *_ in odd_rows()]
    texts += ["<|endoftext|>x <|startoftext|>", "a<|endoftext|>", "don't!'s we'LL", "Σς ΑΣ"]
    for text, encoding in zip(texts, plain_cache(path).encode_batch(texts, add_special_tokens=False), strict=True):
        assert tokens.load(path).ids(text).tolist() == encoding.ids, repr(text)


def test_unknown_shape_uses_the_library(tmp_path):
    import json

    config = json.load(open(BYTE))
    config["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(config))
    encoder = tokens.load(str(tmp_path / "t.json"))
    assert type(encoder) is tokens.Library
    assert encoder.ids("a b").tolist() == plain(str(tmp_path / "t.json")).encode("a b").ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_counts_of_odd_documents(odd, path, monkeypatch):
    monkeypatch.setattr(token_counts, "HELD", 50)
    found = sorted(map(str, token_counts.count_tokens(odd, path, limit=300).collect()))
    library = plain_cache(path)
    expected = []
    for doc_id, text, *_ in odd_rows():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append(f"Row(doc_id={doc_id}, n_bytes={len((text or '').encode())}, n_tokens={n}, over_limit={n > 300})")
    assert found == sorted(expected)


def test_counts_without_a_head_are_the_same(odd, monkeypatch):
    with_head = Counter(token_counts.count_tokens(odd, WORD).collect())
    monkeypatch.setattr(token_counts, "HEAD_CHARS", 0)
    assert Counter(token_counts.count_tokens(odd, WORD).collect()) == with_head


def test_counts_of_nothing(none):
    assert token_counts.count_tokens(none, WORD).collect() == []


def as_ids(path, text, end):
    return np.array([*plain_cache(path).encode(text or "", add_special_tokens=False).ids, end], "<u4")


def check_packing(pieces, rows, capacity):
    """Pieces rebuild the documents; places are gapless. Returns the number of sequences and of ids."""
    by_length = {}
    for doc_id, text in rows:
        by_length.setdefault(doc_id, []).append(as_ids(BYTE, text, 2))
    expected = Counter()
    for doc_id, documents in by_length.items():
        for ids in documents:
            first = (len(ids) - 1) % capacity + 1
            edges = [0, *range(first, len(ids) + 1, capacity)]
            expected.update((doc_id, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)))
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == expected
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(p.length for p in pieces)


def test_packing_of_odd_documents(odd):
    pieces = packing.pack(odd, BYTE, 2, 256).collect()
    check_packing(pieces, [(r[0], r[1]) for r in odd_rows()], 256)


def test_packing_is_close_to_the_least(spark):
    rnd = random.Random(5)
    rows = [(k, prose(k, rnd.randint(1, 150))) for k in range(600)]
    sequences, ids = check_packing(packing.pack(frame(spark, rows), BYTE, 2, 256).collect(), rows, 256)
    assert sequences <= 1.02 * -(-ids // 256) + 1


def test_packing_of_nothing(none):
    assert packing.pack(none, BYTE, 2).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_places_every_piece_once(histogram):
    runs = packing.plan(histogram, 40)
    assert {k: v for k, v in runs.placed.items() if v} == histogram
    table = sorted(runs.rows)
    used = Counter()
    spans = {}
    for k, (length, first, sequence, offset) in enumerate(table):
        after = table[k + 1][1] if k + 1 < len(table) and table[k + 1][0] == length else histogram.get(length, 0)
        for n in range(after - first):
            used[sequence + n] += length
            spans.setdefault(sequence + n, []).append((offset, length))
    assert all(v <= 40 for v in used.values())
    for places in spans.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
    first_fit = []
    for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        for k, space in enumerate(first_fit):
            if space >= length:
                first_fit[k] -= length
                break
        else:
            first_fit.append(40 - length)
    assert len(used) <= 1.25 * len(first_fit) + 2


def test_best_fit_is_best_fit_decreasing():
    rnd = random.Random(9)
    for _ in range(50):
        histogram = {rnd.randint(1, 30): rnd.randint(1, 12) for _ in range(10)}
        bins = []
        for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
            fitting = [k for k, space in enumerate(bins) if space >= length]
            if fitting:
                bins[min(fitting, key=lambda k: bins[k])] -= length
            else:
                bins.append(30 - length)
        runs = packing.Runs()
        packing.best_fit(runs, histogram, 30)
        assert runs.sequences == len(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 500), max_size=2500), st.integers(9, 17))
def test_wavelet_matrix(values, depth):
    ids = np.array(values, np.uint32)
    matrix = wavelet.WaveletMatrix.build(ids, depth)
    assert matrix.ids().tolist() == values
    for i in range(0, len(values), 97):
        assert matrix.access(i) == values[i]
    for token in {*values[:4], 501, -1, 1 << 20}:
        places = [i for i, v in enumerate(values) if v == token]
        assert matrix.count(token) == len(places)
        assert matrix.count(token, len(values) // 3, len(values) // 2) == sum(len(values) // 3 <= i < len(values) // 2 for i in places)
        assert [matrix.occurrence(token, j) for j in range(min(len(places), 5))] == places[:5]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_shards_round_trip(spark, odd):
    folder = common.new_folder(spark, "test")
    wavelet.write_tokens(odd, WORD, folder, 1, shard_tokens=500)
    found = wavelet.read_documents(spark, folder).collect()
    documents = Counter((r[0], as_ids(WORD, r[1], 1).tobytes()) for r in odd_rows())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter({(d, len(b) // 4, zlib.crc32(b)): n for (d, b), n in documents.items()})
    at = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert wavelet.read_shards(spark, folder).count() > 5
    everything = np.concatenate([np.frombuffer(b, "<u4") for (d, b), n in documents.items() for _ in range(n)])
    token = int(np.bincount(everything).argmax())
    total = sum(r.occurrences for r in wavelet.count_token(spark, folder, token).collect())
    assert total == (everything == token).sum() == wavelet.find_token(spark, folder, token).distinct().count()


def test_shards_of_nothing(spark, none):
    folder = common.new_folder(spark, "test")
    wavelet.write_tokens(none, WORD, folder, 1)
    assert wavelet.read_documents(spark, folder).collect() == []


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_texts_encoded_together_have_the_librarys_ids(path):
    texts = ["", "  ", "Café naïve l'été's 2024!", "a\x1cb \x1f c", "tail ", " head", "日本 mixed", "<|endoftext|> x", "it's – (ok)... ok", "\x85next\tline\n"]
    together = tokens.load(path).ids_of_all(texts * 2)
    assert [ids.tolist() for ids in together] == [plain_cache(path).encode(t, add_special_tokens=False).ids for t in texts * 2]


def test_each_distinct_word_of_a_group_is_looked_up_once():
    found = []

    class Counted(dict):
        def get(self, word):
            found.append(word)
            return super().get(word)

    encoder = tokens.load.__wrapped__(WORD)
    encoder.words = Counted()
    texts = ["one two two three"] * 50
    assert len(encoder.ids_of_all(texts)) == 50 and sorted(found) == ["one", "three", "two"]
    groups = list(wavelet.groups_of(iter([(0, "x" * wavelet.GROUP_CHARS), (1, "a"), (2, "b")])))
    assert [rows for rows, _ in groups] == [[0], [1, 2]] and list(wavelet.groups_of(iter([]))) == []
