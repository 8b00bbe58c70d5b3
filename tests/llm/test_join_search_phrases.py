"""N-gram join, lexical search and phrase mining against plain versions: nulls, ties, repeated rows, empty tables, hot groups."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerfeat.llm import collocations, lexical_search, ngram_join
from test_corpus_operators import plain_groups, words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, node string, column string, block string, score string, rank string"


def docs(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, g, "n", "c", "b", "s", "r") for i, t, g in rows], DOCS)


# N-gram join ------------------------------------------------------------------------------------

def edited(base, rng, edits):
    out = list(base)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = f"e{rng.randrange(10**6)}"
        elif kind == 1:
            out.insert(at, f"e{rng.randrange(10**6)}")
        else:
            del out[at]
    return out


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(3)
    rows = [(None, "a text without an id at all", "x"), (900, None, "x"), (901, "", "x"), (902, " \n ", "x"), (903, "One two", "x"),
            (904, "one  TWO", "x"), (905, "one", "x"), (906, "y " * 20_000, "x")]
    shared = words(90, 2)
    for family in range(12):
        base = words(rng.choice([6, 20, 60, 150, 300]), 100 + family)
        for copy in range(14):
            text = edited(base, rng, rng.randrange(0, 1 + len(base) // 25))
            if family % 3 == 0:
                text += shared
            rows.append((family * 20 + copy, " ".join(text), "x"))
    rows += [(700, rows[20][1], "x"), (700, rows[60][1], "x"), (701, rows[20][1], "x"), (701, rows[20][1], "x")]
    return rows


def test_join_matches_all_pairs(spark, near_rows, monkeypatch):
    monkeypatch.setattr("test_corpus_operators.shingles", lambda t: (
        lambda w: {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set())((t or "").translate(FOLD).split()))
    expected = plain_groups(near_rows, 85)
    for cells in (1 << 18, 700):  # whole families in a block, and lists cut into parts
        monkeypatch.setattr(ngram_join, "CELLS", cells)
        found = ngram_join.ngram_join_groups(docs(spark, near_rows)).collect()
        assert len(found) == len(near_rows)
        assert {(r.id, r.component_id) for r in found if r.id is not None} == {(i, expected[i]) for i in expected}
    assert [r.component_id for r in found if r.id is None] == [None]
    assert {r.id: r.n_shingles for r in found if r.id in (900, 901, 902, 903, 905, 906)} == {900: 0, 901: 0, 902: 0, 903: 1, 905: 1, 906: 1}


def test_join_of_an_empty_table(spark):
    assert ngram_join.ngram_join_groups(docs(spark, [])).count() == 0


def test_lists_hold_every_linked_pair():
    """Rows that link have a listed column in common, whatever their sizes, under any order of frequency."""
    rng = random.Random(5)
    for trial in range(3000):
        n = rng.randrange(1, 60)
        a = set(rng.sample(range(10**6), n))
        b = set(rng.sample(sorted(a), n - rng.randrange(0, 1 + n // 6))) | set(rng.sample(range(10**6), rng.randrange(0, 1 + n // 6)))
        if 100 * len(a & b) < 85 * len(a | b):
            continue
        frequency = {c: rng.randrange(2, 6) for c in a | b}
        lists = []
        for row in (a, b):
            first = sorted(row)[:ngram_join.first_block(len(row), 85)]
            keep = len(first) - ngram_join.left_out(len(row), 85)
            lists.append(set(sorted(first, key=lambda c: (frequency[c], c))[:keep]))
        assert lists[0] & lists[1]


def test_block_product_counts_overlaps(monkeypatch):
    rng = np.random.default_rng(1)
    rows = [[np.unique(rng.integers(0, 40, rng.integers(0, 15))) for _ in range(9)] for _ in range(2)]
    sides = []
    for side in rows:
        columns, owner = np.concatenate(side), np.repeat(np.arange(9), [len(r) for r in side])
        order = np.argsort(columns, kind="stable")
        sides.append((columns[order], owner[order]))
    expected = {i * 9 + j: len(np.intersect1d(x, y)) for i, x in enumerate(rows[0]) for j, y in enumerate(rows[1]) if len(np.intersect1d(x, y))}
    for matches in (1 << 22, 3):
        monkeypatch.setattr(ngram_join, "MATCHES", matches)
        cells, values = ngram_join.overlaps(*sides, 9)
        assert dict(zip(cells.tolist(), values.tolist())) == expected


# Lexical search ---------------------------------------------------------------------------------

def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def plain_search(rows, items, top):
    held = [(i, terms_of(t)) for i, t, _ in rows]
    held = [(i, t) for i, t in held if t]
    n_docs, total = len(held), sum(len(t) for _, t in held)
    df = Counter(w for _, t in held for w in set(t))
    out = []
    for item, text in items:
        scored = []
        for doc, t in held:
            counts = Counter(t)
            m = 75 + (25 * len(t) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * counts[w]) // (1000 * counts[w] + 12 * m))
                    for w in terms_of(text) if counts[w])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:top])]
    return out


@pytest.fixture(scope="module")
def search_rows():
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(60)] + ["Éa", "éa", "x1", "日本"]
    rows = [(i, rng.choice([" ", ".", "\n", "--"]).join(rng.choice(pool) for _ in range(rng.randrange(0, 60))), "x") for i in range(150)]
    rows += [(200, None, "x"), (201, "", "x"), (202, "...", "x"), (None, "w1 w2 W3", "x"), (203, rows[5][1], "x"), (203, rows[5][1], "x"),
             (204, "w1 " * 30_000, "x")]
    return rows


ITEMS = [(1, "w1 W2, w2 unseen"), (2, "w1w2 w"), (3, None), (4, ""), (5, "Éa 日本 x1 a_w3"), (5, "w9"), (None, "w7 w8")]


def test_search_matches_plain_ranking(spark, search_rows, monkeypatch):
    items = spark.createDataFrame([(i, t, "r", "s") for i, t in ITEMS], "item_id long, text string, rank string, doc_id string")
    expected = sorted(plain_search(search_rows, ITEMS, 7), key=str)
    for block, scores, pool in ((1 << 20, 1 << 20, 1 << 16), (20, 14, 10)):  # one block, and one for nearly every item
        monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
        monkeypatch.setattr(lexical_search, "SCORES", scores)
        monkeypatch.setattr(lexical_search, "POOL", pool)
        found = lexical_search.ranked_search(docs(spark, search_rows), items, top=7).collect()
        assert sorted((tuple(r) for r in found), key=str) == expected


def test_search_of_empty_tables(spark, search_rows):
    schema = "item_id long, text string"
    assert lexical_search.ranked_search(docs(spark, []), spark.createDataFrame(ITEMS, schema)).count() == 0
    assert lexical_search.ranked_search(docs(spark, search_rows), spark.createDataFrame([], schema)).count() == 0
    assert lexical_search.ranked_search(docs(spark, search_rows), spark.createDataFrame([(1, "...")], schema)).count() == 0


# Phrases ----------------------------------------------------------------------------------------

def plain_phrases(rows, least, longest, covered, top):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            for n in range(1, longest + 1):
                counts.update((lang or "und", tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    by_lang = {}
    for (lang, p), a in candidates.items():
        inside = any(l == lang and len(q) > len(p) and 100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                     for (l, q), b in candidates.items())
        if not inside:
            cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, r + 1, x[2].decode(), -x[1], x[3], x[4], totals[lang], -x[0])
                  for lang, found in by_lang.items() for r, x in enumerate(sorted(found)[:top]))


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(25)] + ["Été", "a_b"]
    line = "the Quick brown fox jumps over w1 w2"
    rows = []
    for i in range(220):
        parts = [rng.choice([line, " ".join(rng.choice(pool) for _ in range(rng.randrange(0, 12)))]) for _ in range(4)]
        rows.append((i, rng.choice([". ", ",", "\n", "  ", "\t", " "]).join(parts), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, line, "en"), (300, None, "en"), (301, "", None), (302, ".,;", "en"), (303, rows[0][1], "fr"), (303, rows[0][1], "fr"),
                   (304, "deep sea " * 20_000, "long"), (305, "x" * 50_000, "long")]


@pytest.mark.parametrize("longest,top", [(3, 2000), (4, 9)])
def test_phrases_match_plain_counts(spark, phrase_rows, monkeypatch, longest, top):
    expected = plain_phrases(phrase_rows, 10, longest, 50, top)
    for text_slice, bits in ((1 << 20, 1 << 28), (300, 1 << 10)):  # small portions and a filter that lets much through
        monkeypatch.setattr(collocations, "TEXT_SLICE", text_slice)
        monkeypatch.setattr(collocations, "CHUNK_SLICE", text_slice)
        monkeypatch.setattr(collocations, "FILTER_BITS", bits)
        found = collocations.collocations(docs(spark, phrase_rows), longest=longest, top=top).collect()
        assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found) == expected


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 4_000_000_000_000
    monkeypatch.setattr(collocations, "dictionary", lambda *_: spark.createDataFrame(
        [("en", 2, b"a b", big), ("en", 1, b"a", 7), ("en", 1, b"b", big)], "lang string, own int, chunk binary, freq long"))
    (row,) = collocations.collocations(docs(spark, [])).collect()
    assert (row.a, row.l, row.r, row.score) == (big, big + 7, 2 * big, 10**6 * big * big // ((big + 7) * 2 * big))


def test_phrases_of_an_empty_table(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0


def test_every_phrase_belongs_to_one_chunk():
    text = "a b c d e f g h. i j k\n" * 3 + " ".join(f"w{i}" for i in range(200))
    starts, _, first = collocations.piece_words(text.encode())
    chunks = collocations.parse(text.encode())
    assert sum(own for own, _ in chunks) == len(starts) and len(chunks) > first.sum()
    assert all(own <= len(chunk.split()) <= own + 2 for own, chunk in chunks)


def test_lists_shuffle_their_entries_once(spark):
    rows = spark.createDataFrame([(1, 2, 2, [5, 6]), (2, 2, 2, [6, 7]), (2, 2, 2, [6, 7]), (3, 1, 1, [9])],
                                 "node long, n long, listed long, first array<long>")
    lists = ngram_join._lists(rows)
    assert lists._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(column#") == 1
    assert sorted((r["node"], r["column"]) for r in lists.collect()) == [(1, 6), (2, 6)]
