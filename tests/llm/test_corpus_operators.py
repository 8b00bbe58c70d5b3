"""Corpus operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import html
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerfeat.llm import (chat_format, decontaminate, fingerprints, html_extract, labels, lm_score, mixing, near_dedup,
                            quality, subword, substring_dedup, text, toxicity)
from ledgerfeat.llm.components import components

DOCS = "doc_id long, text string, source string, key string, size string, removed_words string"


def words(n, seed, vocabulary=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def docs(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, s, "k", "s", "r") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def sample():
    base = words(300, 1)
    near = base[:150] + ["changed"] + base[151:]
    shared = words(80, 2)
    rows = [(1, " ".join(base), "a"), (2, " ".join(near), "a"), (3, " ".join(base).upper(), None), (4, None, "b"), (5, "", "b"),
            (6, "one two", "b"), (7, "one  two", None), (8, " ".join(words(120, 3) + shared + words(90, 4)), "c"),
            (9, " ".join(words(70, 5) + shared + words(60, 6)), "c"), (9, " ".join(words(70, 5) + shared + words(60, 6)), "c"),
            (None, "text without an id", "c"), (10, "x" * 200_000, "a"), (11, "y " * 50_000, "a"), (12, " \n\t ", "d")]
    return rows


def shingles(t):
    w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_groups(rows, percent):
    """Components over all pairs."""
    ids = sorted({i for i, _, _ in rows if i is not None})
    sets = {}
    for i, t, _ in rows:
        sets.setdefault(i, []).append(shingles(t))
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(ids, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def test_near_duplicates_match_all_pairs(spark, sample):
    rng = random.Random(8)
    rows = list(sample)
    for g in range(6):  # chains and clusters around the limit
        base = words(rng.choice([6, 9, 30, 120]), 100 + g, 50_000)
        for _ in range(12):
            copy = [w if rng.random() > 0.02 else f"new{rng.randrange(10**6)}" for w in base]
            rows.append((100 + len(rows), " ".join(copy), "z"))
    for percent in (80, 85):
        found = near_dedup.near_duplicate_groups(docs(spark, rows), percent=percent).collect()
        assert len(found) == len(rows)
        expected = plain_groups(rows, percent)
        assert {(r["id"], r["component_id"]) for r in found} == {*expected.items(), (None, None)}
        assert all(r["kept"] == (r["id"] == r["component_id"]) for r in found if r["id"] is not None)


def test_near_duplicates_keep_one_row_per_group(spark, sample):
    kept = near_dedup.drop_near_duplicates(docs(spark, sample))
    assert kept.columns == ["doc_id", "text", "source", "key", "size", "removed_words"]
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 4, 5, 6, 8, 9, 10, 11, 12]
    assert kept.where("doc_id IS NULL").count() == 1
    assert near_dedup.drop_near_duplicates(docs(spark, [])).count() == 0


def test_large_group_of_copies_is_one_component(spark):
    base = words(100, 9)
    rows = []
    for i in range(300):
        copy = list(base)
        copy[i % 100] = f"edit{i}"
        rows.append((i, " ".join(copy), "a"))
    rows.append((999, " ".join(base), "a"))
    found = near_dedup.near_duplicate_groups(docs(spark, rows), percent=85)
    assert {r["component_id"] for r in found.collect()} == {0}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_bounds():
    assert near_dedup.least_overlap(48, 85) < 0.85 * 48
    lengths = near_dedup.prefix_lengths(85)
    assert lengths[0] == 0 and lengths[1] == 1 and all(1 <= n <= s for s, n in enumerate(lengths) if s)


def test_mix_meets_targets(spark, sample):
    rows = sample + [(20 + i, " ".join(words(40 + i, i)), "bcd"[i % 3]) for i in range(60)]
    found = mixing.mix(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    again = {(r["doc_id"], r["size"], r["taken"]) for r in mixing.mix(docs(spark, rows)).collect()}
    assert again == {(r["doc_id"], r["size"], r["taken"]) for r in found}
    total = sum(r["size"] for r in found)
    assert total == sum(len((t or "").split()) for _, t, _ in rows)
    by_source = {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    names = sorted((s for s in by_source if s is not None)) + [None]
    caps = {s: 2 * sum(r["size"] for r in by_source[s]) for s in names}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    targets, left, budget = {}, set(names), 1.5 * total
    while left:  # the excess is shared anew until none is above
        share = {s: budget * weights[s] / sum(weights[x] for x in left) for s in left}
        above = {s for s in left if share[s] > caps[s]}
        if not above:
            targets |= share
            break
        for s in above:
            targets[s], budget = caps[s], budget - caps[s]
        left -= above
    for s, rs in by_source.items():
        assert rs[0]["target"] == pytest.approx(targets[s])
        assert abs(sum(r["taken"] for r in rs) - targets[s]) <= 1


def test_mix_of_nothing_and_by_quality(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(docs(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]
    rows = [(i, "good words here", "a") for i in range(200)] + [(i, "bad words here", "a") for i in range(200, 400)]
    rows += [(i, "the other source", "b") for i in range(400, 2000)]
    weight = mixing.F.when(mixing.F.col("text").startswith("good"), 20.0).otherwise(1.0)
    found = mixing.mix(docs(spark, rows), quality=weight, weights=(1, 15), share=0.5).where("source = 'a'").collect()
    good = sum(r["taken"] for r in found if r["doc_id"] < 200)
    assert good > 0.8 * sum(r["taken"] for r in found) > 0


def plain_edit(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (i, t, _), (_, following, _) in zip(order, order[1:] + order[:1]):
        t, following = t or "", following or ""
        half = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[:len(t) - half] + following[:half]).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_fingerprint_edits(spark, sample, parts):
    rows = sample + [(50, "é" * 31 + " 日本 " * 9, "a")]
    found = fingerprints.fingerprints(docs(spark, rows), parts=parts).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == plain_edit(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_id.values())


def test_fingerprint_likeness(spark):
    a, b = words(400, 21), words(400, 22)
    rows = [(3, " ".join(a), "a"), (2, " ".join(b), "a"), (1, "inserted " + " ".join(a), "a")]
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(docs(spark, rows)).collect()}
    assert found[3]["near_edited"] == pytest.approx(0.5, abs=0.1) and found[3]["near_next"] < 0.05
    assert found[1]["near_next"] > 0.95
    assert fingerprints.fingerprints(docs(spark, [])).count() == 0
    alone = fingerprints.fingerprints(docs(spark, [(1, "abcdef", "a")])).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


def test_closed_syncmers_do_not_depend_on_context(spark):
    middle = words(60, 31)
    rows = [(1, " ".join(words(20, 32) + middle + words(20, 33))), (2, " ".join(words(37, 34) + middle + words(5, 35)))]
    df = spark.createDataFrame(rows, "id int, text string").select("id", fingerprints.anchors(mixing.F.col("text")).alias("a"))
    own = spark.createDataFrame([(" ".join(middle),)], "text string").select(fingerprints.anchors(mixing.F.col("text")).alias("a")).first()["a"]
    for r in df.collect():
        assert set(own) <= set(r["a"])
    assert 0.4 < len(own) / (len(middle) - fingerprints.K + 1) < 0.9


def plain_lm(rows):
    tokens = {i: (t or "").encode().lower().split() + [b"\n"] for i, t, _ in rows}
    counts = Counter()
    for i, t, _ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            for i, w in tokens.items()}


def test_language_model_base_and_gain(spark, sample, monkeypatch):
    monkeypatch.setattr(lm_score, "COMMON_WORDS", 40)  # most words take the joined way
    pairs = [f"a{k} b{k}" for k in range(30)]
    rows = sample + [(100 + i, " ".join(random.Random(i).choices(pairs, k=60)), "a") for i in range(120)]
    found = lm_score.lm_scores(docs(spark, rows)).collect()
    expected = plain_lm(rows)
    assert len(found) == len(rows)
    for r in found:
        n, known, train, base = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
    held = [r for r in found if r["held_out"] and (r["doc_id"] or 0) >= 100]
    assert held and sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)
    assert lm_score.lm_scores(docs(spark, [])).count() == 0


def test_language_model_sums_to_one(spark):
    rows = [(i, " ".join(words(30, i, 8)), "a") for i in range(30)]
    source = docs(spark, rows).selectExpr("text")
    model, counts = lm_score.train(source)
    table = {r["word"]: (r["spelling"], r["n"]) for r in counts.collect()}
    hashes = np.array(list(table), np.int64).view(np.uint64)
    spelling, n = (np.array([v[i] for v in table.values()]) for i in (0, 1))
    own = model.classes.of(hashes, spelling)
    context = np.array([0, 129, 5000])
    p = np.exp(lm_score.class_log_probs(model.weights, context))
    assert p.sum(axis=1) == pytest.approx(1)
    inside = (n + lm_score.SMOOTHING) / 10 ** model.class_sizes[own]
    unknown = lm_score.SMOOTHING / 10 ** model.class_sizes
    total = np.bincount(own, inside, lm_score.CLASSES) + unknown
    assert (p * total).sum(axis=1) == pytest.approx(1)


def test_language_model_learns_words_after_words(spark):
    """Words of one spelling, and so of one class: only the word before tells which of them comes."""
    names = [f"{a}{b}tion" for a in "bcdfgklm" for b in "aeiouy"] * 2
    names = [n + "x" * (i >= 48) for i, n in enumerate(names)]
    follow = {w: names[(i * 7 + 3) % len(names)] for i, w in enumerate(names)}

    def text(i):
        rng = random.Random(i)
        return " ".join(w for _ in range(40) for a in [rng.choice(names)] for w in (a, follow[a]))
    source = docs(spark, [(i, text(i), "a") for i in range(60)]).selectExpr("text")
    model, counts = lm_score.train(source)
    table = {r["word"]: (r["spelling"], r["n"]) for r in counts.collect()}
    hashes = np.array(list(table), np.int64).view(np.uint64)
    spelling, n = (np.array([v[i] for v in table.values()]) for i in (0, 1))
    own = model.classes.of(hashes, spelling)
    tail = own >= lm_score.HEADS
    assert tail.sum() > 20
    # Over all words of a class and the unknown ones of its groups, any word before.
    group = model.words.group(hashes[tail])
    place = own[tail] - lm_score.HEADS
    for before in (hashes[0], hashes[tail][3], lm_score.END, np.uint64(12345)):
        bucket = model.words.bucket(np.array([before], np.uint64))[0]
        logs = model.group_logs[(np.arange(lm_score.TAILS) * lm_score.BUCKETS + bucket)].astype(float)
        total = np.bincount(place, 10 ** logs[place, group] * (n[tail] + lm_score.SMOOTHING) / 10 ** model.group_sizes[place, group],
                            lm_score.TAILS)
        unknown = (10 ** logs[:, lm_score.LEADERS:] * lm_score.SMOOTHING / 10 ** model.group_sizes[:, lm_score.LEADERS:]).sum(axis=1)
        assert total + unknown == pytest.approx(1, abs=1e-4)
    # The pairs that were learned stand out from the shares of the class.
    pairs = [(a, b) for a, b in follow.items() if b in names and lm_score.tokens(b)[0][0] in hashes[tail]]
    gains = []
    for a, b in pairs:
        (h,), (s,) = (x[:1] for x in lm_score.tokens(b))
        c = int(model.classes.of(np.array([h]), np.array([s]))[0])
        row = (c - lm_score.HEADS) * lm_score.BUCKETS + model.words.bucket(lm_score.tokens(a)[0][:1])[0]
        g = model.words.group(np.array([h]))[0]
        share = 10 ** model.group_sizes[c - lm_score.HEADS]
        gains.append(model.group_logs[row, g] - np.log10(share[g] / share.sum()))
    assert len(gains) > 20 and np.mean(gains) > 0.1 and min(gains) > -0.01


def test_group_steps_reach_the_maximum():
    rng = np.random.default_rng(1)
    seen = rng.poisson(rng.choice([0.1, 3, 200], (50, lm_score.GROUPS))).astype(float)
    seen[0] = 0
    logits = np.log(rng.dirichlet(np.ones(lm_score.GROUPS), 50))

    def value(found):
        return (seen * (found - np.log(np.exp(found).sum(axis=1, keepdims=True)))).sum(axis=1) - 0.5 * ((found - logits) ** 2).sum(axis=1)
    found = [value(lm_score.group_steps(seen, logits, k)) for k in (0, lm_score.STEPS, 400)]
    assert (found[1] >= found[0] - 1e-9).all() and (found[2] - found[1] < 0.02 * (found[2] - found[0]) + 1e-6).all()
    assert np.allclose(lm_score.group_steps(seen, logits)[0], logits[0])


def plain_contaminated(rows, items):
    out = set()
    for i, t, _ in rows:
        w = decontaminate.words_of(t or "")
        for _, q in items:
            x = decontaminate.words_of(q or "")
            span = min(13, len(x))
            if span and any((w[a:a + span] != x[b:b + span]).sum() <= decontaminate.allowed(span)
                            for a in range(len(w) - span + 1) for b in range(len(x) - span + 1)):
                out.add(i)
    return out


def test_decontamination_finds_replaced_words(spark):
    item = words(40, 41)
    hit = item[5:25]
    replaced = [w if i not in (3, 9) else "other" for i, w in enumerate(hit[:13])]
    broken = [w if i not in (3, 8, 12) else "other" for i, w in enumerate(hit[:13])]
    rows = [(1, " ".join(words(50, 42) + hit + words(9, 43)), "a"), (2, " ".join(words(20, 44) + replaced), "a"),
            (3, " ".join(words(20, 45) + broken + words(30, 46)), "a"), (4, None, "a"), (5, "", "a"), (6, " ".join(hit[:12]), "a"),
            (7, "so the Short, item!", "a"), (8, "short item", "b"), (9, ", ".join(hit).upper(), "b"), (1, None, "a")]
    items = [(1, " ".join(item)), (2, None), (3, ""), (4, "the short item"), (None, " ".join(words(20, 47)))]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = plain_contaminated(rows, items)
    assert expected == {1, 2, 7, 9}
    found = decontaminate.contamination(docs(spark, rows), table).collect()
    assert len(found) == len(rows) and {r["doc_id"] for r in found if r["contaminated"]} == expected
    kept = decontaminate.drop_contaminated(docs(spark, rows), table)
    assert kept.columns == docs(spark, []).columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 6, 8]
    assert decontaminate.drop_contaminated(docs(spark, rows), table.limit(0)).count() == len(rows)
    assert decontaminate.contamination(docs(spark, []), table).count() == 0


def test_masks_cover_every_choice():
    for span in range(1, 14):
        for gone in itertools.combinations(range(span), decontaminate.allowed(span)):
            assert any(not set(gone) & set(m.tolist()) for m in decontaminate.masks(span, decontaminate.allowed(span)))


def plain_cut(rows, window=50):
    """Words of windows that an earlier document holds, by a dictionary of all windows."""
    order = sorted({(i is None, i or 0, t or "") for i, t, _ in rows})
    first = {}
    for n, (_, _, t) in enumerate(order):
        w = t.split()
        for a in range(len(w) - window + 1):
            first.setdefault(tuple(w[a:a + window]), n)
    out = {}
    for n, (none, i, t) in enumerate(order):
        w, gone = t.split(), set()
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < n:
                gone.update(range(a, a + window))
        out[None if none else i, t] = (" ".join(x for k, x in enumerate(w) if k not in gone), len(gone))
    return out


def test_repeated_passages_go(spark, sample):
    passages = [words(n, 500 + n) for n in (51, 60, 75, 140, 49)]
    rng = random.Random(3)
    rows = list(sample)
    for i in range(40):
        w = words(rng.randrange(0, 90), 700 + i, 10**6)
        for p in rng.sample(passages, 2):
            w = w + p + words(rng.randrange(1, 40), 800 + i, 10**6)
        rows.append((1000 + i, " ".join(w), "a"))
    found = substring_dedup.remove_repeats(docs(spark, rows))
    assert found.columns == ["doc_id", "text", "source", "key", "size", "removed_words"]
    expected = plain_cut(rows)
    texts = Counter((i, t) for i, t, _ in rows)
    got = Counter((r["doc_id"], " ".join((r["text"] or "").split()), r["removed_words"]) for r in found.collect())
    want = Counter()
    for (i, t), n in texts.items():
        want[(i, *expected[i, t or ""])] += n
    assert got == want and sum(r["removed_words"] > 0 for r in found.collect()) > 20
    assert found.where("doc_id = 4 AND text IS NULL").count() == 1
    assert substring_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_chunks_resist_insertions():
    base = text.word_hashes(" ".join(words(400, 51)).encode())
    moved = np.concatenate([base[:100], text.word_hashes(b"three new words"), base[100:]])
    cuts = {int(c) for c in substring_dedup.cut_points(base)}
    shifted = {int(c) - 3 if c >= 103 else int(c) for c in substring_dedup.cut_points(moved)}
    assert len(cuts ^ shifted) <= 6 and len(cuts) > 30


PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a href='/x'>Menu &amp; more</a></li></ul></nav><!-- c --><div class='ad'>Buy</div>"
        "<article><h1>Head &lt;1&gt;</h1><p>First <b>bold <i>x</i><br>line\n  two</p><p>Second &#233;&quot;<p>Third"
        "<div class=\"comments\"><p>nice post</p></div><form><input><label>Mail</label></form></article>"
        "<aside>Side</aside><footer>&copy; all</footer></body></html>")


def test_page_text(spark):
    rows = [(1, "http://a.org/1", PAGE), (2, "http://a.org/2", None), (3, None, ""), (4, "http://a.org/4", "plain &amp; text"),
            (4, "http://a.org/4", "plain &amp; text"), (5, "bad url", "<p>cut <b>here</b> <foot"), (None, "http://a.org/5", "<div>x</div>")]
    pages = spark.createDataFrame([(*r, "k", "h") for r in rows], "page_id long, url string, html string, page string, host string")
    found = html_extract.extract_pages(pages).collect()
    assert Counter((r["page_id"], r["text"]) for r in found) == Counter({
        (1, 'Head <1>\n\nFirst bold x line two\n\nSecond é"\n\nThird'): 1, (2, ""): 1, (3, ""): 1, (4, "plain & text"): 2,
        (5, "cut here"): 1, (None, "x"): 1})
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_style_tree_finds_what_all_pages_share(spark):
    rows = [(i, f"http://a.org/{i}", f"<div class='x'>Welcome to the site</div><div class='y'><p>{' '.join(words(30, i))}</p></div>"
             f"<div class='z'>Stay in touch</div>") for i in range(30)]
    found = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: " ".join(words(30, i)) for i in range(30)}


def test_hidden_elements_take_no_siblings_along(spark):
    pairs = [("<p hidden>gone</p>", "<p>text</p>"), ("<div style='display:none'>gone</div>", "<div>text</div>"),
             ("<div hidden><p>gone</p></div>", "<div><p>text</p></div>"), ("<p aria-hidden='true'>gone</p>", "<p>text</p>"),
             ("<span hidden>gone</span>", "<span>text</span>")]
    rows = []
    for hidden, shown in pairs:
        for body in (hidden + shown, shown + hidden):
            for around in ("{}", "<article><h1>Head</h1>{}</article>"):
                rows.append((len(rows), f"http://h{len(rows)}.org/", around.format(body)))
    rows.append((len(rows), "http://roles.org/", "<div class='main'>gone</div><div role='main'>text</div>"))
    found = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: "Head\n\ntext" if "Head" in page else "text" for i, _, page in rows}


def test_sites_overrule_names(spark):
    def body(i):
        return " ".join(words(30, 900 + i))

    sites = {  # body of a page and whether its second text, the same on all pages, stays
        "name": lambda i: f"<div class='banner'><p>{body(i)}</p></div><div class='x'>Stay</div>",
        "form": lambda i: f"<form><div>{body(i)}</div></form><div class='x'>Stay</div>",
        "teaser": lambda i: f"<div class='text'>{body(i)}</div><article>Stay</article>",
        "main": lambda i: f"<article><p>{body(i)}</p><h2>Stay</h2></article>",
        "unseen": lambda i: f"<div hidden>{body(i)} {body(i + 100)}</div><p>{body(i)}</p>"}
    rows = [(n * 100 + i, f"http://{name}.org/{i}", page(i)) for n, (name, page) in enumerate(sites.items()) for i in range(12)]
    # Too few pages to overrule a name, and one article on two pages.
    rows += [(1000 + i, f"http://few.org/{i}", f"<nav><p>{body(i)}</p></nav><p>Stay</p>") for i in range(1)]
    rows += [(1100 + i, f"http://same.org/{i}", f"<i>{i}</i><article>{body(7)}</article>") for i in range(12)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(len(sites)):
        assert all(found[n * 100 + i] == body(i) for i in range(12)), n
    assert found[1000] == "Stay" and {found[1100 + i] for i in range(12)} == {body(7)}


def test_names_and_links_against_text_that_is_new_on_each_page(spark):
    def body(i, n=30):
        return " ".join(words(n, 700 + i))

    def menu(i):
        return "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in words(40, 5000 + i))

    sites = {  # the body alone stays
        "comments": lambda i: f"<article><p>{body(i)}</p></article><div class='comments'><p>{body(i + 100, 400)}</p></div>",
        "inside": lambda i: f"<article><p>{body(i)}</p><div class='comment-list'><article>{body(i + 100, 400)}</article></div></article>",
        "plain": lambda i: f"<div><p>{body(i)}</p></div><div class='comments'><p>{body(i + 100, 400)}</p></div>",
        "menus": lambda i: f"<article><p>{body(i)}</p></article><ul class='x'>{menu(i)}</ul>",
        "unnamed": lambda i: f"<div><p>{body(i)}</p></div><ul class='x'>{menu(i)}</ul>",
        "named": lambda i: f"<div class='top'><p>{body(i)}</p></div><div class='site-menu'>{menu(i)}</div>",
        "parts": lambda i: f"<article><section class='related-work'>{body(i)}</section></article><div class='main-footer'>x{i}</div>",
        "share": lambda i: f"<article><div class='market-share'><a href='/'>{body(i)[:9]}</a>{body(i)[9:]}</div></article>"}
    rows = [(n * 100 + i, f"http://{name}.org/{i}", page(i)) for n, (name, page) in enumerate(sites.items()) for i in range(12)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n, name in enumerate(sites):
        assert all(found[n * 100 + i] == body(i) for i in range(12)), (name, found[n * 100], body(0))


def test_main_branches_reset_what_stands_around():
    def priors(page):
        return {b.text: b.prior for b in html_extract.page_blocks(page)}

    assert priors("<body class='has-sidebar'><div>x</div></body>")["x"] == html_extract.NEUTRAL
    assert priors("<div class='with-sidebar'><div>x</div></div>")["x"] == html_extract.NEUTRAL
    assert priors("<form><main>x</main><p>y</p></form>") == {"x": html_extract.MAIN, "y": html_extract.AROUND}
    assert priors("<div class='share'><article>x</article>y</div>") == {"x": html_extract.NEUTRAL, "y": html_extract.AROUND}
    assert priors("<article>h<div class='widget'><article>x</article>y</div></article>") == {
        "h": html_extract.MAIN, "x": html_extract.MAIN, "y": html_extract.AROUND}
    assert priors("<aside><article>x</article></aside>")["x"] == html_extract.AROUND
    assert priors("<div hidden><main>x</main></div>")["x"] == html_extract.UNSEEN


def test_deep_and_broken_markup():
    blocks = html_extract.page_blocks("<div>" * 3000 + "deep" + "</div>" * 10 + "<p a='unclosed>x")
    assert blocks[0].text == "deep"
    blocks = html_extract.page_blocks("<div>" * 50000 + "deep<span>" + "</i>" * 50000 + "<p>x")  # unclosed tags cost no more by depth
    assert [b.text for b in blocks] == ["deep", "x"]
    assert html_extract.page_blocks("a < b && c > d")[0].text == html.unescape("a < b && c > d")


def plain_chat(rows):
    out = {}
    for conv, turn, role, said in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", said or ""))
    result = {}
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        result[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                        len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return result


def test_chat_examples_read_back(spark):
    nasty = ["\\### Assistant: </turn> ok", "<turn assistant>\nx\n</turn>\n", "\\l\\g\\\\", "\\", "<", ">>", "", None, "a\n</turn>\n", "é\\<"]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "assistant", "hello"), (3, 0, "user", "no answer"), (4, 1, "assistant", "b"), (4, 1, "assistant", "b"),
             (4, None, "system", "first"), (None, 0, "user", "x"), (5, 0, None, "who"), (5, 1, "we<ir>d\n", "y" * 100_000), (5, 2, "assistant", "z")]
    turns = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, example string")
    examples = chat_format.chat_examples(turns)
    back = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.read_back(examples).collect()}
    assert back == plain_chat(rows)
    one = [r for r in examples.where("conv_id = 1").orderBy("example").collect()]
    assert [r["example"] for r in one] == [2, 4, 6, 8, 10] and all(b["text"].startswith(a["text"]) for a, b in zip(one, one[1:]))
    assert chat_format.read_back(chat_format.chat_examples(turns.limit(0))).count() == 0


def labelled_docs(spark, n, seed):
    rng = random.Random(seed)
    clean, toxic, junk = [], [], []
    for i in range(n):
        w = words(rng.randrange(20, 200), seed * 1000 + i, 3000)
        kind = i % 4
        if kind == 1:
            w[rng.randrange(len(w))] = rng.choice(["grumbo", "grumbal", "grumbix", "snarfle"])
        if kind == 2:
            w = [x + "%%%" for x in w]
        (toxic if kind == 1 else junk if kind == 2 else clean).append((i, " ".join(w), "a"))
    rows = clean + toxic + junk
    marks = [(i, int(k is not junk), int(k is toxic)) for k in (clean, toxic, junk) for i, _, _ in k]
    return docs(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), {m[0]: m for m in marks}


def test_classifiers_on_held_out_documents(spark):
    table, marks, truth = labelled_docs(spark, 600, 61)
    table = table.unionByName(docs(spark, [(5000, None, "a"), (5001, "", "a"), (None, "w1 w2", "a"), (5002, "w1 " * 40_000, "a")]))
    marks = marks.unionByName(spark.createDataFrame([(None, 1, 1), (5001, None, None)], "doc_id long, quality int, toxic int"))
    for scored, place in ((quality.score_quality(table, quality.train(table, marks)), 1),
                          (toxicity.score_toxicity(table, toxicity.train(table, marks)), 2)):
        rows = scored.collect()
        assert len(rows) == 604 and all(0 <= r["score"] <= 1 for r in rows)
        held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
        assert len(held) > 80
        right = sum(r["predicted"] == truth[r["doc_id"]][place] for r in held) / len(held)
        assert right > 0.97, right
        for r in rows:
            assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_classifiers_learn_from_all_partitions(spark, monkeypatch):
    """Every drawn document is learned from, however much text lies before it in the files."""
    rows = [(i, " ".join(words(2_000, 7_000 + i, 3000)), "a") for i in range(24)]
    table = docs(spark, rows).repartitionByRange(6, "doc_id")
    marks = spark.createDataFrame([(i, int(i >= 12), int(i >= 12)) for i in range(24)], "doc_id long, quality int, toxic int")
    drawn = sorted(i for i in range(24) if zlib.crc32(str(i).encode()) % 4 != 2)
    for module in (quality, toxicity):
        monkeypatch.setattr(module, "TRAIN_ENTRIES", 20_000, raising=False)
        seen = []
        monkeypatch.setattr(module, "fit", lambda texts, *_, seen=seen: seen.append([(*map(len, t[:2]), t[2]) for t in texts]))
        module.train(table, marks)
        assert [t[2] for t in seen[0]] == [int(i >= 12) for i in drawn] and all(min(t[:2]) > 500 for t in seen[0])


def test_classifiers_without_labels_or_rows(spark):
    table, marks, _ = labelled_docs(spark, 20, 62)
    for module, score in ((quality, quality.score_quality), (toxicity, toxicity.score_toxicity)):
        model = module.train(table, marks.limit(0))
        assert {r["predicted"] for r in score(table, model).collect()} == {0}
        assert score(table.limit(0), model).count() == 0
    kept = toxicity.drop_toxic(table, toxicity.train(table, marks.limit(0)))
    assert kept.columns == table.columns and kept.count() == 20


def test_identity_terms_weigh_alike(monkeypatch):
    """A group that labelled texts insult more often must not make a neutral mention toxic."""
    def rows(penalty):
        monkeypatch.setattr(toxicity, "SWAP_PENALTY", penalty)
        rng, table = random.Random(5), toxicity.term_table()
        texts, pairs = [], []
        for i in range(800):
            w = words(15, i, 400)
            toxic = i % 4 == 0
            term = "muslims" if toxic and rng.random() < 0.8 else rng.choice(["christians", "jews", "hindus"]) if rng.random() < 0.5 else None
            if toxic and rng.random() < 0.6:
                w[3] = "grumbo"
            if term:
                w[7] = term
            said = " ".join(w)
            texts.append((*map(np.asarray, toxicity._word_entries(said)), int(toxic)))
            pairs += [((*toxicity._word_entries(a), 0), (*toxicity._word_entries(b), 0)) for a, b in toxicity.swapped_sentences(said, table, i)]
        return toxicity.fit(texts, pairs)
    neutral = [f"w1 w2 {g} w3 w4" for g in ("muslims", "christians", "jews", "hindus")]
    gap = {}
    for penalty in (0.0, 5.0):
        scores = [rows(penalty).score(t) for t in neutral]
        gap[penalty] = max(scores) - min(scores)
    assert gap[5.0] < 0.5 * gap[0.0]


def test_held_out_rows_are_not_in_the_sample(spark):
    table, marks, _ = labelled_docs(spark, 200, 63)
    taken = [r["id"] for r in labels.training_sample(table, marks, "toxic", 50).collect()]
    assert len(taken) == 50 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in taken)


def test_word_and_ngram_hashes():
    data = "Ünïcode  words\tand\nlines words".encode()
    starts, ends = text.word_bounds(data)
    assert [data[a:b] for a, b in zip(starts, ends)] == data.split()
    hashes = text.word_hashes(data)
    assert hashes[1] == hashes[4] and len(set(hashes.tolist())) == 4
    w = subword.Words("ab abc ab")
    owner, buckets = w.entries(3, 12)
    assert np.bincount(owner).tolist() == [2, 3, 2]
    weights = np.arange(1 << 12, dtype=float)
    assert np.allclose(w.sums(3, 12, weights), np.bincount(owner, weights[buckets]))
    assert len(text.word_hashes(b"")) == 0 and len(text.shingle_set(None, 5)) == 0
