"""Stages of the corpus job on a small folder, each compared with a plain version on its own input."""

from __future__ import annotations

import random

import corpus_pipeline
from ledgerfeat.llm import toxicity
from test_corpus_operators import plain_contaminated, plain_cut, plain_groups, words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def folder(spark, path):
    rng = random.Random(4)
    texts, toxic = [], []
    passage, item = words(70, 1), words(30, 2)
    for i in range(160):
        w = words(rng.randrange(30, 120), 300 + i, 10**5)
        toxic.append(int(i % 5 == 0))
        if toxic[-1]:
            w[4] = rng.choice(["grumbo", "grumbal", "snarfle"])
        elif i % 5 == 1:
            w += passage
        elif i % 20 == 2:
            w = w[:20] + item + w[20:]
        texts.append(" ".join(w))
    for i in range(12):  # near and exact copies
        w = texts[3 + 5 * (i % 4)].split()
        if i % 2:
            w[len(w) // 2] = f"edit{i}"
        texts.append(" ".join(w))
        toxic.append(0)
    texts += [None, "", "short"]
    docs = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(0, " ".join(item))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return toxic, items


def test_stages_match_plain_versions(spark, tmp_path):
    path = str(tmp_path)
    toxic, items = folder(spark, path)
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        seen[name] = docs.collect()
    rows = {n: [(r["doc_id"], r["text"], r["source"]) for r in rs] for n, rs in seen.items() if n != "mixing"}
    kept = {r[0] for r in rows["toxicity"]}
    assert all((i in kept) == (t == 0) for i, t in enumerate(toxic)) and {172, 173, 174} <= kept
    groups = plain_groups(rows["toxicity"], 80)
    assert {r[0] for r in rows["near_duplicates"]} == {i for i, g in groups.items() if i == g}
    assert len(rows["near_duplicates"]) < len(rows["toxicity"])
    expected = plain_cut(rows["near_duplicates"])
    after = {i: " ".join((t or "").split()) for i, t, _ in rows["substring_dedup"]}
    assert after == {i: expected[i, t or ""][0] for i, t, _ in rows["near_duplicates"]}
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in seen["substring_dedup"])
    bad = plain_contaminated(rows["substring_dedup"], items)
    assert bad and {r[0] for r in rows["decontamination"]} == set(after) - bad
    assert {r["doc_id"]: r["size"] for r in seen["mixing"]} == {i: len((t or "").split()) for i, t, _ in rows["decontamination"]}
    whole = {(r["doc_id"], r["taken"]) for r in corpus_pipeline.run(spark, path).collect()}
    assert whole == {(r["doc_id"], r["taken"]) for r in seen["mixing"]}


def test_toxicity_stage_is_the_operator(spark, tmp_path):
    path = str(tmp_path)
    folder(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    clean = {r["doc_id"] for r in toxicity.score_toxicity(docs, model).where("predicted = 0").collect()}
    assert clean == {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, path).collect()}
