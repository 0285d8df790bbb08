"""The pipeline's stages, each on what the one before it kept, against plain versions."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from shelfmark.llm import toxicity
from tests.llm.tables import words
from tests.llm.test_operators import all_ids, components, grams
from tests.llm.test_substrings import removed

DATA = "/root/testdata/sf0.001"
KEPT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA).persist()
        out.append(docs.collect())
    return out


def test_names(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "substring_dedup", "packing"]
    assert all(list(r.asDict()) == KEPT for rows in stages[:4] for r in rows[:1])


def test_toxic_documents_go(spark, stages):
    before, after = stages[:2]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{DATA}/documents.parquet"), labels.filter(~toxicity.held_out("doc_id")))
    assert Counter(after) == Counter(r for r in before if model.score(r["text"]) < 0.5)
    marks = {r["doc_id"]: r["toxic"] for r in labels.collect()}  # of some documents
    gone = [marks[r["doc_id"]] for r in before if r not in after and r["doc_id"] in marks]
    assert gone and np.mean(gone) > 0.8


def test_one_of_each_group_stays(stages):
    before, after = stages[1:3]
    groups = defaultdict(list)
    sets = [grams(r["text"], 5) for r in before]
    for r, root, s in zip(before, components(sets, 80), sets, strict=True):
        groups[root if s else f"none {r['doc_id']}"].append(r)
    assert Counter(after) == Counter(min(g, key=lambda r: r["doc_id"]) for g in groups.values())
    assert len(after) < len(before)


def test_repeats_are_cut(stages):
    before, after = stages[2:4]
    rows = [(r["doc_id"], r["text"]) for r in before]
    want = {i: (t if not n else kept) for (i, t), (_, n, kept) in zip(rows, removed(rows, 20), strict=True)}
    assert {r["doc_id"]: r["text"] for r in after} == want and len(after) == len(before)
    assert all(r["n_chars"] == len(r["text"]) for r in after if want[r["doc_id"]] != dict(rows)[r["doc_id"]])


def test_all_ids_are_packed(spark, stages):
    docs, pieces = stages[3:]
    ids = {r["doc_id"]: x for r, x in zip(docs, all_ids([(r["doc_id"], r["text"]) for r in docs]), strict=True)}
    got, sequences = defaultdict(int), defaultdict(list)
    for r in pieces:
        got[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    assert dict(got) == {i: len(x) for i, x in ids.items()}
    for rows in sequences.values():
        ends = np.cumsum([n for _, n in sorted(rows)])
        assert [o for o, _ in sorted(rows)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert Counter(map(tuple, corpus_pipeline.run(spark, DATA).drop("sequence_id", "offset").collect())) == Counter(tuple(v for k, v in r.asDict().items() if k not in ("sequence_id", "offset")) for r in pieces)


def test_stages_in_a_row_on_odd_tables(spark, tmp_path):
    """Nulls in every column, repeated rows, empty and long texts, null and repeated ids, and columns whose names hold dots or clash:
    every stage but the last keeps the columns, and clean documents come through."""
    passage = words(999, 60, 3000)
    texts = [words(i, 80, 3000) for i in range(30)] + [f"{words(100 + i, 50, 3000)} {passage}" for i in range(4)] + [f"vile {words(200 + i, 30, 60)} slur" for i in range(25)]
    rows = [(i, t, "en", "s", len(t), "k", "x", 1) for i, t in enumerate(texts)]
    rows += [(None, words(50, 70, 3000), None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (70, None, None, None, None, None, None, None), (71, "", "", "", 0, "", "", 0), (72, " \n", "", "", 2, "", "", 0)]
    rows += [(3, texts[3], "en", "s", 9, "k", "x", 1)] * 2 + [(4, words(51, 40, 3000), "en", "s", 9, "k", "x", 1), (80, words(52, 60_000, 3000), "de", "t", 9, "k", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, kept string, cls int").repartition(5)
    spark.createDataFrame([(i, 1, int(i >= 34)) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert set(range(34)) | {None, 70, 71, 72, 80} <= ids, name
        assert not ids & set(range(34, 59)), name
    kept = {r["doc_id"]: (r["text"] or "").split() for r in docs.collect() if r["doc_id"] in range(30, 34)}
    assert all(len(kept[i]) == (110 if i == 30 else 50) for i in kept) and docs.filter("doc_id = 3").count() == 1
    name, last = corpus_pipeline.STAGES[-1]
    packed = last(spark, docs, str(tmp_path)).collect()
    total = {}
    for r in packed:
        total.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
    assert {k[0] for k in total} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert all(sum(n for _, n in v) % k[1] == 0 for k, v in total.items())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).isEmpty()
