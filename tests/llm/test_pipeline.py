"""The pipeline on a small labelled corpus with odd rows, against a plain run of its rules."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from callgrove.llm import common, labelled, packing, quality, simhash, toxicity
from callgrove.llm.registry import llm_queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, y int, fp long"
LABELS = "doc_id long, quality int, toxic int"


def _corpus():
    random = np.random.default_rng(8)
    good = ["river", "hill", "stone", "walked", "quiet", "summer", "bridge", "lantern", "green", "old"]
    rows, labels = [], []
    for i in range(240):
        words = list(random.choice(good, 60))
        bad, toxic = i % 4 == 0, i % 5 == 0
        if bad:
            words = ["%%%", "$$$", "zzzz"] * 20
        if toxic:
            words = ["vile", "wretched", *words[:30], "scoundrel", "vile", "scum"]
        random.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(toxic)))
    copy = rows[1][1]
    rows += [(500, copy), (501, copy + "."), (None, copy), (502, None), (503, ""), (None, None), (504, copy * 400), (1, copy)]
    labels += [(None, 1, 1), (1, 1, 0), (2, None, 7), (3, 1, 0), (3, 0, 0), (999, 1, 1)]
    return rows, labels


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    common.code_on_workers(spark)
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = _corpus()
    full = [(i, t, "en", "s", len(t or ""), 0.5, 1, 2) for i, t in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path


def _used(labels, column, modulus, remainder):
    """Labels outside the held-out fold; an id with both is left out."""
    found: dict = {}
    for row in labels:
        if row[0] is not None and row[column] in (0, 1) and zlib.crc32(str(row[0]).encode()) % modulus != remainder:
            found.setdefault(row[0], set()).add(row[column])
    return {i: ys.pop() for i, ys in found.items() if len(ys) == 1}


def _plain_model(module, column, modulus, remainder):
    rows, labels = _corpus()
    used = _used(labels, column, modulus, remainder)
    texts: dict = {}
    for i, text in rows:
        if i in used and text is not None:
            texts[i] = min(text, texts.get(i, text))
    share = sum(used.values()) / len(used)
    learned = [(used[i], *labelled.counted(module.features(texts[i]))) for i in sorted(texts)]
    return module.fit_rows(learned, share)


@pytest.mark.parametrize(
    ("module", "query", "column", "fold"), [(quality, "op4_quality", 1, (4, 2)), (toxicity, "op1_toxicity", 2, (3, 1))]
)
def test_scores_are_those_of_a_plain_fit(spark, corpus, module, query, column, fold):
    model = _plain_model(module, column, *fold)
    got = llm_queries()[query](spark, corpus).collect()
    rows, _ = _corpus()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    wanted: dict = {}
    for i, text in rows:
        wanted.setdefault(i, []).append(model.score(text or ""))
    for r in got:
        assert min(abs(r.score - s) for s in wanted[r.doc_id]) < 1e-9
        assert r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1])


def test_plain_score_of_quality():
    """The score spelled out with dicts: the mean of the buckets' margins in a logistic function."""
    model = _plain_model(quality, 1, 4, 2)
    text = "quiet river zzzz zzzz %%%"
    found = quality.features(text).tolist()
    total = sum(float(model.margins[b]) for b in found) / len(found) + model.bias
    assert model.score(text) == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-6)


def test_plain_score_of_toxicity():
    model = _plain_model(toxicity, 2, 3, 1)
    text = "vile old scoundrel of the green hill"
    total = sum(float(model.weights[b]) for b in set(toxicity.features(text).tolist())) + model.bias
    assert model.score(text) == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-5)


def _kept_by_hand(rows):
    good, toxic = _plain_model(quality, 1, 4, 2), _plain_model(toxicity, 2, 3, 1)
    left = [(i, t) for i, t in rows if good.score(t or "") >= corpus_pipeline.QUALITY_REJECT]
    left = [(i, t) for i, t in left if toxic.score(t or "") < toxicity.THRESHOLD]
    prints = [simhash.fingerprint_of(t) for _, t in left]
    group = list(range(len(left)))
    changed = True
    while changed:
        changed = False
        for a in range(len(left)):
            for b in range(len(left)):
                if (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] > group[b]:
                    group[a], changed = group[b], True
    best: dict = {}
    for at, g in enumerate(group):
        best.setdefault(g, []).append(left[at])
    return left, [min(members, key=lambda r: (r[0] is None, r[0] or 0)) for members in best.values()]


def test_whole_pipeline_against_plain_rules(spark, corpus):
    rows, _ = _corpus()
    left, kept = _kept_by_hand(rows)
    assert 0 < len(kept) < len(left) < len(rows)
    pieces = corpus_pipeline.run(spark, corpus).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in kept}
    whole: Counter = Counter()
    for r in pieces:
        whole[r.doc_id, r.doc_tokens] += r.length
    units = packing.encoder(packing.TOKENIZER)
    sizes = Counter((i, len(units.ids(t or "")) // 4 + 1) for i, t in kept)
    assert whole == Counter({key: key[1] * n for key, n in sizes.items()})


def test_stages_pass_all_columns_and_take_no_rows(spark, corpus):
    docs = common.table(spark, corpus, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, corpus)
        assert kept.columns == docs.columns, name
        assert stage(spark, docs.limit(0), corpus).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), corpus).count() == 0


def test_no_documents_and_no_labels(spark, tmp_path):
    common.code_on_workers(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
