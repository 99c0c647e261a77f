import math
import zlib

import numpy as np
import pytest
from helpers import documents, table
from pyspark.sql import functions as F

from seekframe.llm import quality, toxicity
from seekframe.llm.queries import QUERIES
from seekframe.llm.tables import Example, held_out, labelled_sample

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, least", [("op5_quality", "quality", 0.97),
                                                ("op8_toxicity", "toxic", 0.955)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, FOLDER)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"),
                          ("predicted", "int")]
    rows = got.join(table(spark, "labels", FOLDER), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in rows)
    assert len(rows) > 500
    assert np.mean([r.predicted == r[label] for r in rows]) >= least


def test_sample_is_bounded_and_learns_from_no_held_out_row(spark):
    docs, labels = table(spark, "documents", FOLDER), table(spark, "labels", FOLDER)
    got = labelled_sample(docs, labels, "toxic", rows=100, chars=5000)
    assert [sum(e.label == v for e in got) for v in (0, 1)] == [50, 50]
    assert all(len(e.text) <= 5000 for e in got)
    share = labels.filter(~held_out("doc_id")).agg(F.avg("toxic")).scalar()
    held = labels.filter(held_out("doc_id")).join(docs, "doc_id").select("text").collect()
    open_ = labels.filter(~held_out("doc_id")).join(docs, "doc_id").select("text").collect()
    assert not {e.text for e in got} & ({r.text for r in held} - {r.text for r in open_})
    assert math.isclose(sum(e.weight for e in got if e.label) / 100,
                        labels.filter(~held_out("doc_id")).agg(F.avg("toxic")).first()[0]) \
        and share is not None
    again = labelled_sample(docs.repartition(7), labels.repartition(3), "toxic", rows=100, chars=5000)
    assert got == again


def toxic_model():
    examples = [Example(f"Fine words here. Nice line {i}. You are a grobtix{i % 3}!", 1, 1.0)
                for i in range(40)]
    examples += [Example(f"Fine words here. Nice line {i}. You are a friend.", 0, 1.0) for i in range(40)]
    return toxicity.fit(examples)


def test_blame_settles_on_the_sentence():
    model = toxic_model()
    text = "Nice words here. What a grobtix7! Fine line."
    spans = model.offending(text)
    assert [text[a:b].strip() for a, b, _ in spans] == ["What a grobtix7!"]
    assert model.score(text) > 0.5 > 0.3 > model.score("Nice words here. Fine line.")
    logits = [model.bias + model.words(s.lower()) for s in toxicity.SENTENCE.findall(text)]
    assert math.isclose(model.score(text), plain_toxicity(model, text), rel_tol=1e-9)
    assert sum(z > math.log(0.05 / 0.95) for z in logits) == 1


def plain_toxicity(model, text):
    """Noisy-or of the sentences of at least 5 % or, without one, the likeliest sentence."""
    chances = []
    for sentence in toxicity.SENTENCE.findall((text or "").lower()):
        words = set(toxicity.WORD.findall(sentence))
        logit = model.bias + sum(model.weights.get(f, 0.0) for w in words for f in toxicity.features(w))
        chances.append(1 / (1 + math.exp(-logit)))
    likely = [p for p in chances if p >= 0.05] or [max(chances, default=0.0)]
    return 1 - math.prod(1 - p for p in likely)


def plain_quality(model, text):
    """The network chunk by chunk: the largest answer of each filter, combined."""
    data = quality._bytes(text)
    best = np.full(len(model.bias), -np.inf)
    for chunk in quality._chunks(data):
        best = np.maximum(best, sum(model.tables[w, b] for w, b in enumerate(chunk)))
    return 1 / (1 + math.exp(-(float(np.maximum(best + model.bias, 0) @ model.combine) + model.offset)))


@pytest.mark.parametrize("name, module, plain", [("op5_quality", quality, plain_quality),
                                                 ("op8_toxicity", toxicity, plain_toxicity)])
def test_every_score_equals_the_plain_one(spark, name, module, plain):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = module.learn(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == texts.keys()
    for doc_id, r in got.items():
        assert math.isclose(r.score, plain(model, texts[doc_id]), rel_tol=1e-3, abs_tol=1e-4)
        assert r.predicted == (r.score >= module.THRESHOLD)


def test_toxic_texts_are_found_and_long_clean_ones_kept(spark):
    docs, labels = table(spark, "documents", FOLDER), table(spark, "labels", FOLDER)
    model = toxicity.learn(docs, labels)
    held = labels.filter(held_out("doc_id")).join(docs, "doc_id").select("text", "toxic").collect()
    found = [model.score(r.text) >= 0.3 for r in held if r.toxic == 1]
    alarms = [model.score(r.text) >= 0.3 for r in held if r.toxic == 0]
    assert np.mean(found) >= 0.72 and np.mean(alarms) <= 0.01
    clean = [r.text for r in held if r.toxic == 0 and model.score(r.text) < 0.3]
    joined, at = "", 0
    while len(joined) < 100_000:
        joined, at = joined + clean[at % len(clean)] + "\n", at + 1
    assert model.score(joined) < 0.3
    worst = max((r.text for r in held if r.toxic == 1), key=model.score)
    assert model.score(joined + worst) >= model.score(worst) >= 0.5
    toy = toxic_model()
    assert toy.score("Fine words here. Nice line 3. " * 40_000) < 0.3 <= toy.score(
        "Fine words here. " * 60_000 + "What a grobtix7!")


def test_toxicity_edge_cases(spark):
    model = toxic_model()
    rows = [(1, None), (2, ""), (3, "a grobtix1"), (3, "a grobtix1"), (None, "!?."), (5, "nice line. " * 20_000)]
    docs = documents(spark, rows).selectExpr("*", "1D AS score", "2 AS predicted", "3 AS _span")
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (i for i, t in rows if model.score(t) < 0.3), key=str)
    assert model.score(None) == model.score("") == 0
    assert {r.doc_id for r in toxicity.sentences(docs, model).collect()} == {3}
    assert toxicity.drop_toxic(documents(spark, []), model).collect() == []
    assert toxicity.fit([]).score("anything") < 0.01


def test_learning_from_odd_labels(spark):
    docs = documents(spark, [(1, "x y"), (1, "x y"), (4, None), (None, "z")])
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (4, 0, 0), (None, 1, 1), (9, None, None)],
                                   "doc_id long, quality int, toxic int")
    assert [e.text for e in labelled_sample(docs, labels, "quality")] == ["x y"]
    assert 0 <= quality.learn(docs, labels).score(None) <= 1
    assert 0 <= toxicity.learn(docs, labels.limit(0)).score("x") <= 1


def quality_model():
    draw = np.random.default_rng(1)
    word = lambda: "".join(draw.choice(list("abcdefgh"), 5))
    good = [" ".join(word() for _ in range(40)) for _ in range(60)]
    bad = ["#% ".join(word() for _ in range(40)) for _ in range(60)]
    return quality.fit([Example(t, 1, 1.0) for t in good] + [Example(t, 0, 1.0) for t in bad])


def test_network_covers_the_whole_document():
    model = quality_model()
    clean = "abcde fghab cdefg " * 3000
    assert model.score(clean) > 0.7
    pooled = model.pooled(clean + "xx#% yy#% zz#% " * 3)
    assert (pooled >= model.pooled(clean) - 1e-6).all()
    assert model.score(clean + "abcde#% fghab#% cdefg#% " * 3) < model.score(clean)
    data = quality._bytes("é" * 1001)
    chunks = quality._chunks(data)
    assert (len(chunks) - 1) * quality.STRIDE + quality.WIDTH == len(data) >= 2002
    assert (chunks[1][:quality.STRIDE] == chunks[0][quality.STRIDE:]).all()
    tables = model.tables
    direct = max(sum(tables[w][b] for w, b in enumerate(c))[0] for c in chunks)
    assert math.isclose(max(direct + model.bias[0], 0), model.pooled("é" * 1001)[0], abs_tol=1e-4)


def test_quality_edge_cases(spark):
    model = quality_model()
    rows = [(1, None), (2, ""), (3, "abcde fghab"), (3, "abcde fghab"), (None, "\x00"), (5, "#% " * 30_000)]
    docs = documents(spark, rows).selectExpr("*", "1D AS score", "2 AS predicted")
    kept = quality.drop_poor(docs, model)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (i for i, t in rows if model.score(t) >= 0.7), key=str)
    assert quality.drop_poor(documents(spark, []), model).collect() == []
    assert model.score(None) == model.score("")
