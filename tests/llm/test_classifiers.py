"""Quality and toxicity: held-out accuracy on made-up texts, and defined results at the edges."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm.pu_quality import _risk, estimate_prior, fit, keep_quality, score_quality, train_quality
from weirflow.llm.sampling import held_out, unlabelled_texts
from weirflow.llm.toxicity import Landmarks, UnitMachine, clear_stems, score_toxicity, stems, train_toxicity, units

SYLLABLES = "ba ke li mo nu ra se ti vo za pre sta gro".split()


def sentence(n):
    return " ".join("".join(random.choices(SYLLABLES, k=random.randint(1, 4))) for _ in range(n)) + "."


def learn(key):
    return ~held_out(key, 5, 0)


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(9)
    rows, labels = [], []
    for i in range(2000):
        text, bad, toxic = sentence(random.randint(8, 80)), random.random() < 0.2, random.random() < 0.2
        if bad:
            text = random.choice([" ".join(w + "$$%" for w in text.split()), text.upper() + "!!", " | ".join(text.split()), (text.split()[0] + " ") * 30])
        if toxic:
            insult = random.choice(["grumbler", "nastyhead", "dunderfool"])
            text = text + " " + random.choice([insult, insult + random.choice(SYLLABLES), insult[:4] + "x" + insult[4:]]) + " so."
        rows.append((i, text, 1.0, 7))
        if i % 2:
            labels.append((i, int(not bad), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, predicted int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, marks


def accuracy(scored, marks, target):
    both = scored.join(marks, "doc_id").where(held_out(F.col("doc_id"), 5, 0))
    return both.agg(F.avg((F.col("predicted") == F.col(target)).cast("int"))).first()[0]


def edges(spark):
    return spark.createDataFrame([(1, None), (1, None), (2, ""), (None, "a"), (3, "w " * 30000), (4, "\x00 é")], "doc_id long, text string")


def test_quality_on_held_out_texts(spark, corpus):
    docs, marks = corpus
    model = train_quality(docs, marks, learn)
    assert 0.6 < model.prior < 0.95
    scored = score_quality(docs.select("doc_id", "text"), model, ["doc_id"])
    # On so few texts the prior is some percent too high, and as many bad texts pass.
    assert accuracy(scored, marks, "quality") > 0.94
    assert accuracy(scored, marks.where("quality = 1"), "quality") > 0.99
    found = score_quality(edges(spark), model, ["doc_id"]).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 and r.predicted == (r["score"] >= 0.3) for r in found)
    left = keep_quality(docs, marks, learn)
    assert left.columns == docs.columns and {r.predicted for r in left.collect()} == {7}
    assert 0.7 < left.count() / docs.count() < 0.9
    assert score_quality(edges(spark).limit(0), model, ["doc_id"]).count() == 0


def test_quality_without_anything_to_learn_from(spark, corpus):
    docs, marks = corpus
    for labels in (marks.limit(0), marks.where("quality = 0"), marks.select(F.lit(None).cast("long").alias("doc_id"), "quality")):
        assert train_quality(docs, labels, learn) is None
    assert {(r["score"], r.predicted) for r in score_quality(edges(spark), None, ["doc_id"]).collect()} == {(0.5, 1)}


def test_labels_of_zero_and_held_out_labels_change_nothing(spark, corpus):
    docs, marks = corpus
    plain = train_quality(docs, marks, learn)
    other = marks.withColumn("quality", F.when(held_out(F.col("doc_id"), 5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (train_quality(docs, other, learn).weights == plain.weights).all()


def test_unlabelled_sample_is_drawn_from_what_has_no_label(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    marks = docs.where("doc_id % 50 > 0").select("doc_id")
    got = [r.text for r in unlabelled_texts(docs, marks, F.lit(True), 100, "doc_id", "text").collect()]
    assert sorted(map(int, got)) == list(range(0, 3000, 50))


def test_prior_and_risk():
    rng = np.random.default_rng(0)
    p, n = rng.normal(2, 1, 4000), rng.normal(-3, 1, 4000)
    assert abs(estimate_prior(p[:2000], np.concatenate([p[2000:3400], n[:600]])) - 0.7) < 0.06
    # The gradients are those of the risk where it is not cut off.
    mp, mu = rng.normal(0, 1, 7), rng.normal(0, 1, 9)
    by_p, by_u, risk = _risk(mp, mu, 0.4)
    for i in range(7):
        step = np.eye(7)[i] * 1e-6
        assert abs((_risk(mp + step, mu, 0.4)[2] - risk) / 1e-6 - by_p[i]) < 1e-4
    for i in range(9):
        step = np.eye(9)[i] * 1e-6
        assert abs((_risk(mp, mu + step, 0.4)[2] - risk) / 1e-6 - by_u[i]) < 1e-4
    # Where it is, the step raises the part that fell below zero.
    by_p, by_u, _ = _risk(np.full(5, 9.0), np.full(5, -9.0), 0.9)
    assert (by_p > 0).all() and (by_u < 0).all()
    assert fit(np.zeros((5, 3)), np.zeros((5, 3))).score(np.zeros((1, 3))).shape == (1,)


def test_toxicity_on_held_out_texts(spark, corpus):
    docs, marks = corpus
    model = train_toxicity(docs, marks, learn)
    scored = score_toxicity(docs.select("doc_id", "text"), model, ["doc_id"])
    assert accuracy(scored, marks, "toxic") > 0.95
    said = ["you grumbler", "you g.r.u.m.b.l.e.r", "g r u m b l e r", "a grumxbler", "a quiet se ti vo.", "Pre-Stagro, mo"]
    found = score_toxicity(spark.createDataFrame(list(enumerate(said)), "doc_id long, text string"), model, ["doc_id"])
    assert [r.predicted for r in sorted(found.collect())] == [1, 1, 1, 1, 0, 0]
    found = score_toxicity(edges(spark), model, ["doc_id"]).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 and r.predicted == (r["score"] >= 0.3) for r in found)
    assert score_toxicity(edges(spark).limit(0), model, ["doc_id"]).count() == 0


def test_toxicity_with_some_toxic_texts_labelled_harmless(spark):
    random.seed(21)
    rows, true, told = [], [], []
    for i in range(1500):
        insult = ("", "grumbler", "nastyhead", "dunderfool")[i % 4 * (i % 3 == 0)]
        rows.append((i, f"{sentence(random.randint(8, 40))} {insult} so."))
        true.append((i, int(insult != "")))
        told.append((i, int(insult != "" and i % 5 != 1)))  # of each insult some texts are labelled 0
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = train_toxicity(docs, spark.createDataFrame(told, "doc_id long, toxic int"), learn)
    both = score_toxicity(docs, model, ["doc_id"]).join(spark.createDataFrame(true, "doc_id long, truth int"), "doc_id").collect()
    assert sum(r.predicted != r.truth for r in both) <= 15
    assert sum(r.truth and not r.predicted for r in both) <= 5


def test_long_units_are_learnt_from_behind_their_first_window():
    random.seed(22)
    harmless = "".join(chr(0x4E00 + random.randrange(400)) for _ in range(60))
    insult = "".join(chr(0x6000 + 7 * i) for i in range(12))
    machine = UnitMachine([insult.encode(), harmless[:24].encode()])
    # Its window from 60 on holds the insult whole; the first one is without it.
    got = machine.map([("x" * 60 + insult + "y" * 12).encode()])
    assert np.allclose(got, machine.map([(insult + "y" * 12).encode()]))


def test_characters_beyond_ascii_are_told_apart():
    text = "".join(chr(0x6000 + 29 * i) for i in range(12))
    other = "".join(chr(ord(c) + 28) for c in text)
    values, _ = Landmarks([text.encode()]).values([text.encode(), other.encode()])
    assert abs(values[0, 0] - 1) < 1e-5 and values[1, 0] < 0.1


def test_toxicity_without_anything_to_learn_from(spark, corpus):
    docs, marks = corpus
    for labels in (marks.limit(0), marks.where("toxic = 0"), marks.where("toxic = 1")):
        assert train_toxicity(docs, labels, learn) is None
    assert {(r["score"], r.predicted) for r in score_toxicity(edges(spark), None, ["doc_id"]).collect()} == {(0.0, 0)}


def test_kernel_matches_its_definition():
    def phi(text):
        out = {}
        for i in range(len(text)):
            for k in range(i + 2, min(i + 7, len(text))):
                for j in range(i + 1, k):
                    out[text[i], text[j], text[k]] = out.get((text[i], text[j], text[k]), 0) + 0.6 ** (k - i + 1)
        return out

    def kernel(a, b):
        x, y = phi(a), phi(b)
        norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
        return sum(v * y.get(t, 0) for t, v in x.items()) / norm if norm else 0.0

    marks, strings = ["loser", "banana", "aab"], ["loser", "losxer", "banan", "ab", "aabb", "xyz", "abababab"]
    values, owner = Landmarks([m.encode() for m in marks]).values([s.encode() for s in strings])
    assert owner.tolist() == list(range(len(strings)))
    for s, row in zip(strings, values, strict=True):
        assert np.allclose(row, [kernel(s, m) for m in marks], atol=1e-5)


def test_units_join_what_is_spaced_out():
    assert units(b"You, L o s e r! (ok)") == {b"you", b"l", b"o", b"s", b"e", b"r", b"loser", b"ok"}
    assert units(None) == units(b" .. ") == set()


def test_stems_with_changing_ends_are_found_by_their_rate(spark):
    random.seed(31)
    rows, labels = [], []
    for i in range(1200):
        words, toxic = sentence(random.randint(60, 120)).split(), random.random() < 0.15
        for _ in range(random.randint(3, 6) if toxic else random.random() < 0.1):  # harmless texts have one now and then
            words.insert(random.randrange(len(words)), random.choice(["wöchlk", "тупорл"]) + "".join(random.choices(SYLLABLES, k=2)))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = train_toxicity(docs, marks, learn)
    both = score_toxicity(docs, model, ["doc_id"]).join(marks, "doc_id").where(held_out(F.col("doc_id"), 5, 0)).collect()
    found = [r.predicted for r in both if r.toxic]
    false = [r.predicted for r in both if not r.toxic]
    assert sum(found) > 0.9 * len(found) > 20 and sum(false) < 0.05 * len(false)


def test_stems_are_counted_over_all_forms(spark):
    told = [(1, f"idio{e}".encode()) for e in ("t", "tic", "ten", "ts")] * 5 + [(0, w.encode()) for w in sentence(400).split()]
    clear = {r.stem: r.excess for r in clear_stems(spark.createDataFrame(told, "label int, unit binary")).collect()}
    assert "^idio" in clear and not any(x.startswith("^ba") for x in clear)
    assert stems("ab") == {"^ab"} and stems("абвгде") == {"^абвг", "абвгд", "бвгде"}
