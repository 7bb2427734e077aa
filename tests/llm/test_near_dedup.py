from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from weirflow.llm.components import components
from weirflow.llm.near_dedup import near_dedup, near_duplicates
from weirflow.llm.prob_minhash import jaccard, probability_jaccard, shingles, signatures, similarity, weights

SCHEMA = "doc_id long, text string, row long, label string, key string"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "l", "k") for i, t in docs], SCHEMA)


def weighted(text):
    """A text's shingles as they are defined: runs of five words, each with its weight."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    runs = Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()
    return Counter({run: 1 + math.log(n) for run, n in runs.items()})


def brute(docs):
    """Classes by comparing every pair by the definition of their similarity."""
    sets = [weighted(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (docs[i][1] or "") == (docs[j][1] or "") or sets[i].keys() & sets[j].keys() and probability_jaccard(sets[i], sets[j]) >= 0.8 - 1e-9:
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc, _) in enumerate(docs):
        groups.setdefault(root(i), []).append(doc)
    order = lambda d: (d is None, d or 0)
    return Counter((doc, min(g, key=order), len(g)) for g in groups.values() for doc in g)


def edited(words, n, vocabulary):
    words = list(words)
    for at in random.sample(range(len(words)), n):
        words[at] = random.choice(vocabulary)
    return " ".join(words)


def test_classes_match_brute_force(spark):
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [(0, None), (1, ""), (2, "..."), (3, "!!"), (4, "..."), (5, "one two"), (6, "One, two!"), (None, "one two"), (7, "one three"), (5, "one two")]
    passage = random.choices(vocabulary, k=60)
    for g in range(12):  # copies edited more and more, so similarities lie around the threshold
        base = random.choices(vocabulary, k=150)
        docs += [(100 * g + 10 + i, edited(base, n, vocabulary)) for i, n in enumerate([0, 0, 1, 2, 3, 4, 5, 6, 8, 12])]
    docs += [(5000 + i, " ".join(passage + random.choices(vocabulary, k=40))) for i in range(40)]
    docs += [(6000, "x y z " * 20000), (6001, "x y z " * 20001)]
    got = near_duplicates(frame(spark, docs)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == brute(docs)
    kept = [r.doc_id for r in got if r.kept]
    assert Counter(kept) == Counter({c for _, c, _ in brute(docs)})

    left = near_dedup(frame(spark, docs))
    assert left.columns == ["doc_id", "text", "row", "label", "key"]
    assert Counter(r.doc_id for r in left.collect()) == Counter(kept)


def test_repeated_blocks_match_brute_force(spark):
    random.seed(12)
    docs, linked = [], 0
    for g in range(60):  # a vocabulary per group, so that nothing but the pair is alike
        words = lambda n: " ".join(f"g{g}w{random.randrange(10**6)}" for _ in range(n))
        base, block = words(160), words(6 + g % 5) + " "
        docs += [(10 * g, base), (10 * g + 1, base + " " + block * (1, 10, 100, 1000)[g % 4])]
        base, block = words(160), words(20) + " "
        # Near the threshold the weights decide: a block stands more often on one side only.
        docs += [(10 * g + 2, base + " " + block * 2), (10 * g + 3, base + " " + block * (2, 3, 5, 1000)[g % 4])]
    want = brute(docs)
    sizes = Counter(size for _, _, size in want)
    assert sizes[1] > 20 and sizes[2] > 20
    got = near_duplicates(frame(spark, docs)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want


def test_similarity_is_the_probability_jaccard_of_weighted_shingles():
    random.seed(21)
    for _ in range(200):
        words = [f"w{i}" for i in range(random.randint(1, 12))]
        texts = [" ".join(random.choices(words, k=random.choice([0, 1, 4, 5, 30, 80]))) for _ in range(2)]
        one, two = (shingles(t.encode()) for t in texts)
        assert abs(similarity(one, two) - probability_jaccard(weighted(texts[0]), weighted(texts[1]))) < 1e-9
    one, two = (shingles(t.encode()) for t in ("a b c d e f g", "a b c d e f h"))
    assert similarity(one, two) == jaccard(one[0], two[0]) == 0.5


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    assert near_dedup(frame(spark, [])).count() == 0


def test_registers_estimate_probability_jaccard():
    random.seed(4)
    for share in (0.3, 0.6, 0.9):
        words = list(range(300))
        x = {w: random.randint(1, 4) for w in words if random.random() < 0.8}
        y = {w: (x[w] if w in x and random.random() < share else random.randint(1, 4)) for w in words if random.random() < 0.9}
        hashed = [(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array([s[w] for w in sorted(s)])) for s in (x, y)]
        a, b = signatures(hashed, 1999)
        true = probability_jaccard(*(Counter({w: float(weights(np.array(n))) for w, n in s.items()}) for s in (x, y)))
        assert abs((a == b).mean() - true) < 4 * (true * (1 - true) / 1999) ** 0.5 + 0.01


def test_signatures_do_not_depend_on_the_batch():
    texts = [b"a b c d e f g h", b"one", b"", b"x y z " * 500]
    sets = [shingles(t) for t in texts]
    together = signatures(sets)
    for i in range(len(sets)):
        assert (signatures([sets[i]])[0] == together[i]).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(70)] + [(1000, 1001 + i) for i in range(50)] + [(2001, 2000), (2000, 2001)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(71)} | {1000 + i: 1000 for i in range(51)} | {2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
