from __future__ import annotations

import random
import re

from weirflow.llm.decontaminate import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, n=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            v = words(body)
            k = min(n, len(v))
            grams = {tuple(v[a : a + k]) for a in range(len(v) - k + 1)} if v else set()
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in grams:
                    hit |= set(range(a, a + k))
                    found.add(str(item))
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


LONG = "One two three four FIVE six seven eight nine ten eleven twelve"
ITEMS = [(1, LONG), (2, "short item"), (3, None), (4, "..!"), (1, LONG), (10, "Éa short ITEM here")]
DOCS = [
    (1, "Say: one TWO three, four five six-seven eight nine ten eleven? Yes."),
    (2, "one two three four five six seven eight nine TEN. one two three four five six seven eight nine ten"),
    (3, "a Short item; and short-item again"),
    (3, "a Short item; and short-item again"),
    (None, "éa short item here"),
    (4, None),
    (5, ""),
    (6, "... !!"),
    (7, "one two three four five"),
    (8, "w " * 30000 + LONG),
]


def frames(spark, docs=DOCS, items=ITEMS):
    given = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, items string")
    return given, spark.createDataFrame([(i, t, "k") for i, t in items], "item_id long, text string, gram string")


def test_hits_match_brute_force(spark):
    for limit in (64_000_000, 0):
        got = contamination(*frames(spark), broadcast_bytes=limit)
        assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=repr) == brute(DOCS, ITEMS)


def test_contaminated_documents_go(spark):
    left = decontaminate(*frames(spark))
    assert left.columns == ["doc_id", "text", "row", "items"]
    assert sorted(r.doc_id for r in left.collect()) == [4, 5, 6, 7]


def test_spans_go_and_the_rest_stays(spark):
    docs = DOCS[:3] + [(4, None), (9, "Keep, THIS.")]
    left = {r.doc_id: r.text for r in decontaminate(*frames(spark, docs), remove="spans").collect()}
    assert left == {1: "Say: Yes.", 2: "", 3: "a and again", 4: None, 9: "Keep, THIS."}


def test_nothing_to_find(spark):
    docs, _ = frames(spark)
    _, none = frames(spark, items=[])
    assert [r.n_hit for r in contamination(docs, none).collect()] == [0] * len(DOCS)
    empty, items = frames(spark, docs=[])
    assert contamination(empty, items).count() == 0
    assert decontaminate(empty, items).count() == 0


def test_windows_of_every_size_match_brute_force(spark):
    random.seed(8)
    vocabulary = ["a", "B", "c", "Dd", "é"]
    made = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(i, made(n)) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 20])]
    docs = [(i, made(random.choice([0, 1, 3, 8, 30, 200]))) for i in range(60)] + [(100 + i, f"x {t} y") for i, t in items]
    for window in (3, 7, 10, 13):
        got = contamination(*frames(spark, docs, items[window // 2 :]), window=window)
        want = brute(docs, items[window // 2 :], window)
        assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=repr) == want


def test_columns_with_any_name_stay(spark):
    names = ["stays", "_hit", "hit", "some", "row_identity", "row", "key", "node", "label", "a.b", "spans_hit"]
    given = spark.createDataFrame(
        [(i, t, *names) for i, t in DOCS], ", ".join(["doc_id long", "text string", *(f"`{c}` string" for c in names)])
    )
    items = frames(spark)[1]
    for remove in ("documents", "spans"):
        left = decontaminate(given, items, remove=remove)
        assert left.columns == given.columns
        assert {tuple(r[2:]) for r in left.collect()} == {tuple(names)}
