from __future__ import annotations

import random

from weirflow.llm.exact_dedup import exact_dedup, exact_groups

SCHEMA = "doc_id long, text string, row string, id long, full string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", 7, "f") for i, t in rows], SCHEMA)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for ids in groups.values():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        first = True
        for i in ids:
            out.append((i, keep, len(ids), first and i == keep))
            first = first and i != keep
    return sorted(out, key=repr)


def test_groups_match_brute_force(spark, rows):
    random.seed(3)
    texts = [None, "", "a", "b", "ab", "ba", "é", "x" * 300 + "1", "x" * 300 + "2", "y" * 20000]
    given = [(i, random.choice(texts)) for i in range(60)] + [(5, "a"), (5, "a"), (None, "b"), (None, "q")]
    for options in ({}, {"set_bits": 64, "prefix_chars": 3}):
        got = exact_groups(frame(spark, given), **options).select("doc_id", "keep_id", "group_size", "kept")
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(given)


def test_one_row_of_each_text_stays_with_all_columns(spark):
    given = [(1, "a"), (9, "a"), (4, "a"), (4, None), (3, ""), (None, "a"), (6, "z"), (6, "z"), (6, "z")]
    left = exact_dedup(frame(spark, given))
    assert left.columns == ["doc_id", "text", "row", "id", "full"]
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(4, None), (6, "z"), (9, "a")]


def test_empty_table(spark):
    assert exact_groups(frame(spark, [])).count() == 0
    assert exact_dedup(frame(spark, [])).count() == 0


def test_columns_with_any_name_stay(spark):
    names = ["stays", "_hit", "hit", "some", "row_identity", "row", "key", "node", "label", "whole", "a.b"]
    given = spark.createDataFrame(
        [(i, t, *names) for i, t in [(1, "a"), (2, "a"), (3, "b"), (3, "b"), (None, None)]],
        ", ".join(["doc_id long", "text string", *(f"`{c}` string" for c in names)]),
    )
    left = exact_dedup(given)
    assert left.columns == given.columns
    assert sorted(((r[0], *r[2:]) for r in left.collect()), key=repr) == [(2, *names), (3, *names), (None, *names)]
