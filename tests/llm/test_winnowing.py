"""Fingerprints against the definition, one window after the other."""

from __future__ import annotations

import hashlib
import random

import pytest

from weirflow.llm import winnowing
from weirflow.llm.prob_minhash import mixed
from weirflow.llm.winnowing import code_points, document_fingerprints, edited_fingerprints, winnow

import numpy as np

SCHEMA = "doc_id long, text string, row long, id long, guest string, range int"
MASK = (1 << 64) - 1


def brute_hash(run: str) -> int:
    total = 0
    for c in run:  # rolled on from left to right
        total = (total * winnowing._BASE + ord(c) + 1) & MASK
    return int(mixed(np.array([total], np.uint64), len(run))[0]) >> 32


def brute(text: str, noise: int = 20, guarantee: int = 50) -> list[tuple[int, int]]:
    if not text:
        return []
    k = min(noise, len(text))
    hashes = [brute_hash(text[i : i + k]) for i in range(len(text) - k + 1)]
    width = min(guarantee - noise + 1, len(hashes))
    chosen = set()
    for start in range(len(hashes) - width + 1):
        window = range(start, start + width)
        chosen.add(min(window, key=lambda i: (hashes[i], -i)))
    return [(hashes[i], i) for i in sorted(chosen)]


def told(text: str, **settings) -> list[tuple[int, int]]:
    hashes, positions = winnow(code_points(text), **settings)
    return list(zip(hashes.tolist(), positions.tolist(), strict=True))


def texts() -> list[str]:
    random.seed(3)
    words = ["so", "Größe", "x", "日本語", "naïve", "á", "🦊", "\n", "\t", "1234567"]
    made = ["", "a", "ab" * 9, "a" * 19, "a" * 20, "a" * 49, "a" * 50, "a" * 51, "ab" * 400, " ", "\x00" * 70]
    return made + [" ".join(random.choices(words, k=n)) for n in (3, 8, 20, 60, 200, 700)]


def test_winnowing_matches_its_definition():
    for text in texts():
        assert told(text) == brute(text), text
        assert told(text, noise=3, guarantee=7) == brute(text, 3, 7), text
        assert told(text, noise=5, guarantee=5) == brute(text, 5, 5), text


def test_blocks_of_a_long_text_make_no_difference(monkeypatch):
    text = " ".join(texts()) * 3
    whole = told(text)
    for block in (1, 7, 64, 1000):
        monkeypatch.setattr(winnowing, "BLOCK", block)
        assert told(text) == whole


def test_equal_hashes_choose_the_rightmost():
    assert [p for _, p in told("a" * 100)] == list(range(30, 81))


def test_shared_passages_of_the_guaranteed_length_are_met():
    random.seed(5)
    letters = "abcdefghij "
    for _ in range(200):
        passage = "".join(random.choices(letters, k=50))
        marks = []
        for _ in range(2):
            before, after = ("".join(random.choices(letters, k=random.randrange(200))) for _ in range(2))
            marks.append({(h, p - len(before)) for h, p in told(before + passage + after) if 0 <= p - len(before) <= 30})
        assert marks[0] & marks[1]


def expected(docs: list[tuple]) -> list[tuple]:
    """Rows by plain Python; ids must be distinct."""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0), reverse=True)
    found = []
    for at, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        sets = [{h for h, _ in brute(x)} for x in (text, edited, after)]
        like = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        written = [" ".join(f"{h:08x}@{p}" for h, p in brute(x)) for x in (text, edited)]
        found.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), *written, *like))
    return sorted(found, key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, 2, "g", 3) for i, t in docs], SCHEMA)


@pytest.mark.parametrize("ranges", [1, 3, 1000])
def test_query_matches_brute_force(spark, rows, monkeypatch, ranges):
    made = texts()
    random.seed(ranges)
    docs = [(i * 7 - 100, random.choice(made) + str(i % 5)) for i in range(120)] + [(10**12, None), (-(2**60), ""), (None, "last of all")]
    random.shuffle(docs)
    monkeypatch.setattr(winnowing, "RANGE_ROWS", max(1, len(docs) // ranges))
    got = edited_fingerprints(frame(spark, docs))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert rows(got) == expected(docs)


def test_repeated_rows_and_ids_each_have_a_row(spark, rows, monkeypatch):
    monkeypatch.setattr(winnowing, "RANGE_ROWS", 1)
    same = "one text that stands here three times over, word by word"
    docs = [(5, same)] * 3 + [(4, "other")] + [(None, "x"), (None, "x"), (9, None), (9, "")]
    got = rows(edited_fingerprints(frame(spark, docs)))
    assert sorted((r[0] is None, r[0] or 0, r[1]) for r in got) == sorted((i is None, i or 0, len(t or "")) for i, t in docs)
    assert {r[3] for r in got if r[0] == 5} == {" ".join(f"{h:08x}@{p}" for h, p in brute(same))}
    assert [r[6] for r in got if r[0] == 5 and r[6] == 1.0] == [1.0, 1.0]


def test_one_row_is_its_own_successor(spark, rows):
    text = "a single text, long enough to have more than one window of its own, and more"
    for doc in (3, None):
        got = rows(edited_fingerprints(frame(spark, [(doc, text)])))
        assert got == expected([(doc, text)])


def test_empty_table(spark):
    assert edited_fingerprints(frame(spark, [])).count() == 0
    assert document_fingerprints(frame(spark, [])).count() == 0


def test_marks_of_every_row(spark):
    docs = [(i, t) for i, t in enumerate(texts())] + [(None, None), (3, "ab" * 9), (3, "ab" * 9)]
    got = document_fingerprints(frame(spark, docs)).collect()
    assert sorted((repr(r.doc_id), r.n_chars, [tuple(m) for m in r.marks]) for r in got) == sorted(
        (repr(i), len(t or ""), brute(t or "")) for i, t in docs
    )
