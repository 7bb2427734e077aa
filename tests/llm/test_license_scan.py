from __future__ import annotations

import random
import re

from weirflow.llm.common import byte_words
from weirflow.llm.license_scan import BASE_PHRASES, TEMPLATES, LicenseScanner, SuffixAutomaton, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_matching_statistics_match_brute_force():
    random.seed(5)
    for _ in range(60):
        sequences = [[random.randrange(3) for _ in range(random.randrange(1, 9))] for _ in range(3)]
        text = [random.randrange(4) for _ in range(30)]
        parts = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a, len(s) + 1)}
        automaton = SuffixAutomaton(sequences)
        for i, (state, length) in enumerate(automaton.statistics(text)):
            want = max(n for n in range(i + 2) if tuple(text[i + 1 - n : i + 1]) in parts)
            assert length == want
            places = {(number, end): size for number, end, size in automaton.places(state, length, 1)}
            for number, sequence in enumerate(sequences):
                for end in range(len(sequence)):
                    both = zip(reversed(sequence[: end + 1]), reversed(text[: i + 1]))
                    common = next((n for n, (x, y) in enumerate(both) if x != y), min(end, i) + 1)
                    assert places.get((number, end), 0) == common


def brute(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    places = [
        (i, label)
        for phrase, label in BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places_match_brute_force(spark):
    random.seed(7)
    pieces = [*BASE_PHRASES, "gnu general public", "license", "mit", "The", "CC", "by-nc", "x", "Öffentlich", "apache", "cc-by!"]
    texts = [" ".join(random.choices(pieces, k=random.randrange(12))) for _ in range(200)] + [None, "", "...", "mit license " * 20000]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(texts)] + [(None, "MIT License", 1, "z")], "doc_id long, text string, score int, labels string")
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0.0 <= r.score <= 1.0
    assert got[None].base_labels == "mit"
    assert scan_licenses(docs.limit(0)).count() == 0


def test_templates_are_found_with_gaps_and_nothing_else(spark):
    words = byte_words(TEMPLATES["mit-text"].encode())
    gappy = b" ".join(words[:20] + [b"INSERTED"] + words[21:]).decode()
    docs = spark.createDataFrame([(1, "Intro. " + gappy + " End."), (2, "permission is a free word, and so is copy of the software"), (3, TEMPLATES["gpl-notice"])], "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert got[1].labels == "mit-text" and got[1].score > 0.9
    (span,) = got[1].spans
    assert (span.start, span.stop) == (1, 1 + len(words))
    assert got[2].labels == "" and got[2].score == 0.0
    assert got[3].labels == "gpl,gpl-notice"


def brute_spans(text, template):
    """All maximal common runs of three words or more, their best chains, and of those the best that do not overlap."""
    runs = []
    for a in range(len(text)):
        for c in range(len(template)):
            n = 0
            while a + n < len(text) and c + n < len(template) and text[a + n] == template[c + n]:
                n += 1
            if n >= 3 and not (a and c and text[a - 1] == template[c - 1]):
                runs.append((a, a + n, c, c + n))
    runs.sort(key=lambda m: (m[1], m[3], m[0]))
    best = []
    for i, (a, b, c, d) in enumerate(runs):
        chains = [(b - a, a)]
        for j in range(i):
            gain = min(b - max(a, runs[j][1]), d - max(c, runs[j][3]))
            if gain > 0 and a - runs[j][1] <= 8 and c - runs[j][3] <= 8:
                chains.append((best[j][0] + gain, best[j][1]))
        best.append(max(chains, key=lambda x: x[0]))
    spans = []
    for i in sorted(range(len(runs)), key=lambda i: (-best[i][0], runs[i][1] - best[i][1], best[i][1])):
        cover, start, stop = best[i][0], best[i][1], runs[i][1]
        if cover >= 0.6 * len(template) and all(stop <= x or y <= start for x, y, _ in spans):
            spans.append((start, stop, min(1.0, cover / len(template))))
    return sorted(spans)


def test_spans_match_brute_force():
    random.seed(13)
    met = 0
    for _ in range(300):
        templates = {f"t{i}": " ".join(random.choices("abcd", k=random.randrange(6, 14))) for i in range(3)}
        parts = [*templates.values(), "a", "x y", "b c", " ".join("x" * 12)]
        text = " ".join(random.choices(parts, k=5)).split()
        for _ in range(random.randrange(4)):
            text.insert(random.randrange(len(text)), random.choice("abx"))
        _, got = LicenseScanner({}, templates).scan([w.encode() for w in text])
        for i, template in enumerate(templates.values()):
            want = brute_spans(text, template.split())
            ours = sorted((a, b, c) for t, a, b, c in got if t == i)
            assert [round(c, 9) for *_, c in ours] == [round(c, 9) for *_, c in want], (text, template)
            assert [(a, b) for a, b, _ in ours] == [(a, b) for a, b, _ in want], (text, template)
            met += len(want)
    assert met > 300


def test_passages_that_stand_twice_and_phrases_of_one_word(spark):
    template = "alpha beta gamma one two three alpha beta gamma four five six"
    words = template.split()
    gappy = " ".join([*words[:3], "x", *words[3:6], "y", *words[6:9], "z", *words[9:]])
    docs = spark.createDataFrame([(1, gappy), (2, "foo unlicense bar"), (3, f"{template} {template}")], "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licenses(docs, phrases={"unlicense": "unlicense"}, templates={"t": template}).collect()}
    assert [(s.start, s.stop, s.cover) for s in got[1].spans] == [(0, 15, 1.0)]
    assert (got[2].n_base, got[2].first_word, got[2].base_labels) == (1, 1, "unlicense")
    assert [(s.start, s.stop) for s in got[3].spans] == [(0, 12), (12, 24)]
