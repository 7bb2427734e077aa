from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from weirflow.llm.common import ARROW_ROWS, stored
from weirflow.llm.packing import fillings, pack, pieces_of, plan_bins, Stock
from weirflow.llm.tokens import WordCache

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", "  ", "I'll can't <|endoftext|>x <|ENDOFTEXT|>", "éa.́ b c\x1cd!!'s Ünïc—.", "ΑΣ ΣΑΣ. x",
    "日本語テキスト。。 a.b", "123abc!!!'re", "ﬁ ½ ǅ" * 5, "a b c", "x.,! ...,,, e.g. (a)", "word " * 9000,
]


def ids_of(text):
    return [] if not text else Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def fewest(items, cap):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room + items[i] <= cap:
                j = bins.index(room)
                go(i + 1, bins[:j] + [room + items[i]] + bins[j + 1 :])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_plan_is_whole_and_optimal_on_small_cases():
    random.seed(1)
    for _ in range(300):
        cap = random.randint(5, 30)
        items = sorted((random.randint(1, cap) for _ in range(random.randint(0, 11))), reverse=True)
        plan = plan_bins(dict(Counter(items)), cap)
        got = Counter()
        for filling, times in plan:
            assert sum(length * n for length, n in filling) <= cap
            for length, n in filling:
                got[length] += n * times
        assert got == Counter(items)
        assert sum(times for _, times in plan) == fewest(items, cap)


def test_sequences_of_very_many_pieces_are_planned():
    for counts, fewest_known in (({2101: 3, 1: 1000}, 3), ({3: 6_000_000}, 4396), ({4: 900_001, 3: 900_001, 1: 2}, None)):
        plan, got = plan_bins(counts), Counter()
        for filling, times in plan:
            assert sum(length * n for length, n in filling) <= 4096
            got.update({length: n * times for length, n in filling})
        bound = -(-sum(length * n for length, n in counts.items()) // 4096)
        assert got == counts and sum(times for _, times in plan) == (fewest_known or bound)


def test_fillings_start_with_best_fit_and_only_get_better():
    found = list(fillings(Stock({60: 1, 30: 1, 25: 2, 15: 1, 9: 1}), 100, 1000))
    assert found[0][1] == ((60, 1), (30, 1), (9, 1))
    assert [waste for waste, _ in found] == sorted({waste for waste, _ in found}, reverse=True)
    assert found[-1] == (0, ((60, 1), (25, 1), (15, 1)))


def test_cached_ids_are_the_tokenizers(spark):
    cache = WordCache(PATH, most=40)
    for _ in range(3):
        got = cache.ids([None if t is None else t.encode() for t in ODD])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids_of(t) for t in ODD]


def check(rows, docs, cap):
    want = Counter()
    for i, text in docs:
        ids = [*ids_of(text), 1]
        for piece, at in enumerate(range(0, len(ids), cap)):
            part = ids[at : at + cap]
            want[i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= cap
    return len(places)


def test_all_pieces_are_packed_without_gaps(spark):
    random.seed(2)
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "twice"), (3, "twice")]
    docs += [(100 + i, "word " * random.randrange(700)) for i in range(150)]
    given = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, offset_ int, sequence string")
    for cap in (4096, 512):
        rows = pack(given, PATH, cap).collect()
        used = check(rows, docs, cap)
        assert used <= -(-sum(r.length for r in rows) // cap) + 1
    assert pack(given.limit(0), PATH).count() == 0


def test_common_length_is_numbered_in_groups(spark):
    docs = [(i, "same length text") for i in range(1800)]
    given = spark.createDataFrame(docs, "doc_id long, text string")
    rows = pack(given, PATH).collect()
    assert check(rows, docs, 4096) == -(-1800 * 4 // 4096)


def test_many_empty_texts_fill_up_a_sequence(spark):
    docs = [(i, "word " * 2100) for i in range(3)] + [(10 + i, None if i % 2 else "") for i in range(1000)]
    rows = pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect()
    assert check(rows, docs, 4096) == 3


def test_pieces_can_carry_their_ids(spark):
    given = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    (row,) = pieces_of(given, PATH, with_ids=True).collect()
    assert row.ids == [*ids_of("some words here"), 1]


def test_word_cache_is_bounded_and_keeps_words_met_again():
    cache, tokenizer = WordCache(PATH, most=3000, part_bytes=4000), Tokenizer.from_file(PATH)
    letters = "abcdefghijklmnop"
    rare = ["".join(letters[(n >> 4 * k) & 15] for k in range(4)) for n in range(20_000)]
    texts = [" ".join(["often", "again,", *rare[at : at + 20]]) for at in range(0, len(rare), 20)]
    largest = 0
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        got = cache.ids([t.encode() for t in some])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        largest = max(largest, len(cache.known))
        assert at == 0 or {b"often", b"again,"} <= cache.known.keys()
    assert largest <= 3000 + 2 * 4000 // 5  # one part more than ``most`` at the most


def test_batches_are_small_only_while_a_step_is_stored(spark):
    before = spark.conf.get(ARROW_ROWS)

    def sizes(batches):
        for batch in batches:
            yield batch.from_pydict({"n": [batch.num_rows]})

    def largest(batch_rows):
        counted = spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n long")
        return max(r.n for r in stored(counted, "sizes", batch_rows).collect())

    assert (largest(100), spark.conf.get(ARROW_ROWS)) == (100, before)
    assert largest(None) == min(3000, int(before))
