"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, flat_map_texts, stored
from .prob_minhash import mixed
from .sampling import labelled_texts

#: Texts a model is fitted on, at most about so many. Of what they hold: units of harmless
#: texts (the most frequent and as many others), toxic texts, and units of each of those.
MOST_TEXTS, MOST_HARMLESS, MOST_TOXIC_TEXTS, MOST_UNITS = 20_000, 10_000, 800, 120
THRESHOLD = 0.3
#: Landmarks at most from toxic texts and from harmless ones; units are alike from ALIKE on;
#: candidates for landmarks so many that they meet at most PAIRS times with units.
LANDMARKS, CALM_LANDMARKS, ALIKE, PAIRS = 96, 64, 0.45, 20_000_000
#: A unit is toxic evidence when the texts that hold it or something alike are more than
#: harmless texts would have it by MARGIN standard deviations over what the most extreme
#: of as many candidates reaches by chance, sqrt(2 ln n).
MARGIN = 1.0
#: The kernel counts subsequences of three characters within SPAN, each at DECAY per
#: character spanned; a unit longer than WIDTH is seen through windows of it.
SPAN, DECAY, WIDTH, STRIDE = 7, 0.6, 24, 12
#: Stems are runs of so many characters of a unit, its start being one of them. A stem is
#: clear when toxic texts hold units with it TIMES as often as harmless ones, by their
#: numbers of units, and the excess is beyond chance; the MOST_STEMS clearest are used.
#: Of each the STEM_UNITS most frequent units are candidates for landmarks.
STEM, TIMES, MOST_STEMS, STEM_UNITS = 5, 3.0, 2_000, 6
#: Subsequences are numbered below SLOTS: those of a-z and 0-9 each by its own number,
#: those with other characters by a hash of all three characters.
PLAIN, SLOTS = 36, 1 << 21
#: Rounds in which harmless units that look toxic are added, and how many at a time;
#: steps, rate and penalty of the SVM.
ROUNDS, HARD, STEPS, RATE, PENALTY = 3, 4_000, 300, 0.05, 1e-4

_LOWER = bytes(c + 32 if chr(c) in UPPER else c for c in range(256))
_ENDS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACED = re.compile(rb"(?<!\S)(?:\S\s){2,}\S[.,;:!?]*(?!\S)")

#: All (i, j, k) with i < j < k < WIDTH and k - i < SPAN, by i, with the weight of their span.
_PLACES = np.array(
    [(i, j, k) for i in range(WIDTH) for k in range(i + 2, min(i + SPAN, WIDTH)) for j in range(i + 1, k)]
)
_DECAYS = DECAY ** (_PLACES[:, 2] - _PLACES[:, 0] + 1.0)


def units(data: bytes | None) -> set[bytes]:
    """The distinct lower-cased strings between blanks, without signs around them.

    Single characters that stand spaced out ("l o s e r") are one unit too.
    """
    if not data:
        return set()
    low = data.translate(_LOWER)
    found = {x.strip(_ENDS) for x in set(low.split())}
    if any(len(x) == 1 for x in found):
        found |= {b"".join(m.split()).strip(_ENDS) for m in _SPACED.findall(low)}
    found.discard(b"")
    return found


def windows(unit: bytes) -> list[bytes]:
    """The windows a unit is seen through; each is a unit of one window."""
    text = unit.decode("utf-8", "replace")
    return [text[at : at + WIDTH].encode("utf-8", "replace") for at in range(0, max(1, len(text) - WIDTH + STRIDE), STRIDE)]


def seen_units(data: bytes | None) -> set[bytes]:
    """The distinct windows of a text's units, without those of signs alone: what is learnt from."""
    return {w for u in units(data) for w in (windows(u) if len(u) > WIDTH else (u,)) if w.strip(_ENDS)}


def encode(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all windows of the units as a matrix, and whose they are.

    Signs are -1: they take up room in a span but are in no subsequence. So is
    what lies beyond the end.
    """
    texts, owner = [], []
    for i, x in enumerate(strings):
        text = x.decode("utf-8", "replace")
        for at in range(0, max(1, len(text) - WIDTH + STRIDE), STRIDE):
            texts.append(text[at : at + WIDTH])
            owner.append(i)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    symbol = np.where(
        (codes >= 97) & (codes <= 122),
        codes - 97,
        np.where((codes >= 48) & (codes <= 57), codes - 48 + 26, np.where(codes < 128, -1, PLAIN + codes)),
    )
    matrix = np.full((len(texts), WIDTH), -1, np.int64)
    matrix[np.arange(WIDTH) < lengths[:, None]] = symbol
    return matrix, np.array(owner, np.int64)


def _triples(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, the subsequences as numbers, with their weights (0 where beyond the end)."""
    a, b, c = (_slots(matrix, i)[:, _PLACES[:, i]] for i in range(3))
    signs = matrix < 0
    there = ~(signs[:, _PLACES[:, 0]] | signs[:, _PLACES[:, 1]] | signs[:, _PLACES[:, 2]])
    return np.where(there, a ^ b ^ c, 0), np.where(there, _DECAYS, 0.0)


def _slots(matrix: np.ndarray, turn: int) -> np.ndarray:
    """What each symbol gives to the number of a subsequence in which it is the ``turn``-th."""
    out, other = matrix << (6 * (2 - turn)), matrix >= PLAIN
    if other.any():
        out[other] = (mixed(matrix[other].astype(np.uint64), turn + 1) % np.uint64(SLOTS)).astype(np.int64)
    return out


def _norms(triples: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Root of each row's kernel with itself: equal subsequences of a row are summed first."""
    order = np.argsort(triples, axis=1, kind="stable")
    key, weight = np.take_along_axis(triples, order, 1), np.take_along_axis(weights, order, 1)
    starts = np.concatenate([np.ones((len(key), 1), bool), key[:, 1:] != key[:, :-1]], axis=1)
    sums = np.add.reduceat(weight.ravel(), np.flatnonzero(starts.ravel()))
    rows = np.repeat(np.arange(len(key)), starts.sum(axis=1))
    return np.sqrt(np.bincount(rows, sums * sums, len(key)))


class Landmarks:
    """The kernel's values with a few fixed units, without going through pairs.

    The kernel is an inner product over subsequences, so a table from those the
    landmarks have to their weights in each landmark gives all values at once.
    """

    def __init__(self, strings: list[bytes]):
        matrix, owner = encode(strings)
        triples, weights = _triples(matrix)
        n = len(strings)
        known, place = np.unique(triples, return_inverse=True)
        table = np.zeros((len(known) + 1, n))
        np.add.at(table, (place.reshape(triples.shape) + 1, owner[:, None]), weights)
        self.index = np.zeros(SLOTS, np.int32)
        self.index[known] = np.arange(1, len(known) + 1)
        self.table = (table / np.maximum(np.sqrt((table**2).sum(axis=0)), 1e-12)).astype(np.float32)

    def values(self, strings: list[bytes], block: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """Normalised kernel of each window of the units with each landmark, and the owners."""
        matrix, owner = encode(strings)
        out = np.empty((len(matrix), self.table.shape[1]), np.float32)
        for at in range(0, len(matrix), block):
            triples, weights = _triples(matrix[at : at + block])
            norm = np.maximum(_norms(triples, weights), 1e-12)
            places = self.index[triples]
            total = np.zeros((len(triples), self.table.shape[1]), np.float32)
            for t in range(triples.shape[1]):
                if weights[:, t].any():
                    total += self.table[places[:, t]] * weights[:, t, None].astype(np.float32)
            out[at : at + block] = total / norm[:, None]
        return out, owner

    def combined(self, weights: np.ndarray) -> np.ndarray:
        """One weight per subsequence for a weight per landmark: what a linear model needs."""
        return (self.table @ weights)[self.index].astype(np.float32)


@dataclass(frozen=True)
class ToxicModel:
    """Margins of units by a weight per subsequence, and the chance a text's margins give."""

    table: np.ndarray
    bias: float
    calibration: tuple[float, float, float, float]

    def margins(self, strings: list[bytes], block: int = 2048) -> np.ndarray:
        """The largest margin among the windows of each unit."""
        matrix, owner = encode(strings)
        out = np.full(len(strings), -np.inf)
        for at in range(0, len(matrix), block):
            # Short rows first need few columns: cut to what the block needs.
            part = matrix[at : at + block]
            triples, weights = _triples(part)
            used = weights.any(axis=0)
            triples, weights = triples[:, used], weights[:, used]
            if triples.shape[1]:
                value = (self.table[triples] * weights).sum(axis=1) / np.maximum(_norms(triples, weights), 1e-12)
            else:
                value = np.zeros(len(part))
            np.maximum.at(out, owner[at : at + block], value + self.bias)
        return out

#: What a text without any unit has as its best margin.
NO_MARGIN = -3.0
#: Units that a text is taken to have besides its own, when its share of toxic ones is told.
MORE_UNITS = 20.0


class Scorer:
    """Best margin, number of toxic units and of all units of texts; margins of units are remembered."""

    def __init__(self, model: ToxicModel, most: int = 200_000):
        self.model, self.most = model, most
        self.known: dict[bytes, float] = {}

    def tell(self, texts: list[bytes | None]) -> list[tuple[float, int, int]]:
        held = [units(x) for x in texts]
        if len(self.known) > self.most:
            self.known.clear()
        new = sorted(set().union(*held) - self.known.keys(), key=len)
        self.known.update(zip(new, self.model.margins(new).tolist(), strict=True))
        rows = []
        for mine in held:
            margins = list(map(self.known.__getitem__, mine))
            rows.append((max(NO_MARGIN, *margins, NO_MARGIN), sum(m > 0 for m in margins), len(mine)))
        return rows


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear SVM with squared hinge loss, weighted, by Adam over all examples."""
    w, b = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    weight = weight / weight.sum()
    for step in range(1, STEPS + 1):
        short = np.maximum(0, 1 - y * (x @ w + b))
        pull = -2 * weight * y * short
        slope = np.append(x.T @ pull + PENALTY * w, pull.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and constant of a logistic regression with a slight penalty, by Newton steps."""
    z = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([1e-2] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (p - y) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _best_of(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` units the largest value among its windows."""
    out = np.zeros((n, values.shape[1]), np.float32)
    np.maximum.at(out, owner, values)
    return out


def stems(unit: str) -> set[str]:
    """The runs of STEM characters of a unit, behind a sign for its start."""
    marked = "^" + unit
    return {marked[at : at + STEM] for at in range(max(1, len(marked) - STEM + 1))}


def _stems_of(unit):
    """The same as a column: an array of strings."""
    marked = F.concat(F.lit("^"), unit)
    last = F.greatest(F.char_length(marked) - (STEM - 1), F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda at: F.substring(marked, at, F.lit(STEM))))


def clear_stems(told: DataFrame) -> DataFrame:
    """(stem, excess) of stems that toxic texts hold far more often than harmless ones.

    ``told`` has (label, unit) for each text and unit. Forms of one word that each
    stand in a text or two are counted together here, before anything is ranked;
    and they are weighed by how often they stand among the units of either side,
    so a stem that harmless texts have now and then can still be evidence.
    """
    # The kernel sees nothing in a unit of fewer than three characters.
    seen = told.where(F.char_length(F.col("unit").cast("string")) >= 3)
    counted = seen.groupBy(F.col("unit").cast("string").alias("unit")).agg(
        F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("harmless")
    )
    each = stored(
        counted.select(F.explode(_stems_of(F.col("unit"))).alias("stem"), "toxic", "harmless")
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("harmless").alias("harmless")),
        "stems",
    )
    sides = told.agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("harmless")).first()
    number = each.where("toxic > 0").count()
    by_chance = F.col("harmless") * F.lit(sides["toxic"] / max(1, sides["harmless"]))
    excess = (F.col("toxic") - by_chance) / F.sqrt(by_chance + 1)
    least = MARGIN + math.sqrt(2 * math.log(max(2, number)))
    found = each.where(F.col("toxic") >= TIMES * by_chance).select("stem", excess.alias("excess")).where(F.col("excess") >= least)
    return found.orderBy(F.desc("excess"), "stem").limit(MOST_STEMS)


def find_evidence(
    toxic: list[dict[bytes, float]], harmless: dict[bytes, float], clear: dict[str, float] | None = None
) -> tuple[list[bytes], list[bytes]]:
    """Units that toxic texts share, in their own form or a similar one, more than harmless ones do.

    ``toxic`` has of each text its units, each with the excess of its own form or
    of a stem it has (:func:`train_toxicity`), by which candidates are chosen;
    ``harmless`` has the share of harmless texts that hold a unit; ``clear`` has the
    excess of the stems of :func:`clear_stems`.

    Candidates are some units of every clear stem, then those with the largest
    excess. For each the toxic texts that hold something alike are counted, each
    by how alike it is, and compared with what as many harmless texts would hold.
    The clearest excess comes first; what is almost the same as a unit already
    taken is passed over. These are the landmarks, given first.

    Learnt as toxic are, given second, of each toxic text the candidates with the
    clearest excess in it, and all units with a stem as clear: a text is toxic by
    such units, so what merely looks a little like a landmark is no example where
    the text has better evidence.
    """
    clear = clear or {}
    own = {u: excess for mine in toxic for u, excess in mine.items()}
    often = Counter(u for mine in toxic for u in mine)
    stem_of = {u: max((clear.get(x, 0.0) for x in stems(u.decode("utf-8", "replace"))), default=0.0) for u in own} if clear else {}
    by_stem: dict[str, list[bytes]] = {}
    for u, most in stem_of.items():
        if most:
            for x in stems(u.decode("utf-8", "replace")) & clear.keys():
                by_stem.setdefault(x, []).append(u)
    suspects = sorted(own, key=lambda u: (-own[u], u))
    first = dict.fromkeys(
        u
        for x in sorted(by_stem, key=lambda x: (-clear[x], x))
        for u in sorted(by_stem[x], key=lambda u: (-often[u], u))[:STEM_UNITS]
    )
    most_probes = max(400, PAIRS // (len(suspects) + len(harmless)))
    probes = list(dict.fromkeys([*list(first)[: most_probes // 2], *suspects]))[:most_probes]
    kernel, rank = Landmarks(probes), {u: i for i, u in enumerate(suspects)}
    alike = _best_of(*kernel.values(suspects), len(suspects))
    alike[alike < ALIKE] = 0
    held = np.stack([alike[[rank[u] for u in mine]].max(axis=0) for mine in toxic if mine])
    calm = _best_of(*kernel.values(list(harmless)), len(harmless))
    calm[calm < ALIKE] = 0
    # Per harmless text, what is alike in sum: no less than its largest.
    doubt = np.array(list(harmless.values())) @ calm**2 * len(held)
    excess = ((held**2).sum(axis=0) - doubt) / np.sqrt(doubt + 1)
    least = MARGIN + np.sqrt(2 * np.log(len(probes)))
    among = alike[[rank[u] for u in probes]]
    told = np.array([max(e, stem_of.get(u, 0.0)) for u, e in zip(probes, excess.tolist(), strict=True)])
    chosen: list[int] = []
    for p in np.argsort(-told, kind="stable"):
        if len(chosen) == LANDMARKS or told[p] < least and chosen:
            break
        if not chosen or among[chosen, p].max() < 0.75:
            chosen.append(int(p))
    known = dict(zip(probes, told.tolist(), strict=True))
    learnt = set()
    for mine in toxic:
        worth = {u: max(known.get(u, 0.0), stem_of.get(u, 0.0)) for u in mine}
        most = max(worth.values(), default=0.0)
        learnt |= {u for u, x in worth.items() if x >= max(least, most / 2)}
    landmarks = [probes[i] for i in chosen]
    return landmarks, sorted(learnt) or landmarks


def disguised(unit: bytes) -> list[bytes]:
    """The unit with a character put in, at each of three places: to be learnt as well."""
    text = unit.decode("utf-8", "replace")
    if len(text) < 4:
        return []
    places = sorted({1, len(text) // 2, len(text) - 1})
    return [(text[:at] + "xqz"[i] + text[at:]).encode() for i, at in enumerate(places)]


class UnitMachine:
    """The SVM on units: landmarks, the Nystroem map, and training on given examples."""

    def __init__(self, landmarks: list[bytes]):
        self.kernel = Landmarks(landmarks)
        gram = _best_of(*self.kernel.values(landmarks), len(landmarks)).astype(float)
        size, axes = np.linalg.eigh((gram + gram.T) / 2)
        good = size > 1e-3 * size.max()
        self.whiten = axes[:, good] / np.sqrt(size[good])
        self.weights, self.bias = np.zeros(good.sum()), 0.0

    def map(self, strings: list[bytes]) -> np.ndarray:
        """Nystroem features of units of one window; of a longer one, of the window most like a landmark."""
        values, owner = self.kernel.values(strings)
        best = np.lexsort((-values.max(axis=1), owner))
        return values[best[np.searchsorted(owner, np.arange(len(strings)))]].astype(float) @ self.whiten

    def train(self, toxic: list[bytes], harmless: list[bytes]) -> None:
        toxic = toxic + [v for u in toxic for v in disguised(u)]
        x = np.concatenate([self.map(toxic), self.map(harmless)])
        side = np.concatenate([np.ones(len(toxic)), -np.ones(len(harmless))])
        weight = np.concatenate([np.full(len(toxic), 1 / len(toxic)), np.full(len(harmless), 2 / len(harmless))])
        self.weights, self.bias = _svm(x, side, weight)

    def model(self) -> ToxicModel:
        return ToxicModel(self.kernel.combined(self.whiten @ self.weights), self.bias, (1.0, 0.0, 0.0, 0.0))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn,
    target: str = "toxic",
    most_texts: int = MOST_TEXTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> ToxicModel | None:
    """Learn from labelled texts which units make a text toxic.

    ``learn`` (a function of the id column) says whose labels may be seen. Texts
    are a sample bounded by ``most_texts``; their units are counted in Spark,
    those longer than a window by their windows, so that what stands far inside
    a long unit is learnt from like any other, as harmless or as toxic.
    None if there is no toxic or no harmless text to learn from.
    """
    sample = stored(
        labelled_texts(docs, labels, target, learn(F.col("key")), most_texts, id_column, text_column)
        .withColumn("text_no", F.monotonically_increasing_id()),
        "sample",
    )
    told = stored(
        flat_map_texts(
            sample, ["label", "text_no"], F.col("text"), "unit binary",
            lambda: lambda texts: [[(u,) for u in seen_units(x)] for x in texts],
        ),
        "units",
    )
    calm = stored(told.where("label = 0").groupBy("unit").agg(F.count("*").alias("n")), "calm")
    told_of = calm.agg(F.count("*").alias("units")).first()["units"]
    n_calm = sample.where("label = 0").count()
    frequent = {bytes(r["unit"]): r["n"] / n_calm for r in calm.orderBy(F.desc("n"), "unit").limit(MOST_HARMLESS).collect()}
    others = {bytes(r["unit"]): r["n"] / n_calm for r in calm.orderBy(F.xxhash64("unit")).limit(MOST_HARMLESS).collect()}
    each = max(1.0, told_of / MOST_HARMLESS)
    harmless = {u: share * each for u, share in others.items()} | frequent
    n_toxic = sample.where("label = 1").count()
    # What harmless texts hold too counts by how much more of the toxic texts hold it.
    by_chance = F.coalesce(F.col("calm.n"), F.lit(0)) * F.lit(n_toxic / max(1, n_calm))
    suspects = told.where("label = 1")
    shared = (
        suspects.groupBy("unit").agg(F.count("*").alias("n")).alias("shared")
        .join(calm.alias("calm"), F.col("shared.unit") == F.col("calm.unit"), "left")
        .select("shared.unit", ((F.col("shared.n") - by_chance) / F.sqrt(by_chance + 1)).alias("excess"))
        .where("excess > 0")
    )
    # A rare form counts by the stem it shares with others.
    stemmed = clear_stems(told)
    clear = {r["stem"]: r["excess"] for r in stemmed.collect()}
    known_stems = told.sparkSession.createDataFrame(list(clear.items()), "stem string, excess double")
    by_stem = (
        suspects.select("unit").distinct()
        .select("unit", F.explode(_stems_of(F.col("unit").cast("string"))).alias("stem"))
        .join(F.broadcast(known_stems), "stem").groupBy("unit").agg(F.max("excess").alias("excess"))
    )
    shared = stored(shared.unionByName(by_stem).groupBy("unit").agg(F.max("excess").alias("excess")), "suspects")
    bags = (
        suspects.join(shared, "unit")
        .groupBy("text_no")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("excess", "unit")), False), 1, MOST_UNITS).alias("held"))
        .orderBy(F.xxhash64("text_no"))
        .limit(MOST_TOXIC_TEXTS)
    )
    toxic = [{bytes(u["unit"]): u["excess"] for u in r["held"]} for r in bags.collect()]
    if not harmless or not any(toxic):
        return None
    landmarks, known = find_evidence(toxic, harmless, clear)
    calm_landmarks = [u for u in frequent if len(u) > 2][:CALM_LANDMARKS]
    # A text that is labelled wrong makes no string harmless that was found to be toxic.
    evidence = {*known, *landmarks}
    calm_landmarks = [u for u in calm_landmarks if u not in evidence]
    machine, negatives = UnitMachine(landmarks + calm_landmarks), [u for u in harmless if u not in evidence] or list(harmless)
    for _ in range(ROUNDS):
        machine.train(known, negatives)
        hard = _told(calm, ["unit"], F.col("unit"), machine.model()).orderBy(F.desc("best"), "unit").limit(HARD + len(evidence))
        negatives = sorted(set(negatives) | ({bytes(r["unit"]) for r in hard.collect()} - evidence))
    machine.train(known, negatives)
    plain = machine.model()
    seen = _told(sample, ["label"], F.col("text"), plain).toPandas()
    share = np.log((seen["toxic_units"] + 0.1) / (seen["units"] + MORE_UNITS))
    calibration = _logistic(
        np.column_stack([seen["best"], np.log1p(seen["toxic_units"]), share]), (seen["label"] > 0).to_numpy(float)
    )
    return ToxicModel(plain.table, plain.bias, tuple(calibration.tolist()))


@lru_cache(maxsize=1)
def _scorer(key: int, table: bytes, bias: float, calibration: tuple) -> Scorer:
    return Scorer(ToxicModel(np.frombuffer(table, np.float32), bias, calibration))


def _told(docs: DataFrame, keep: list[str], text, model: ToxicModel) -> DataFrame:
    """``keep``, best margin, number of toxic units and of all units of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (hash(model.table.tobytes()), model.table.tobytes(), model.bias, model.calibration)
    )

    def start():
        scorer = _scorer(*shared.value)  # stays in the worker, with the units it has seen
        return lambda texts: [[row] for row in scorer.tell(texts)]

    return flat_map_texts(docs, keep, text, "best double, toxic_units long, units long", start)


def score_toxicity(
    docs: DataFrame, model: ToxicModel | None, keep: list[str], text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The columns ``keep`` with ``score`` (chance of label 1), ``predicted`` and ``toxic_units``.

    One narrow pass over whole texts; only the text counts. The kernel of a text
    with a landmark is that of its most telling unit: subsequences may have gaps,
    so an insult with characters put in or taken out still looks like itself,
    and one spaced out is joined first. Null counts as the empty text, which has
    no units and the score of the least suspect. Without a model every score is
    0. Repeated rows are scored alike; an empty table gives no rows.
    """
    if model is None:
        return docs.select(
            *keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("long").alias("toxic_units")
        )
    a, b, c, d = model.calibration
    share = F.log((F.col("toxic_units") + 0.1) / (F.col("units") + MORE_UNITS))
    at = F.lit(a) * F.col("best") + F.lit(b) * F.log1p("toxic_units") + F.lit(c) * share + F.lit(d)
    told = _told(docs, keep, F.col(text_column), model).withColumn("score", 1 / (1 + F.exp(-at)))
    return told.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "toxic_units")
