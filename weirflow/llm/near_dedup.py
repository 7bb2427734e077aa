"""Near-duplicate classes: MinHash, banding, verification on whole texts, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_set, flat_map_texts, has_bit, identity, remaining, stored
from .components import components
from .prob_minhash import BANDS, REGISTERS, band_keys, digest, shingles, signatures, similarity

SIMILARITY = 0.8
#: Similarities are sums of fractions; four fifths may come out a rounding error short.
ROUNDING = 1e-9
#: A pair is verified if so many registers agree. Far below what pairs of the
#: wanted similarity have: with 163 registers, 0.8 has a standard deviation of 0.03.
LEAST_AGREEMENT = 0.6
#: Texts of a bucket on either side of one piece of work.
BLOCK = 1024
#: Shingles of a text that are kept as its sketch, with their counts: two sketches tell
#: the similarity exactly unless one is cut off, and then to about 0.02.
SKETCH, SKETCH_ERROR = 512, 0.08
#: The set of texts to fetch for verification: bits per text, and at most so many (16 MB).
BITS_PER_TEXT, MOST_BITS = 32, 1 << 27


def _signed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Every row's id and text key, with bands and digest of its signature."""

    def start():
        def sign(texts: list[bytes | None]) -> list[list[tuple]]:
            sets = [shingles(x) for x in texts]
            matrix = signatures(sets)
            keys, digests = band_keys(matrix), digest(matrix)
            return [[(keys[i].tolist() if len(s) else [], digests[i].tobytes())] for i, (s, _) in enumerate(sets)]

        return sign

    keyed = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return flat_map_texts(keyed.withColumn("key", _key()), ["id", "key"], F.col("text"), "bands array<long>, digest binary", start)


def sketch(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """The SKETCH smallest shingles of a text by the upper halves of their hashes, and their counts.

    Chosen by hash, they are a fair sample of the shingles of any two texts that
    are compared, up to the smaller of their last hashes; the similarity of the
    samples is then that of the texts, for its sums grow alike on both sides.
    """
    upper, first = np.unique((hashes >> np.uint64(32)).astype("<u4"), return_index=True)
    if not len(upper):
        return b""
    summed = np.add.reduceat(counts, first)
    return upper[:SKETCH].tobytes() + np.minimum(summed[:SKETCH], 0xFFFFFFFF).astype("<u4").tobytes()


def _key():
    """Names a text by its content, wherever and however often it is read."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, center) for every member of a bucket that holds several texts.

    The center is the member that meets most others, counted over all its
    buckets: of a group of edited copies that is the one edited least, to which
    the others are most similar, and it is the same one in most of their buckets.
    """
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = stored(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    shared = stored(members.join(sizes, "bucket"), "shared")
    met = stored(shared.groupBy("node").agg(F.sum("n").alias("met")), "met")
    centers = stored(
        shared.drop("n").join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", "node")).alias("top")).select("bucket", F.col("top.node").alias("center")),
        "centers",
    )
    return stored(shared.select("bucket", "node").join(centers, "bucket"), "buckets")


def _stars(buckets: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket of several texts with the bucket's center."""
    return buckets.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()


def _rest(buckets: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame, text_column: str) -> DataFrame:
    """(a, b): pairs that share a bucket, lie in different components, and look alike.

    In most buckets all members are linked by then. In each other one, all
    members outside its largest component are compared with all members, block by
    block, in two steps. First by the digests of their signatures, each pair in
    the first bucket it shares; only the members that take part in a like pair are
    handed on. Those then meet in the same blocks again with their sketches, and
    only similar pairs leave the task, of those that join the same two components
    one. A component of any size costs one row per member and block of strangers.
    """
    members = stored(
        buckets.select("node", "bucket").join(labels, "node", "left").select(
            "node", "bucket", F.coalesce("label", "node").alias("label")
        ),
        "members",
    )
    parts = members.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = stored(
        parts.groupBy("bucket")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most"))
        .where("n > most.n")
        .select(
            "bucket",
            F.col("most.label").alias("major"),
            F.ceil(F.col("most.n") / BLOCK).alias("majors"),
            F.ceil((F.col("n") - F.col("most.n")) / BLOCK).alias("others"),
        ),
        "mixed",
    )
    # Ids only until it is known who takes part; then each gets its digest, and at last its sketch.
    taking_part = stored(members.join(mixed, "bucket"), "taking-part")
    marks = F.transform("bands", lambda b: b.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    digests = nodes.select("node", "digest", marks.alias("marks"))
    met = _worked(taking_part.join(digests, "node"), ["digest", "marks"], _alike_in_blocks, "bucket long, node long")
    met = stored(met.distinct(), "met")

    def start():
        return lambda texts: [[(sketch(*shingles(x)),)] for x in texts]

    wanted = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", "key", "digest")
    texts = _texts_of(wanted.select("key"), docs, text_column)
    sketches = flat_map_texts(texts, ["key"], F.col("text"), "sketch binary", start)
    told = wanted.join(sketches, "key").drop("key")
    again = taking_part.join(met, ["bucket", "node"], "left_semi").join(told, "node")
    return _worked(again, ["digest", "sketch"], _linked_in_blocks, "a long, b long").distinct()


def _worked(members: DataFrame, columns: list[str], work, schema: str) -> DataFrame:
    """What ``work`` finds in each piece of work that members of mixed buckets take part in."""
    keys = ["bucket", "block", "of", "against"]
    rows = (
        members.select("bucket", F.explode(_seats()).alias("seat"), "node", "label", *columns)
        .select("bucket", "seat.*", "node", "label", *columns)
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )
    return rows.mapInArrow(work, schema)


def _seats():
    """The pieces of work that a member of a mixed bucket takes part in.

    Strangers and members of the largest component are split into blocks. Each
    block of strangers (``block``) meets each block of the largest component
    (``of`` true, ``against`` its number; with number 0 also itself) and each
    later block of strangers (``of`` false). In a bucket of one block each that
    is one piece of work, which holds every member once.
    """
    stranger = F.col("label") != F.col("major")
    mine = F.pmod(F.xxhash64("node"), F.when(stranger, F.col("others")).otherwise(F.col("majors")))

    def seat(block, of: bool, against, probe: bool):
        return F.struct(block.alias("block"), F.lit(of).alias("of"), against.alias("against"), F.lit(probe).alias("probe"))

    def up_to(last):
        return F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0).cast("long"))), lambda i: i <= last)

    with_majors = F.transform(up_to(F.col("majors") - 1), lambda i: seat(mine, True, i, True))
    before = F.transform(up_to(mine - 1), lambda i: seat(i, False, mine, False))
    after = F.transform(F.filter(up_to(F.col("others") - 1), lambda i: i > mine), lambda i: seat(mine, False, i, True))
    majors = F.transform(up_to(F.col("others") - 1), lambda i: seat(i, True, mine, False))
    return F.when(stranger, F.concat(with_majors, before, after)).otherwise(majors)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Each piece of work with its rows, which follow each other over one or more batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = np.array([batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "block", "of", "against")], np.int64)
        starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(starts[:-1], starts[1:], strict=True):
            if start == stop:
                continue
            key = tuple(keys[:, start].tolist())
            if held and key != current:
                yield current, pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(start, stop - start))
            current = key
    if held:
        yield current, pa.Table.from_batches(held).combine_chunks()


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Members, Members]]:
    """Of each piece of work the bucket, the strangers, and whom they meet: with block 0 also each other."""
    for (bucket, _, of, against), rows in _pieces(batches):
        probe = rows.column("probe").to_numpy()
        everyone = rows if of and against == 0 else rows.filter(pa.array(~probe))
        if probe.any() and len(everyone):
            yield bucket, Members(rows.filter(pa.array(probe))), Members(everyone)


class Members:
    """Members of a bucket as arrays."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        self.node, self.label = (rows.column(c).to_numpy().astype(np.int64) for c in ("node", "label"))
        self.digest = np.frombuffer(b"".join(rows.column("digest").to_pylist()), "<u2").reshape(len(rows), REGISTERS)

    def like(self, near: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Those of the members at ``near`` whose digests are like the one given."""
        return near[(self.digest[near] == one).mean(axis=1) >= LEAST_AGREEMENT]


def _batch(found: list[tuple[int, int]], names: list[str], in_order: bool) -> pa.RecordBatch:
    ids = np.array(found, np.int64).reshape(-1, 2)
    ids = np.sort(ids, axis=1) if in_order else ids
    return pa.RecordBatch.from_arrays([pa.array(ids[:, 0]), pa.array(ids[:, 1])], names)


def _alike_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, node) of members with a like digest in another component, in the first bucket that both share."""
    for bucket, some, everyone in _sides(batches):
        mine, theirs = (m.rows.column("marks").combine_chunks().flatten().to_numpy().reshape(-1, BANDS) for m in (some, everyone))
        band = int(np.flatnonzero(mine[0] == bucket & 0x7FFFFFFF)[0])
        found: set[int] = set()
        for i in range(len(some.node)):
            near = np.flatnonzero((everyone.label != some.label[i]) & ~(theirs[:, :band] == mine[i, :band]).any(axis=1))
            like = everyone.node[everyone.like(near, some.digest[i])]
            if len(like):
                found |= {int(some.node[i]), *like.tolist()}
        if found:
            yield _batch([(bucket, node) for node in found], ["bucket", "node"], False)


def _linked_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): pairs of different components with like digests whose sketches are similar."""
    for _, some, everyone in _sides(batches):
        found = list(_linked(some, everyone))
        if found:
            yield _batch(found, ["a", "b"], True)


def _linked(some: Members, everyone: Members) -> Iterator[tuple[int, int]]:
    mine, theirs = ([_read(x) for x in m.rows.column("sketch").to_pylist()] for m in (some, everyone))
    place = {node: n for n, node in enumerate(everyone.node.tolist())}
    label = everyone.label.copy()
    for i in range(len(some.node)):
        at = place.get(int(some.node[i]))
        own = some.label[i] if at is None else label[at]
        for n in everyone.like(np.flatnonzero(label != own), some.digest[i]):
            if label[n] == own:
                continue
            one, two = mine[i], theirs[n]
            whole = len(one[0]) < SKETCH and len(two[0]) < SKETCH
            if not whole:
                reach = min(x[0][-1] for x in (one, two) if len(x[0]) == SKETCH)
                one, two = (tuple(part[: np.searchsorted(x[0], reach, "right")] for part in x) for x in (one, two))
            if similarity(one, two) >= (SIMILARITY - ROUNDING if whole else SIMILARITY - SKETCH_ERROR):
                yield int(everyone.node[n]), int(some.node[i])
                if whole:  # one link between two components is enough, if it is sure to hold
                    label[label == label[n]] = own


def _read(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(data, "<u4")
    return both[: len(both) // 2], both[len(both) // 2 :]


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs with their text keys, without those whose digests tell them apart."""
    told = nodes.select("node", "key", "digest")
    one = told.select(*(F.col(c).alias(f"{c}_a") for c in told.columns)).withColumnRenamed("node_a", "a")
    two = told.select(*(F.col(c).alias(f"{c}_b") for c in told.columns)).withColumnRenamed("node_b", "b")
    joined = pairs.join(one, "a").join(two, "b")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("digest_a", "digest_b")
            )
            kept = batch.filter(pa.array((one == two).mean(axis=1) >= LEAST_AGREEMENT))
            yield kept.select(["a", "b", "key_a", "key_b"])

    narrow = joined.select("a", "b", "key_a", "key_b", "digest_a", "digest_b")
    return narrow.mapInArrow(agree, "a long, b long, key_a binary, key_b binary")


def _keyed(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs with the keys of their texts."""
    keys = nodes.select("node", "key")
    return pairs.join(keys.toDF("a", "key_a"), "a").join(keys.toDF("b", "key_b"), "b").select("a", "b", "key_a", "key_b")


def _texts_of(keys: DataFrame, docs: DataFrame, text_column: str) -> DataFrame:
    """(key, text) of the texts that ``keys`` names, by one scan that lets hardly any other pass."""
    keys = stored(keys, "keys")
    bits, n = 1 << 16, keys.count()
    while bits < min(BITS_PER_TEXT * n, MOST_BITS):
        bits *= 2
    wanted = bit_set(keys.select(F.xxhash64("key").alias("h")), bits)
    found = (
        docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
        .withColumn("key", _key())
        .withColumn("wanted", wanted)
        .where(has_bit(F.col("wanted"), F.xxhash64("key"), bits))
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    return found.join(keys, "key", "left_semi")


def _verified(pairs: DataFrame, docs: DataFrame, text_column: str) -> DataFrame:
    """The pairs (a, b) whose whole texts share enough shingles, with their ``similarity``.

    The texts are fetched by one scan that passes only those a pair names; each
    of them then moves once, however many copies and pairs it has.
    """
    keys = pairs.select(F.col("key_a").alias("key")).unionByName(pairs.select(F.col("key_b").alias("key"))).distinct()
    texts = stored(_texts_of(keys, docs, text_column), "texts")
    both = pairs.join(texts.withColumnsRenamed({"key": "key_a", "text": "text_a"}), "key_a").join(
        texts.withColumnsRenamed({"key": "key_b", "text": "text_b"}), "key_b"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Pairs of one first text often follow each other.
        known = lru_cache(maxsize=16)(shingles)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("text_a", "text_b"))
            found = [similarity(known(x), known(y)) for x, y in zip(*columns, strict=True)]
            arrays = [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "similarity"])

    plain = both.select("a", "b", F.col("text_a").cast("binary").alias("text_a"), F.col("text_b").cast("binary").alias("text_b"))
    return plain.mapInArrow(verify, "a long, b long, similarity double").where(F.col("similarity") >= SIMILARITY - ROUNDING)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the class of near duplicates it belongs to.

    Returns the id, ``class_id``, ``class_size`` and ``kept``. A text is the set of
    its five-word shingles (words in lower case), of which each weighs 1 + ln(how
    often it stands). Texts are linked when the probability Jaccard similarity of
    these sets is 0.8 or more: the Jaccard similarity where shingles stand equally
    often on both sides, while passages repeated on one side only count against
    it. Classes are the connected components of links; ``class_id`` is the smallest
    id in the class, and one row with it stays.

    Equal texts are one node from the start. Candidates are nodes with an equal
    band of their ProbMinHash signatures, whose registers agree with just that
    similarity: with 40 bands of 4 registers a pair of 0.8 has no band in common
    with a chance below 1e-9, and agrees in less than LEAST_AGREEMENT of its
    registers with a chance below 2e-9. In each bucket members are first compared
    with one of them, which links a group of any size with a row per member; what
    then is still in different components is compared exhaustively, in blocks, by
    digests and then by sketches (:func:`_rest`), so a piece of work has at most
    2 * BLOCK rows. No bucket is cut, and no group is gathered in one task. Links are
    told by whole texts alone. Sketches are of texts of more than SKETCH shingles a
    sample, which rules out a pair of 0.8 with a chance of about 1e-5.

    A text of fewer than five words is one shingle; texts without words (null
    and empty ones too, null counting as empty) are alike only if they are equal.
    A null id counts as larger than any. Rows that are wholly the same are one
    class of which exactly one stays. An empty table gives no rows.
    """
    signed = stored(
        _signed(docs, id_column, text_column).withColumn("row", F.monotonically_increasing_id()), "signed"
    )
    nodes = stored(
        signed.groupBy("key")
        .agg(F.first("bands").alias("bands"), F.first("digest").alias("digest"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    buckets = _buckets(nodes)
    stars = stored(_alike(_stars(buckets), nodes), "stars")
    links = stored(_verified(stars, docs, text_column), "links")
    rest = _rest(buckets, nodes, components(links), docs, text_column).join(stars.select("a", "b"), ["a", "b"], "left_anti")
    rest = stored(_keyed(rest, nodes), "rest")
    more = stored(_verified(rest, docs, text_column), "links")
    labels = components(links.unionByName(more))

    classes = stored(
        nodes.select("node", "key").join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("label")),
        "classes",
    )
    labelled = stored(signed.select("row", "id", "key").join(classes, "key").select("row", "id", "label"), "labelled")
    heads = stored(
        labelled.groupBy("label").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("head"), F.count("*").alias("class_size")
        ),
        "heads",
    )
    return labelled.join(heads, "label").select(
        F.col("id").alias(id_column),
        F.col("head.id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("head.row")).alias("kept"),
    )


def near_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near duplicates, all columns as they were."""
    told = docs.select(
        F.struct(
            F.col(id_column).isNull().alias("none"),
            F.col(id_column).alias("id"),
            identity(id_column, text_column).alias("row"),
        ).alias("doc"),
        F.col(text_column).alias("text"),
    )
    decided = near_duplicates(told, "doc", "text").select(F.col("doc.row").alias("row"), "kept")
    return remaining(docs, decided, id_column, text_column)
