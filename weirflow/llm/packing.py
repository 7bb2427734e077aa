"""Best-fit packing by bin completion over the histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import flat_map_texts, stored
from .tokens import WordCache

CAPACITY = 4096
END_ID = 1
#: Bound of the search, in fillings tried: per sequence, and for the last sequences together.
FILLING_NODES, SEARCH_NODES = 2_000, 20_000
#: So many of the last sequences are searched anew when the first dive leaves any waste to gain.
LAST_BINS = 64
#: Pieces of one length are numbered in groups of about so many, up to MOST_GROUPS groups.
GROUP_ROWS, MOST_GROUPS = 500, 4096
#: Whole texts come to Python in batches of at most so many: executors hold whole batches.
BATCH_ROWS = 2_000

#: A way to fill a sequence: (length, copies), largest first.
Filling = tuple[tuple[int, int], ...]


class Stock:
    """How many pieces of each length are left, with the lengths at hand as bits of a number."""

    def __init__(self, counts: dict[int, int]):
        self.left = {length: n for length, n in counts.items() if n > 0}
        self.at_hand = sum(1 << length for length in self.left)
        self.total = sum(length * n for length, n in self.left.items())

    def largest(self, most: int) -> int:
        """The largest length at hand up to ``most``; 0 if there is none."""
        return (self.at_hand & ((2 << most) - 1)).bit_length() - 1 if most > 0 and self.at_hand & ((2 << most) - 1) else 0

    def take(self, filling: Filling, times: int = 1) -> None:
        for length, copies in filling:
            before = self.left.get(length, 0)
            self.left[length] = after = before - copies * times
            self.total -= length * copies * times
            if (before > 0) != (after > 0):
                self.at_hand ^= 1 << length

    def times(self, filling: Filling) -> int:
        return min(self.left[length] // copies for length, copies in filling)


def _counted(lengths: list[int]) -> Filling:
    return tuple((length, lengths.count(length)) for length in sorted(set(lengths), reverse=True))


def fillings(stock: Stock, capacity: int, nodes: int) -> Iterator[tuple[int, Filling]]:
    """Undominated fillings around the largest piece as (waste, filling), each better than the last.

    Fillings are built largest first, so the first one is best fit: the largest
    piece that fits, again and again. It is the incumbent; branches replace one
    piece by a smaller one. A branch is pruned when what it could still hold
    leaves no less waste than the incumbent. What can be enlarged by a piece at
    hand is dominated and is not given.
    """
    first = stock.largest(capacity)
    best = capacity + 1
    chosen = [first]
    room = [capacity - first]
    limit = [first]
    held = {first: 1}
    while nodes > 0:
        # Go down: the largest piece that fits, up to the limit set by the branch.
        while True:
            most = min(room[-1], limit[-1])
            length = stock.largest(most)
            while length and stock.left[length] <= held.get(length, 0):
                length = stock.largest(length - 1)
            if not length:
                break
            nodes -= 1
            chosen.append(length)
            held[length] = held.get(length, 0) + 1
            room.append(room[-1] - length)
            limit.append(length)
        if room[-1] < best:
            best = room[-1]
            yield best, _counted(chosen)
            if best == 0:
                return
        # Go back to the last piece that a smaller one could replace with gain.
        while len(chosen) > 1:
            length = chosen.pop()
            held[length] -= 1
            room.pop()
            limit.pop()
            smaller = stock.largest(length - 1)
            # Smaller pieces only, as many as there are: more than that cannot fill the room.
            if smaller and _reach(stock, held, smaller, room[-1]) > room[-1] - best:
                limit[-1] = length - 1
                break
        else:
            return


def _reach(stock: Stock, held: dict[int, int], most: int, room: int) -> int:
    """An upper bound of what pieces of up to ``most`` can fill of ``room``, told by the largest few."""
    total, length = 0, most
    for _ in range(4):
        if not length or total >= room:
            break
        total += length * max(0, stock.left[length] - held.get(length, 0))
        length = stock.largest(length - 1)
    return min(room, total) if not length or total >= room else room


def plan_bins(
    counts: dict[int, int],
    capacity: int = CAPACITY,
    filling_nodes: int = FILLING_NODES,
    search_nodes: int = SEARCH_NODES,
) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used, so that all pieces are placed in few sequences.

    The first dive takes the best filling found around the largest piece as often
    as the stock allows; that ends after a few fillings per distinct length,
    whatever the counts. If it needs more than the lower bound ``ceil(total /
    capacity)``, the last sequences are searched by branch and bound: every
    undominated filling around the largest piece is a branch, pruned when the
    waste so far leaves no better result than the incumbent.
    """
    if any(not 0 < length <= capacity for length, n in counts.items() if n > 0):
        raise ValueError(f"lengths must lie from 1 to {capacity}")
    stock, plan = Stock(counts), []
    bound = -(-stock.total // capacity)
    while stock.total:
        *_, (_, filling) = fillings(stock, capacity, filling_nodes)
        times = stock.times(filling)
        stock.take(filling, times)
        plan.append((filling, times))
    if sum(times for _, times in plan) > bound:
        tail, kept = [], LAST_BINS
        while plan and kept > 0:
            filling, times = plan.pop()
            used = min(times, kept)
            tail += [filling] * used
            kept -= used
            if times > used:
                plan.append((filling, times - used))
        plan += [(filling, 1) for filling in _search(tail, capacity, filling_nodes, search_nodes)]
    return plan


def _search(incumbent: list[Filling], capacity: int, filling_nodes: int, nodes: int) -> list[Filling]:
    """Fewer sequences for the pieces of ``incumbent``, if the search finds them in time."""
    stock = Stock({})
    for filling in incumbent:
        stock.take(filling, -1)
    total, best = stock.total, incumbent
    bound = -(-total // capacity)

    def branches(waste: int) -> Iterator[tuple[int, Filling]]:
        found = _all_fillings(stock, capacity, (len(best) - 1) * capacity - total - waste, filling_nodes)
        return iter(sorted(found, key=lambda f: f[0]))

    stack = [(0, branches(0))]
    done: list[Filling] = []
    while stack and nodes > 0 and len(best) > bound:
        waste, ways = stack[-1]
        more, filling = next(ways, (0, None))
        if filling is None or waste + more > (len(best) - 1) * capacity - total:
            stack.pop()
            if done:
                stock.take(done.pop(), -1)
            continue
        nodes -= 1
        stock.take(filling)
        done.append(filling)
        if not stock.total:
            best = list(done)
            stock.take(done.pop(), -1)
            continue
        stack.append((waste + more, branches(waste + more)))
    return best


def _all_fillings(stock: Stock, capacity: int, most_waste: int, nodes: int) -> list[tuple[int, Filling]]:
    """Undominated fillings around the largest piece that waste no more than ``most_waste``.

    All copies of a length are chosen in one step, most first, and the steps
    taken are a list: how many pieces a sequence holds does not matter.
    """
    found: list[tuple[int, Filling]] = []
    held: dict[int, int] = {}
    room = capacity

    def copies_of(length: int, room: int) -> Iterator[tuple[int, int]]:
        return ((length, n) for n in range(min(stock.left[length], room // length), 0, -1))

    def smaller(most: int, room: int) -> Iterator[tuple[int, int]]:
        while length := stock.largest(min(most, room)):
            yield from copies_of(length, room)
            most = length - 1

    ways = [copies_of(stock.largest(capacity), capacity)]
    while ways:
        length, copies = next(ways[-1], (0, 0)) if nodes > 0 else (0, 0)
        if length:
            nodes -= 1
            held[length] = copies
            room -= length * copies
            # Maximal: no piece at hand, of any size, fits in what is left.
            free = stock.largest(room)
            while free and stock.left[free] <= held.get(free, 0):
                free = stock.largest(free - 1)
            if free:
                ways.append(smaller(length - 1, room))
                continue
            if room <= most_waste:
                found.append((room, tuple(held.items())))
        else:
            ways.pop()
        if held:
            length, copies = held.popitem()
            room += length * copies
    return found


def layout(plan: list[tuple[Filling, int]]) -> dict[str, np.ndarray]:
    """Where the n-th piece of a length goes, as sorted runs of numbers.

    A run starts at number ``lo`` of its ``length``; in it, ``copies`` pieces
    stand side by side from ``offset`` on in each sequence from ``first`` on.
    There is one run per filling and length, so the layout is bounded by the
    capacity, not by the number of pieces.
    """
    placed: dict[int, int] = {}
    runs, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for length, copies in filling:
            lo = placed.get(length, 0)
            runs.append((length, lo, sequence, copies, offset))
            placed[length] = lo + copies * times
            offset += copies * length
        sequence += times
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "lo", "first", "copies", "offset"), columns, strict=True))


def pieces_of(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Each text's ids and the end id, cut into pieces of ``capacity`` where longer.

    Returns the id, ``piece``, ``start``, ``length``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit numbers) and, with ``with_ids``, ``ids``.
    """
    end = int(end_id).to_bytes(4, "little")

    def start():
        cache = WordCache(tokenizer_path)  # goes with the task

        def cut(data: bytes) -> list[tuple]:
            rows = []
            for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at : at + 4 * capacity]
                row = (piece, at // 4, len(part) // 4, zlib.crc32(part))
                rows.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if with_ids else row)
            return rows

        return lambda texts: [cut(ids + end) for ids in cache.ids(texts)]

    fields = "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return flat_map_texts(docs, [id_column], F.col(text_column), fields, start)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_column: str = "doc_id", **options) -> DataFrame:
    """All pieces of ``docs`` with the sequence each goes to and its place there.

    Returns the columns of :func:`pieces_of`, ``sequence_id`` and ``offset``.
    Pieces are made in one pass and stored. Only their histogram, at most
    ``capacity`` counts, comes to the driver, which plans the fillings; the
    plan's runs, bounded likewise, are broadcast. Each piece then needs its
    number among those of its length: pieces of a length are split by hash into
    groups, numbered within a group, and the groups' counts are summed up, so
    that no length, however common, is sorted in one task.

    Null counts as the empty text, which is one piece of the end id. Pieces are
    never longer than ``capacity``; only longer texts are cut, and only their
    last piece may be shorter. Repeated rows are packed as often as they stand.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = stored(pieces_of(docs, tokenizer_path, capacity, id_column=id_column, **options), "pieces", BATCH_ROWS)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = layout(plan_bins(counts, capacity))
    groups = min(MOST_GROUPS, -(-max(counts.values(), default=1) // GROUP_ROWS))

    same = [F.coalesce(F.col(id_column).cast("string"), F.lit("")), "piece", "ids_crc32"]
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64(*same), F.lit(groups)))
    by_length = Window.partitionBy("length").orderBy("group")
    starts = (
        grouped.groupBy("length", "group")
        .agg(F.count("*").alias("n"))
        .select("length", "group", (F.sum("n").over(by_length) - F.col("n")).alias("before"))
    )
    within = F.row_number().over(Window.partitionBy("length", "group").orderBy(*same))
    numbered = (
        grouped.withColumn("at", within - 1)
        .join(starts, ["length", "group"])
        .select(*pieces.columns, (F.col("before") + F.col("at")).alias("number"))
    )
    return _placed(numbered, spark.sparkContext.broadcast(runs), capacity)


def _placed(numbered: DataFrame, runs, capacity: int) -> DataFrame:
    kept = [c for c in numbered.columns if c != "number"]
    schema = numbered.select(*kept).schema.add("sequence_id", "long").add("offset", "long")
    one = 1 << 44  # more than any number of pieces of one length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = runs.value
        keys = at["length"] * one + at["lo"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("number").to_numpy(zero_copy_only=False)
            run = np.searchsorted(keys, length * one + number, "right") - 1
            turn, slot = np.divmod(number - at["lo"][run], at["copies"][run])
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(at["first"][run] + turn), pa.array(at["offset"][run] + slot * length)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return numbered.mapInArrow(place, schema)
