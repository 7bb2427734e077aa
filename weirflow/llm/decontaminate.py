"""Benchmark decontamination: a hash set of test n-grams against every window of every text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_set, bits_for, has_bit, identity, own, remaining, stored, unused, words_of

WINDOW_WORDS = 10
#: The n-grams are broadcast up to so many bytes of text and item ids; beyond that
#: they are joined by shuffle, which Spark splits where one n-gram is hot.
BROADCAST_BYTES = 64_000_000
#: The hash set has at least so many bits per n-gram, and at most 2**26 (8 MB).
BITS_PER_GRAM, MOST_BITS = 64, 1 << 26


def benchmark_grams(
    items: DataFrame, window: int = WINDOW_WORDS, id_column: str = "item_id", text_column: str = "text"
) -> DataFrame:
    """The distinct windows of all items: ``gram``, its number of words ``k``, its ``items``.

    An item of fewer words than a window is one window; one without words is none.
    """
    words = items.select(
        F.col(id_column).cast("string").alias("item"), words_of(F.col(text_column)).alias("words")
    ).where(F.size("words") > 0)
    k = F.least(F.size("words"), F.lit(window))
    grams = words.select(
        "item",
        k.alias("k"),
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - k + 1),
                lambda i: F.array_join(F.slice("words", i, k), " "),
            )
        ).alias("gram"),
    )
    return grams.groupBy("gram", "k").agg(F.collect_set("item").alias("items"))


def _with_window_hashes(rows: DataFrame, ks: list[int]) -> DataFrame:
    """The rows with an array column ``h<k>`` for each size ``k``: at i the hash of words i to i + k - 1.

    A word is hashed once. Two windows side by side make one of their lengths
    together, so windows of 2, 4 and 8 words take a step each, and any other size
    is put together from those. The last k - 1 values of ``h<k>`` are of no window.
    """
    rows = rows.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))

    def joined(left: int, right: int):
        after = F.slice(F.col(f"h{right}"), left + 1, F.greatest(F.size("words"), F.lit(1)))
        return F.zip_with(f"h{left}", after, lambda x, y: F.xxhash64(x, y))

    done = {1}
    for k in ks:
        sizes = [1 << i for i in range(k.bit_length()) if k >> i & 1][::-1]
        size = 1
        while size < sizes[0]:
            if 2 * size not in done:
                rows = rows.withColumn(f"h{2 * size}", joined(size, size))
                done.add(2 * size)
            size *= 2
        for part in sizes[1:]:
            if size + part not in done:
                rows = rows.withColumn(f"h{size + part}", joined(size, part))
                done.add(size + part)
            size += part
    return rows


def _places(k: int, bits: Column, size: int) -> Column:
    """Windows of ``k`` words whose hash is in the set, each with its text."""
    last = F.size("words") - k
    met = F.transform(f"h{k}", lambda h, i: F.when((i <= last) & has_bit(bits, h, size), i + 1))
    return F.transform(
        F.array_compact(met),
        lambda i: F.struct(
            i.alias("start"), F.lit(k).alias("k"), F.array_join(F.slice("words", i, F.lit(k)), " ").alias("gram")
        ),
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row of ``docs``: ``row``, id, ``n_words``, ``spans``, ``n_hit``, ``items``.

    One scan makes the words of each text, hashes each once, puts the hashes of
    windows together from those, and looks every window up in a set of bits; the few that are found go on with their text and are verified by a
    join with the n-grams themselves. ``spans`` are the merged word ranges
    ``(start, stop)``, words counted from 0, that lie in any occurrence; ``n_hit``
    is their total length; ``items`` are the ids of items with occurrences, as
    sorted strings. No text is shuffled: what moves are candidate windows.

    A null or empty text has no words. Without items, or where items have no
    words, nothing is hit. Repeated rows are judged each for itself; repeated
    items are one. Clashing names of other columns do no harm.
    """
    grams = stored(benchmark_grams(items, window, item_id_column), "grams")
    width = F.octet_length("gram") + F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x))
    kinds = sorted(grams.groupBy("k").agg(F.count("*").alias("n"), F.sum(width.cast("long")).alias("bytes")).collect())
    ks = [r["k"] for r in kinds]
    base = docs.select(F.col(id_column).alias("id"), words_of(F.col(text_column)).alias("words"))
    size = bits_for(sum(r["n"] for r in kinds), BITS_PER_GRAM, MOST_BITS)
    split = _with_window_hashes(grams.select("k", F.split("gram", " ").alias("words")), ks)
    whole = [F.when(F.col("k") == k, F.get(f"h{k}", F.lit(0))) for k in ks]
    bits = bit_set(split.select(F.coalesce(*whole).alias("h")), size) if ks else None
    places = [_places(k, F.col("bits"), size) for k in ks]
    nothing = F.array().cast("array<struct<start:int,k:int,gram:string>>")
    scanned = stored(
        (_with_window_hashes(base, ks).withColumn("bits", bits) if ks else base).select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.size("words").cast("long").alias("n_words"),
            (F.concat(*places) if places else nothing).alias("places"),
        ),
        "scanned",
    )

    known = grams.select("gram", "items")
    if sum(r["bytes"] for r in kinds) <= broadcast_bytes:
        known = F.broadcast(known)
    hits = (
        scanned.select("row", F.explode("places").alias("place"))
        .select("row", "place.start", "place.k", "place.gram")
        .join(known, "gram")
        .groupBy("row")
        .agg(
            F.collect_list(F.struct((F.col("start") - 1).alias("start"), (F.col("start") - 1 + F.col("k")).alias("stop"))).alias("found"),
            F.collect_set("items").alias("items"),
        )
    )
    merged = F.aggregate(
        F.array_sort("found"),
        F.array().cast("array<struct<start:int,stop:int>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["start"].alias("start"),
                        F.greatest(F.get(done, F.size(done) - 1)["stop"], x["stop"]).alias("stop"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    judged = hits.select("row", merged.alias("spans"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
    joined = scanned.drop("places").join(judged, "row", "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>"))
    return joined.select(
        "row",
        F.col("id").alias(id_column),
        "n_words",
        spans.alias("spans"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"]).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    remove: str = "documents",
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without contaminated documents, or without the spans hit (``remove="spans"``).

    A span goes with the separators that follow its words; the rest of the text
    stays as it was. Columns and clean rows are unchanged; a null text stays null.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    name, hit = unused(docs, "row_identity", "spans_hit")
    told = docs.select(identity(id_column, text_column).alias("doc"), F.col(text_column).alias("text"))
    found = contamination(told, items, id_column="doc", **options)
    if remove == "documents":
        decided = found.select(F.col("doc").alias("row"), (F.col("n_hit") == 0).alias("kept"))
        return remaining(docs, decided, id_column, text_column)
    spans = stored(found.where("n_hit > 0").groupBy(F.col("doc").alias(name)).agg(F.first("spans").alias(hit)), "spans")
    joined = docs.withColumn(name, identity(id_column, text_column)).join(spans, name, "left")
    text = F.col(text_column)
    # Separators stand at 0..n, words at 0..n-1 between them, in the text's own case.
    between = F.split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1)
    words = F.regexp_extract_all(text, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    left = F.transform(
        words,
        lambda w, i: F.when(
            F.exists(F.col(hit), lambda s: (s["start"] <= i) & (i < s["stop"])), F.lit("")
        ).otherwise(F.concat(w, F.get(between, i + 1))),
    )
    cut = F.concat(F.get(between, F.lit(0)), F.array_join(left, ""))
    return joined.withColumn(text_column, F.when(F.col(hit).isNull(), text).otherwise(cut)).select(*own(docs))
