"""Chat formatting of reply trees: root-to-leaf paths, ranked, each one conversation."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

START, END = "<|im_start|>", "<|im_end|>"
#: Roles whose text a model is trained on.
LEARNED_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    """A text in which no control string can stand: ``<|`` becomes ``<~|``, ``~`` becomes ``~0``."""
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("<~|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<~|"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("~1"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("~1"), F.lit("\n")))


def _paths(nodes: DataFrame) -> DataFrame:
    """(leaf, node, up) for every node on the way from a leaf to its root, ``up`` steps above it.

    The self-joins double the reach each time: with jumps of 2**i steps known
    for every node that has such an ancestor, they extend the ways found so far
    and then are joined with themselves. Rows are numbers only, and as many as
    the paths have nodes. Leaves whose way enters a cycle are left out.
    """
    jumps = nodes.where("above IS NOT NULL").select("node", "above")
    jumps = stored(jumps, "jumps")
    parents = jumps.select(F.col("above").alias("node")).distinct()
    ways = stored(
        nodes.join(parents, "node", "left_anti").select(
            F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")
        ),
        "ways",
    )
    # A path without a cycle is no longer than its tree has nodes.
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    step = 1
    for _ in range(ceil(log2(most)) + 1):
        if jumps.isEmpty():
            return ways
        further = ways.join(jumps, "node").select(
            "leaf", F.col("above").alias("node"), (F.col("up") + step).alias("up")
        )
        ways = stored(ways.unionByName(further), "ways")
        again = jumps.select(F.col("node").alias("from"), F.col("above").alias("node"))
        jumps = stored(again.join(jumps, "node").select(F.col("from").alias("node"), "above"), "jumps")
        step *= 2
    # Whoever can still jump is on a cycle or below one.
    return ways.join(jumps.select(F.col("node").alias("leaf")), "leaf", "left_anti")


def format_reply_trees(messages: DataFrame, branches: int = 1, learned_roles=LEARNED_ROLES) -> DataFrame:
    """The best branches of every tree, each formatted as one conversation.

    ``messages`` has ``tree``, ``id``, ``parent`` (the id of the message that is
    answered, null for a root), ``role``, ``text`` and ``score``. A branch is a
    way from a root to a leaf; branches of a tree rank by the mean score of
    their messages, higher first, then by length, then by the leaf's id, and
    the first ``branches`` are kept.

    Returns ``tree``, ``leaf``, ``rank``, ``score``, ``n_turns``, ``formatted``
    and ``loss_spans``, an array of ``(start, length)`` in characters of
    ``formatted`` that cover the escaped texts of ``learned_roles``. A turn is
    ``<|im_start|>role``, a new line, the text, ``<|im_end|>`` and a new line;
    control strings in roles and texts are escaped so that
    :func:`read_back` returns them exactly.

    Null roles and texts count as empty, a null score as 0, a null tree as a
    tree of its own. A parent that is null, unknown or the message itself makes
    a root. Of rows with one tree and id the first by parent, role and text
    stays. Messages below a cycle are in no branch. An empty table gives no rows.
    """
    same = F.row_number().over(
        Window.partitionBy("tree", "id").orderBy("parent", "role", "text", F.col("score").desc())
    )
    given = stored(
        messages.select(
            "tree",
            "id",
            "parent",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        )
        .withColumn("same", same)
        .where("same = 1")
        .drop("same")
        .withColumn("node", F.monotonically_increasing_id()),
        "messages",
    )
    ids = given.select(
        F.col("tree").alias("tree_"), F.col("id").alias("id_"), F.col("node").alias("above")
    )
    nodes = stored(
        given.select("tree", "id", "parent", "node", "score").join(
            ids,
            F.col("tree").eqNullSafe(F.col("tree_")) & (F.col("parent") == F.col("id_"))
            & (F.col("node") != F.col("above")),
            "left",
        ).select("tree", "id", "node", "above", "score"),
        "nodes",
    )
    ways = _paths(nodes)

    scored = (
        ways.join(nodes.select("node", "score"), "node")
        .groupBy("leaf")
        .agg(F.avg("score").alias("score"), F.count("*").alias("n_turns"))
        .join(nodes.select(F.col("node").alias("leaf"), "tree", "id"), "leaf")
    )
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("n_turns").desc(), "id")
    chosen = stored(scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches), "chosen")

    learned = F.col("role").isin(*learned_roles)
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turns = (
        ways.join(chosen.select("leaf"), "leaf", "left_semi")
        .join(given.select("node", head.alias("head"), body.alias("body"), learned.alias("learned")), "node")
        .groupBy("leaf")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "head", "body", "learned"))).alias("turns"))
    )
    tail = F.lit(END + "\n")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def walk(state, turn):
        begins = state["at"] + F.char_length(turn["head"])
        length = F.char_length(turn["body"]).cast("long")
        span = F.array(F.struct(begins.alias("start"), length.alias("length")))
        return F.struct(
            (begins + length + F.lit(len(END) + 1)).alias("at"),
            F.when(turn["learned"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    written = turns.select(
        "leaf",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], tail)), "").alias("formatted"),
        F.aggregate("turns", start, walk)["spans"].alias("loss_spans"),
    )
    return written.join(chosen, "leaf").select(
        "tree", F.col("id").alias("leaf"), "rank", "score", "n_turns", "formatted", "loss_spans"
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of ``(role, text)``."""
    parts = F.split(formatted, r"<\|im_start\|>")
    turns = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    end = len(END) + 1

    def turn(part):
        role = F.substring_index(part, "\n", 1)
        begins = F.char_length(role) + 2
        text = F.substring(part, begins, F.char_length(part) - end - F.char_length(role) - 1)
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one span after the other."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
        ),
        "",
    )


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Conversations given as numbered turns, as trees of one branch each.

    Rows stand by turn, equal turns by role and text; each answers the one before.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.col("conv_id").alias("tree"), F.row_number().over(order).alias("id"), "role", "text"
    ).select(
        "tree",
        "id",
        F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )
