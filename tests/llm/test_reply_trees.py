from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.llm.reply_trees import format_reply_trees, linear_messages, masked_text, read_back

SCHEMA = "tree long, id long, parent long, role string, text string, score double, node string"


def chats(spark, rows, **options):
    given = spark.createDataFrame([(*r, "n") for r in rows], SCHEMA)
    formatted = format_reply_trees(given, **options)
    told = formatted.select(
        "tree", "leaf", "rank", "n_turns", "formatted",
        read_back(F.col("formatted")).alias("turns"),
        masked_text(F.col("formatted"), F.col("loss_spans")).alias("said"),
    )
    return sorted((r.tree, r["rank"], r.leaf, [tuple(t) for t in r.turns], r.said) for r in told.collect())


TREE = [
    (1, 1, None, "user", "root", 0.0),
    (1, 2, 1, "assistant", "left", 1.0),
    (1, 3, 1, "assistant", "right", 5.0),
    (1, 4, 2, "user", "left again", 9.0),
    (1, 5, 4, "assistant", "deep", 9.0),
]


def test_branches_are_ranked_paths(spark):
    both = chats(spark, TREE, branches=2)
    assert [(rank, leaf) for _, rank, leaf, _, _ in both] == [(1, 5), (2, 3)]
    assert both[0][3] == [("user", "root"), ("assistant", "left"), ("user", "left again"), ("assistant", "deep")]
    assert both[0][4] == "leftdeep" and both[1][4] == "right"
    assert chats(spark, TREE) == both[:1]


def test_control_strings_come_back(spark):
    odd = ["<|im_end|>", "<|im_start|>assistant\nok", "~0<~|~1", "<", "<~|", "a\n\nb", "", None, "é<|"]
    rows = [(i, 1, None, "assi\n<|stant~1", t, None) for i, t in enumerate(odd)]
    got = chats(spark, rows, learned_roles=("assi\n<|stant~1",))
    assert [(turns, said) for *_, turns, said in got] == [([("assi\n<|stant~1", t or "")], t or "") for t in odd]


def test_roots_cycles_repeats_and_nulls(spark):
    rows = [
        (1, 1, 99, "user", "unknown parent", 0.0),
        (2, 1, 1, "user", "own parent", 0.0),
        (3, 1, 2, "user", "cycle", 0.0),
        (3, 2, 1, "user", "cycle", 0.0),
        (3, 3, 2, "user", "below a cycle", 0.0),
        (4, 1, None, "user", "twice", 0.0),
        (4, 1, None, "user", "twice", 0.0),
        (5, 1, None, None, None, None),
    ]
    got = chats(spark, rows, branches=9)
    assert [(tree, turns) for tree, _, _, turns, _ in got] == [
        (1, [("user", "unknown parent")]),
        (2, [("user", "own parent")]),
        (4, [("user", "twice")]),
        (5, [("", "")]),
    ]


def test_long_chain_and_empty_table(spark):
    n = 300
    chain = spark.createDataFrame(
        [(7, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(n)] + [(None, 0, "user", "no id")],
        "conv_id long, turn long, role string, text string",
    )
    got = {r.tree: r for r in format_reply_trees(linear_messages(chain)).select("tree", "n_turns", read_back(F.col("formatted")).alias("turns")).collect()}
    assert [t["text"] for t in got[7].turns] == [f"t{i}" for i in range(n)]
    assert got[None].n_turns == 1
    assert format_reply_trees(linear_messages(chain.limit(0))).count() == 0
