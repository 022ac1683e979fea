"""Chat formatting of reply trees, with DataFrame functions only.

A tree of messages becomes training conversations: every root-to-leaf path is a candidate, paths
are ranked by their score, and the best ``keep`` of each tree are formatted.

Paths come from iterative self-joins that double their reach: after round k each message knows its
ancestor 2^k steps up, so a thread of n messages takes log2(n) joins, and each join sends one row per
message.  The messages of a chosen path are then listed by going 1, 2, 4, ... steps up from its
leaf; rows are made for chosen paths only.  No join key is a tree, so one huge tree is spread over
all tasks; only the finished conversation, which is one row, meets in one task.

Template: ``### role: text</turn>`` and a line break per turn.  Within roles and texts a backslash and
the control strings are written as backslash and digit, so ``read_back`` restores them exactly.

Defined cases.  Null texts and roles are empty, null scores 0.  A message whose parent is null or not
in the table is a root.  Rows that are equal count once; of rows that share tree and id but differ, the
first in order of parent, role, text and score stays.  A message without an id is a reply that nobody
answers.  Messages in a cycle of parents hang on no root and are in no path.  Equal scores rank by
leaf id.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import same, stored

#: Backslash first, so that every backslash of an escaped text starts an escape.
ESCAPES = (("\\", "\\0"), ("</turn>", "\\1"), ("### ", "\\2"))
ROLE_ESCAPES = (*ESCAPES, (": ", "\\3"))
LOSS_ROLES = ("assistant",)


def escape(text: Column, table: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, written in table:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, table: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, written in reversed(table):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _messages(df: DataFrame, tree: str, msg_id: str, parent_id: str, role: str, text: str, score: str | None) -> DataFrame:
    rows = df.select(
        F.col(tree).alias("tree"),
        F.col(msg_id).cast("string").alias("id"),
        F.col(parent_id).cast("string").alias("parent"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(score).cast("double") if score else F.lit(None), F.lit(0.0)).alias("score"),
    )
    own = F.concat(F.lit("~"), F.sha2(F.to_json(F.struct("parent", "role", "text", "score")), 256))
    rows = rows.withColumn("id", F.coalesce("id", own))
    first = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    return rows.groupBy("tree", "id").agg(first).select("tree", "id", "m.*")


def _rootward(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables k = 0, 1, ...: the messages that have an ancestor ``up`` 2^k steps above, with the number ``steps`` and
    score ``total`` of the messages before it; and, for messages that hang on a root, both numbers up to the root.

    A message whose root is reached takes part in no further join on the left."""
    n, p = nodes.select("tree", "id", "parent", "score").alias("n"), nodes.select("tree", "id").alias("p")
    linked = n.join(p, same(F.col("n.tree"), F.col("p.tree")) & (F.col("n.parent") == F.col("p.id")), "left")
    table = stored(linked.select("n.tree", "n.id", F.col("p.id").alias("up"), F.lit(1).cast("long").alias("steps"), F.col("n.score").alias("total")))
    levels, done = [table.filter("up IS NOT NULL")], table.filter("up IS NULL")
    rounds = nodes.count().bit_length() + 1  # what is not done by then hangs on a cycle
    while len(levels) <= rounds and not levels[-1].isEmpty():
        s, a = levels[-1].alias("s"), levels[-1].unionByName(done).alias("a")
        joined = s.join(a, same(F.col("s.tree"), F.col("a.tree")) & (F.col("s.up") == F.col("a.id")))
        steps, total = F.col("s.steps") + F.col("a.steps"), F.col("s.total") + F.col("a.total")
        table = stored(joined.select("s.tree", "s.id", F.col("a.up").alias("up"), steps.alias("steps"), total.alias("total")))
        levels.append(table.filter("up IS NOT NULL"))
        done = done.unionByName(table.filter("up IS NULL"))
    return levels, done


def format_trees(
    df: DataFrame, tree: str = "tree_id", msg_id: str = "msg_id", parent_id: str = "parent_id", role: str = "role",
    text: str = "text", score: str | None = "score", keep: int = 1, loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """One row per chosen path: ``tree``, ``leaf``, ``rank`` (1 is the best mean score in its tree), ``mean_score``,
    ``n_turns``, ``formatted`` and ``loss_spans``, the code point ranges of the texts to learn from.
    """
    nodes = stored(_messages(df, tree, msg_id, parent_id, role, text, score))
    levels, ends = _rootward(nodes)
    parents = nodes.filter("parent IS NOT NULL").select(F.col("tree").alias("t"), F.col("parent").alias("p"))
    leaves = ends.join(parents, same(F.col("tree"), F.col("t")) & (F.col("id") == F.col("p")), "left_anti")
    scored = leaves.select("tree", F.col("id").alias("leaf"), (F.col("total") / F.col("steps")).alias("mean_score"))
    # a limit on a rank is applied before the shuffle too, so a tree of many leaves stays small
    order = Window.partitionBy("tree").orderBy(F.desc("mean_score"), "leaf")
    chosen = stored(scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep))
    on_path = chosen.select("tree", "leaf", F.col("leaf").alias("node"))
    for level in levels[:-1]:
        up = level.select(F.col("tree").alias("t"), F.col("id").alias("i"), "up")
        higher = on_path.join(up, same(F.col("tree"), F.col("t")) & (F.col("node") == F.col("i")))
        on_path = stored(on_path.unionByName(higher.select("tree", "leaf", F.col("up").alias("node"))))
    o, n, e = on_path.alias("o"), nodes.alias("n"), ends.alias("e")
    turns = (
        o.join(n, same(F.col("o.tree"), F.col("n.tree")) & (F.col("o.node") == F.col("n.id")))
        .join(e, same(F.col("o.tree"), F.col("e.tree")) & (F.col("o.node") == F.col("e.id")))
        .select("o.tree", "o.leaf", F.col("e.steps").alias("depth"), "n.role", "n.text")
    )
    turns = turns.select(
        "tree", "leaf", "depth", F.col("role").isin(*loss_roles).alias("learn"),
        F.concat(F.lit("### "), escape(F.col("role"), ROLE_ESCAPES), F.lit(": ")).alias("head"), escape(F.col("text")).alias("body"),
    ).withColumn("piece", F.concat("head", "body", F.lit("</turn>\n")))
    before = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head")
    turns = turns.withColumn("start", start).withColumn("end", F.col("start") + F.length("body"))
    rows = F.array_sort(F.collect_list(F.struct("depth", "learn", "start", "end", "piece")))
    formatted = turns.groupBy("tree", "leaf").agg(rows.alias("r"))
    learned = F.transform(F.filter("r", lambda x: x["learn"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    formatted = formatted.select(
        "tree", "leaf", F.size("r").cast("long").alias("n_turns"), F.array_join(F.transform("r", lambda x: x["piece"]), "").alias("formatted"),
        learned.alias("loss_spans"),
    )
    f, c = formatted.alias("f"), chosen.alias("c")
    return f.join(c, same(F.col("f.tree"), F.col("c.tree")) & (F.col("f.leaf") == F.col("c.leaf"))).select(
        "f.tree", "f.leaf", "c.rank", "c.mean_score", "f.n_turns", "f.formatted", "f.loss_spans"
    )


def format_threads(df: DataFrame, thread: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations, given as rows by turn, as trees without branches; equal turn numbers go by role and
    text, repeated rows are turns of their own."""
    w = Window.partitionBy("tree_id").orderBy("turn", "role", "text")
    rows = df.select(F.col(thread).alias("tree_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    rows = rows.withColumn("msg_id", F.row_number().over(w)).withColumn("parent_id", F.nullif(F.col("msg_id") - 1, F.lit(0)))
    return format_trees(rows, score=None).withColumnRenamed("tree", thread)


def read_back(df: DataFrame) -> DataFrame:
    """Adds what ``formatted`` and ``loss_spans`` say: ``turns`` (role, text) and ``loss_texts``, unescaped."""
    parts = F.split("formatted", "</turn>\n")
    pieces = F.slice(parts, 1, F.size(parts) - 1)

    def parsed(piece: Column) -> Column:
        cut = F.position(F.lit(": "), piece)
        role, text = F.substr(piece, F.lit(5), cut - 5), F.substr(piece, cut + 2)
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))

    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return df.withColumns({"turns": F.transform(pieces, parsed), "loss_texts": masked})
