"""Reply trees as chat conversations, in built-in functions only.

Messages name the message they reply to. Self-joins enumerate the paths from a root to every leaf:
joining a table of ancestors with itself doubles how far it reaches, so a path of n messages takes
about log2(n) joins to prepare and as many to spread; only identifiers take part. Paths are ranked in
their tree by score, and each chosen one is written out as one conversation.

The template marks where a turn begins and ends. Control strings that occur inside a text or role
are broken by an escape character, which is itself escaped, so that marks are only ever marks and
``parse`` gives back what went in. The loss mask lists the code points of the assistant's texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import cut

ESCAPE = "␛"


@dataclass(frozen=True)
class Template:
    """Marks around a turn, all strings that models of this kind read as control, the roles learnt."""

    begin: str = "<|im_start|>"
    end: str = "<|im_end|>"
    control: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
        "<<SYS>>", "<</SYS>>", "<|system|>", "<|user|>", "<|assistant|>",
    )
    learnt: tuple[str, ...] = ("assistant",)

    def escape(self, text: Column) -> Column:
        """Doubled escape characters first; then no control string is left whole."""
        start = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e"))
        return reduce(
            lambda done, word: F.replace(done, F.lit(word), F.lit(word[0] + ESCAPE + "c" + word[1:])),
            sorted({*self.control, self.begin, self.end}),
            start,
        )

    def unescape(self, text: Column) -> Column:
        whole = F.replace(text, F.lit(ESCAPE + "c"), F.lit(""))
        return F.replace(whole, F.lit(ESCAPE + "e"), F.lit(ESCAPE))

    def head(self, role: Column) -> Column:
        """The mark and the role, which ends at the first line feed."""
        name = F.replace(self.escape(role), F.lit("\n"), F.lit(ESCAPE + "n"))
        return F.concat(F.lit(self.begin), name, F.lit("\n"))

    def tail(self) -> Column:
        return F.lit(self.end + "\n")

    def parse(self, conversation: Column) -> Column:
        """The turns of a formatted conversation: an array of (role, text)."""
        parts = F.split(conversation, "\\Q" + self.begin + "\\E", -1)
        turns = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

        def turn(part: Column) -> Column:
            role = F.substring_index(part, "\n", 1)
            after = F.length(role) + 2
            text = F.substr(part, after, F.length(part) - after + 1 - len(self.end) - 1)
            name = F.replace(role, F.lit(ESCAPE + "n"), F.lit("\n"))
            return F.struct(self.unescape(name).alias("role"), self.unescape(text).alias("text"))

        return F.transform(turns, turn)

    def learnt_text(self, conversation: Column, spans: Column) -> Column:
        """What lies under the loss mask, unescaped."""
        pieces = F.transform(
            spans, lambda s: self.unescape(F.substr(conversation, s["start"] + 1, s["length"]))
        )
        return F.array_join(pieces, "")




def _ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables (tree, node, up) for 1, 2, 4, ... steps up, and one of nodes under a cycle, if any."""
    child, parent = nodes.alias("c"), nodes.select("tree", "node").alias("p")
    known = F.col("c.tree").eqNullSafe(F.col("p.tree")) & (F.col("c.parent") == F.col("p.node"))
    step = child.join(parent, known).select("c.tree", "c.node", F.col("c.parent").alias("up"))
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    levels: list[DataFrame] = []
    while True:
        step = cut(step, "ancestors")
        if step.isEmpty():
            return levels, None
        # No path has more steps than its tree has messages.
        if 1 << len(levels) >= largest:
            return levels, step
        levels.append(step)
        a, b = step.alias("a"), step.alias("b")
        on = F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.up") == F.col("b.node"))
        step = a.join(b, on).select("a.tree", "a.node", "b.up")


def reply_paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, above): every message of the path that ends in ``leaf``; ``above`` counts
    the steps from the leaf. ``nodes`` has unique (tree, node) and a parent."""
    levels, cyclic = _ancestors(nodes)
    if levels:
        a, b = nodes.select("tree", "node").alias("a"), levels[0].select("tree", "up").alias("b")
        on = F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.up"))
        leaves = a.join(b, on, "left_anti")
    else:
        leaves = nodes.select("tree", "node")
    if cyclic is not None:
        a, b = leaves.alias("a"), cyclic.alias("b")
        on = F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node"))
        leaves = a.join(b, on, "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    for k in reversed(range(len(levels))):
        a, b = paths.alias("a"), levels[k].alias("b")
        on = F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node"))
        here = F.struct(F.col("a.node").alias("node"), F.col("a.above").alias("above"))
        up = F.struct(F.col("b.up").alias("node"), (F.col("a.above") + (1 << k)).alias("above"))
        both = F.when(F.col("b.up").isNull(), F.array(here)).otherwise(F.array(here, up))
        paths = (
            a.join(b, on, "left")
            .select("a.tree", "a.leaf", F.explode(both).alias("at"))
            .select("tree", "leaf", "at.node", "at.above")
        )
    return paths


def conversations(
    messages: DataFrame,
    tree: str = "tree",
    node: str = "node",
    parent: str = "parent",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    branches: int | None = None,
    template: Template = Template(),
) -> DataFrame:
    """tree, leaf, rank, score, formatted, loss_spans: a row for each chosen path of each tree.

    ``branches`` keeps that many paths of a tree, best first (None: all); a path's score is the sum
    of its messages' scores, nulls counting 0, and of equal ones the smaller leaf comes first.
    ``loss_spans`` has (start, length) in code points for each text of a learnt role, empty ones
    included.

    Null roles and texts are empty. A null parent, or one that isn't in the tree, makes a root.
    Messages with a null node are ignored. A node that occurs several times counts once, with the
    smallest (parent, role, text, score). What replies to itself in a circle belongs to no path.
    A null tree is a tree. Other columns are ignored, whatever their names; an empty table gives an
    empty result. A conversation is one value and must fit into memory, like any text.
    """
    empty = F.lit("")
    given = messages.select(
        F.col(f"`{tree}`").alias("tree"),
        F.col(f"`{node}`").alias("node"),
        F.struct(
            F.col(f"`{parent}`").alias("parent"),
            F.coalesce(F.col(f"`{role}`").cast("string"), empty).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), empty).alias("text"),
            F.coalesce(
                F.col(f"`{score}`").cast("double") if score else F.lit(None), F.lit(0.0)
            ).alias("score"),
        ).alias("message"),
    ).where("node IS NOT NULL")
    unique = cut(given.groupBy("tree", "node").agg(F.min("message").alias("m")).select("tree", "node", "m.*"), "messages")
    paths = cut(reply_paths(unique.select("tree", "node", "parent")), "paths")

    a, b = paths.alias("a"), unique.alias("b")
    on = F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node"))
    scores = a.join(b.select("b.tree", "b.node", "b.score").alias("b"), on)
    ranked = (
        scores.groupBy("a.tree", "a.leaf")
        .agg(F.sum("b.score").alias("score"))
        .withColumn("rank", F.expr("row_number() OVER (PARTITION BY tree ORDER BY score DESC, leaf)"))
    )
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)

    turns = a.join(b, on).select("a.tree", "a.leaf", "a.above", "b.role", "b.text")
    head, body = template.head(F.col("role")), template.escape(F.col("text"))
    pieces = turns.select(
        "tree", "leaf", "above", head.alias("head"), body.alias("body"),
        F.col("role").isin(*template.learnt).alias("learnt"),
    )
    size = F.length("head") + F.length("body") + len(template.end) + 1
    before = "OVER (PARTITION BY tree, leaf ORDER BY above DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = pieces.withColumn("size", size).withColumn(
        "start", F.coalesce(F.expr(f"sum(size) {before}"), F.lit(0)) + F.length("head")
    )
    turn = F.struct(
        (-F.col("above")).alias("order"),
        F.concat("head", "body", template.tail()).alias("piece"),
        F.struct("start", F.length("body").cast("long").alias("length")).alias("span"),
        "learnt",
    )
    written = placed.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    r, w = ranked.alias("r"), written.alias("w")
    same = F.col("r.tree").eqNullSafe(F.col("w.tree")) & (F.col("r.leaf") == F.col("w.leaf"))
    return r.join(w, same).select(
        "r.tree",
        "r.leaf",
        "r.rank",
        "r.score",
        F.array_join("w.turns.piece", "").alias("formatted"),
        F.transform(F.filter("w.turns", lambda t: t["learnt"]), lambda t: t["span"]).alias("loss_spans"),
    )


def replies_of_turns(rows: DataFrame, conversation: str, turn: str, more: Sequence[str]) -> DataFrame:
    """Rows of a table of turns as messages, each a reply to the one before it in its conversation."""
    order = ", ".join(f"`{c}`" for c in (turn, *more))
    number = F.expr(f"row_number() OVER (PARTITION BY `{conversation}` ORDER BY {order})").cast("long")
    numbered = rows.withColumn("__node", number)
    earlier = F.when(F.col("__node") > 1, F.col("__node") - 1)
    return numbered.select(
        F.col(f"`{conversation}`").alias("tree"),
        F.col("__node").alias("node"),
        earlier.alias("parent"),
        *[F.col(f"`{c}`") for c in more],
    )
