"""Conversations from reply trees, formatted with a chat template, in native functions.

Messages name the message they reply to.  Self-joins that double their reach (1, 2, 4 … replies
up) give every message its depth and the sum of scores of its path in about log2(depth) rounds of
narrow rows; leaves are ranked by the mean score of their path; the same links, walked from the
longest to the shortest, list the messages of each chosen path.  Texts join last, once.

The template marks each turn and escapes control strings inside texts, so that the output reads
back to exactly the turns it was made of.  ``spans`` has one entry a turn: where its text stands
in the output, and whether loss is taken there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import scratch, written
from ledgerloom.operators.windows import sequence_in_group

# fixed values: control strings of common chat templates
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: turns of one path that are put together in one piece, before the pieces are
BLOCK = 256


@dataclass(frozen=True)
class ChatTemplate:
    """``before`` role ``between`` text ``after``, for each turn; ``control`` holds at least these three.

    A backslash goes after the first character of each control string inside a role or text, and
    before each backslash, so neither can hold a control string.  No control string may end with
    the beginning of one.
    """

    before: str = "<|im_start|>"
    between: str = "<|im_sep|>"
    after: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    control: tuple[str, ...] = field(default=CONTROL)

    def escape(self, text: Column) -> Column:
        doubled = F.regexp_replace(text, r"\\", r"\\\\")
        inside = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in self.control)
        return F.regexp_replace(doubled, inside, r"\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def turn(self, role: Column, text: Column) -> tuple[Column, Column]:
        """What stands before the text, and the text, as formatted (without ``after``)."""
        return F.concat(F.lit(self.before), self.escape(role), F.lit(self.between)), self.escape(text)

    def read(self, text: Column) -> Column:
        """The turns of a formatted text, as structs of role and escaped body."""
        turns = F.split(text, re.escape(self.after), -1)
        turns = F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))
        start = len(self.before) + 1

        def parts(turn: Column) -> Column:
            halves = F.split(F.substr(turn, F.lit(start)), re.escape(self.between), 2)
            return F.struct(self.unescape(halves[0]).alias("role"), halves[1].alias("body"))

        return F.transform(turns, parts)


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def reply_links(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Totals of each message's path (tree, node, depth, score, chars; from the root to it), and the links 1, 2, 4 …
    replies up (tree, node, up), each a table of the shared folder.

    ``messages`` has tree, node, parent, score and chars.  A parent that isn't there counts as none.
    Messages whose parents run in a circle have no root and no totals.
    """
    known = messages.select(F.col("tree").alias("p_tree"), F.col("node").alias("p_node"))
    first = messages.join(known, _same("tree", "p_tree") & (F.col("parent") == F.col("p_node")), "left").select("tree", "node", F.col("p_node").alias("up"), F.lit(1).cast("long").alias("depth"), "score", "chars")
    links, waiting = [written(first, "chat-links")[0]], None
    while True:
        left = links[-1].where(F.col("up").isNotNull()).count()
        if left == 0 or left == waiting:  # none, or those that never reach a root
            break
        waiting = left
        here = links[-1]
        there = here.select(F.col("tree").alias("o_tree"), F.col("node").alias("o_node"), F.col("up").alias("o_up"), F.col("depth").alias("o_depth"), F.col("score").alias("o_score"), F.col("chars").alias("o_chars"))
        further = here.where(F.col("up").isNotNull()).join(there, _same("tree", "o_tree") & (F.col("up") == F.col("o_node")))
        moved = further.select("tree", "node", F.col("o_up").alias("up"), *[(F.col(c) + F.col(f"o_{c}")).alias(c) for c in ("depth", "score", "chars")])
        links.append(written(moved.unionByName(here.where(F.col("up").isNull())), "chat-links")[0])
    totals = links[-1].where(F.col("up").isNull()).drop("up")
    return totals, [x.select("tree", "node", "up").where(F.col("up").isNotNull()) for x in links[:-1]]


def best_leaves(messages: DataFrame, totals: DataFrame, best: int | None) -> DataFrame:
    """Leaves with their place among the tree's (tree, leaf, branch): by mean score of the path, longer paths first, then by id."""
    parents = messages.where(F.col("parent").isNotNull()).select(F.col("tree").alias("p_tree"), F.col("parent").alias("p_node"))
    leaves = totals.join(parents, _same("tree", "p_tree") & (F.col("node") == F.col("p_node")), "left_anti")
    if best is None:
        return leaves.select("tree", F.col("node").alias("leaf"), F.lit(None).cast("int").alias("branch"))
    order = Window.partitionBy("tree").orderBy((F.col("score") / F.col("depth")).desc(), F.col("depth").desc(), "node")
    return leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= best).select("tree", F.col("node").alias("leaf"), "branch")


def members(leaves: DataFrame, links: list[DataFrame]) -> DataFrame:
    """The messages of each leaf's path (tree, leaf, branch, node).

    A message so far stands for itself and, through the link of 2^k replies, one further up; from
    the longest link to the shortest that gives every message above the leaf once.
    """
    paths = leaves.withColumn("node", F.col("leaf"))
    for link in reversed(links):
        link = link.select(F.col("tree").alias("l_tree"), F.col("node").alias("l_node"), "up")
        both = paths.join(link, _same("tree", "l_tree") & (F.col("node") == F.col("l_node")), "left")
        paths = both.select("tree", "leaf", "branch", F.explode(F.array_compact(F.array("node", "up"))).alias("node"))
    return paths


def format_trees(messages: DataFrame, template: ChatTemplate | None = None, best: int | None = 1, distinct_nodes: bool = False) -> DataFrame:
    """One row for each chosen path: tree, leaf, branch, text, spans (start, end, loss; code points, end exclusive).

    ``messages`` has tree, node, parent, role, text and score.  ``best`` is the number of branches of
    a tree (None: all, then ``branch`` is null).  Null roles and texts are empty, a null score is 0;
    a null tree is a tree; rows without ``node`` are left out; a ``node`` that repeats in its tree
    counts once, with its least (parent, role, text, score), unless the caller knows that none
    does (``distinct_nodes``); a missing parent makes a root, and replies in a circle are on no
    path.  An empty table gives no rows; other columns don't matter.  A formatted path is one
    value, put together from blocks of ``BLOCK`` turns.
    """
    template = template or ChatTemplate()
    fields = F.struct("parent", "role", "text", "score")
    plain = messages.select("tree", "node", F.col("parent"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    once = plain.where(F.col("node").isNotNull())
    if not distinct_nodes:
        once = once.groupBy("tree", "node").agg(F.min(fields).alias("m")).select("tree", "node", "m.*")
    head, body = template.turn(F.col("role"), F.col("text"))
    loss = F.col("role").isin(*template.loss_roles)
    turns = once.select("tree", "node", "parent", "score", head.alias("head"), body.alias("body"), loss.alias("loss"))
    turns = turns.withColumn("chars", (F.length("head") + F.length("body") + len(template.after)).cast("long"))
    with scratch(messages.sparkSession) as keep:
        turns, _ = written(turns, "chat-turns")
        out, path = written(_assembled(turns, template, best), "chat-formatted")
        keep(path)
    return out


def _assembled(turns: DataFrame, template: ChatTemplate, best: int | None) -> DataFrame:
    totals, links = reply_links(turns.select("tree", "node", "parent", "score", "chars"))
    chosen = members(best_leaves(turns, totals, best), links)
    ends = totals.select(F.col("tree").alias("e_tree"), F.col("node").alias("e_node"), "depth", F.col("chars").alias("until"))
    said = turns.join(ends, _same("tree", "e_tree") & (F.col("node") == F.col("e_node"))).select(F.col("tree").alias("t_tree"), F.col("node").alias("t_node"), "depth", "until", "head", "body", "loss")
    rows = chosen.join(said, _same("tree", "t_tree") & (F.col("node") == F.col("t_node")))
    end = F.col("until") - len(template.after)
    span = F.struct((end - F.length("body")).alias("start"), end.alias("end"), "loss")
    rows = rows.select("tree", "leaf", "branch", "depth", F.struct("depth", F.concat("head", "body", F.lit(template.after)).alias("piece"), span.alias("span")).alias("turn"))
    blocks = rows.groupBy("tree", "leaf", "branch", F.floor((F.col("depth") - 1) / BLOCK).alias("block")).agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    blocks = blocks.select("tree", "leaf", "branch", F.struct("block", F.array_join("turns.piece", "").alias("text"), F.col("turns.span").alias("spans")).alias("part"))
    whole = blocks.groupBy("tree", "leaf", "branch").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.select("tree", "leaf", "branch", F.array_join("parts.text", "").alias("text"), F.flatten("parts.spans").alias("spans"))


def as_replies(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation as a tree of one branch: each replies to the one before it, by turn, then role and text.

    ``conversations`` has conv_id, turn, role and text.  Every row counts, repeated ones too.  Places
    are counted on three levels, so a conversation may hold any share of the rows.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    buckets = [F.floor(F.col("turn") / BLOCK), F.floor(F.col("turn") / BLOCK**2)]
    placed = sequence_in_group(rows, ["conv_id"], [F.col(c) for c in ("turn", "role", "text")], buckets, "node")
    return placed.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def read_back(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """What the formatted texts say: tree, leaf, turns (role, text), loss (the texts under the loss mask), chars.

    Turns are read by the template's marks; a turn is under the mask if its span covers exactly the
    body that stands there, and fails if it covers anything else.
    """
    template = template or ChatTemplate()
    marks = len(template.before) + len(template.between) + len(template.after)
    read = formatted.select("tree", "leaf", template.read(F.col("text")).alias("read"), "spans", F.length("text").cast("long").alias("chars"))
    paired = F.zip_with("read", "spans", lambda r, s: F.struct(r["role"].alias("role"), r["body"].alias("body"), s["loss"].alias("loss"), (s["end"] - s["start"]).alias("size")))
    right = F.forall("both", lambda x: F.coalesce(F.length(x["body"]) == x["size"], F.lit(False)))
    last = F.element_at("spans", -1)["end"] + len(template.after)
    checked = F.when(right & (last == F.col("chars")), F.col("both")).otherwise(F.raise_error(F.lit(f"a span doesn't fit its turn (marks of {marks} characters)")))
    out = read.withColumn("both", paired).select("tree", "leaf", "chars", checked.alias("both"))
    turns = F.transform("both", lambda x: F.struct(x["role"].alias("role"), template.unescape(x["body"]).alias("text")))
    under = F.transform(F.filter("both", lambda x: x["loss"]), lambda x: template.unescape(x["body"]))
    return out.select("tree", "leaf", turns.alias("turns"), under.alias("loss"), "chars")


def report(conversations: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Digests of what is read back from each formatted conversation.

    Null roles and texts are empty, a null conv_id is a conversation; ties of turn are ordered by
    role and text; repeated rows are turns each; an empty table gives no rows; other columns don't matter.
    """
    template = template or ChatTemplate()
    back = read_back(format_trees(as_replies(conversations), template, distinct_nodes=True), template)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.array_join("loss", "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(under).cast("long").alias("loss_chars"), F.sha2(under, 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"),
    )
