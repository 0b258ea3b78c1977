"""Chat texts from reply trees: paths from root to leaf, ranked by score, each as one conversation.

Links from a node to its parent are doubled by self-joins: after k rounds a node knows its ancestor 2**k
steps up and the score on the way, so a tree of depth d takes log2(d) joins. Then each leaf has the score of
its path, the best paths of a tree are chosen, and only these are spelled out, again by doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.sources.staging import stage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def reply_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, place, node): the nodes of the ``best`` paths of each tree, place 0 at the root.

    ``nodes`` has tree, node (unique, not null), parent (null at a root) and score (null counts as 0). Paths are ranked by the sum of
    scores, ties by the smaller leaf. A node whose parent is missing is a root. Nodes on a circle have no
    root and no leaf that leads to one; they are in no path. An empty table gives no rows.
    """
    rows = stage(nodes.select("tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("score")))
    known = rows.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    jump = stage(
        rows.join(known, "parent", "left")
        .select("node", F.when(F.col("there"), F.col("parent")).alias("up"), "score", F.lit(1).cast("long").alias("depth"))
    )
    jumps = [jump.where("up IS NOT NULL").select("node", "up")]
    size = rows.count()
    while 1 << (len(jumps) - 1) < size and not jumps[-1].isEmpty():
        higher = jump.select(
            F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"), F.col("depth").alias("depth2")
        )
        # Only nodes that are still below a root are joined on, so long paths do not drag the short ones along.
        going = jump.where("up IS NOT NULL").join(higher, "up").select(
            "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"),
            (F.col("depth") + F.col("depth2")).alias("depth"),
        )
        jump = stage(jump.where("up IS NULL").unionByName(going))
        jumps.append(jump.where("up IS NOT NULL").select("node", "up"))
    parents = rows.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = jump.where("up IS NULL").join(parents, "node", "left_anti").join(rows.select("tree", "node"), "node")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    # Places count from the leaf first; each round adds the ancestors 2**k above all found so far.
    path = chosen.select("tree", F.col("node").alias("leaf"), "node", (F.col("depth") - 1).alias("place"))
    for k in range(len(jumps) - 1, -1, -1):
        above = path.join(jumps[k], "node").select("tree", "leaf", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place"))
        path = stage(path.union(above))
    return path


def escape(text: Column) -> Column:
    """Reversible: afterwards the text holds no control string."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def format_paths(path: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, leaf, formatted, mask): one text for each path, and what of it is to be learned.

    ``nodes`` has node, role and text; null role or text is empty. A turn is ``<|im_start|>role``, a new line, the text, ``<|im_end|>`` and a
    new line. ``mask`` is an array of (start, end) in code points, one span for each assistant text as escaped.
    A path is one output row, so its turns meet in one task; paths do not.
    """
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    body = escape(F.coalesce("text", F.lit("")))
    head, tail = F.concat(F.lit(OPEN), role, F.lit("\n")), F.lit(CLOSE + "\n")
    told = path.join(nodes.select("node", "role", "text"), "node").select(
        "tree", "leaf", "place", head.alias("head"), body.alias("body"), (F.coalesce("role", F.lit("")) == LEARNED).alias("learned")
    )
    # Where a turn begins is a running sum over the path, not an array that grows turn by turn.
    before = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + F.length(tail)
    placed = told.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    turn = F.struct("place", "head", "body", "learned", F.col("at").cast("int").alias("at"))
    turns = placed.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], tail)), "")
    mask = F.transform(
        F.filter("turns", lambda t: t["learned"]),
        lambda t: F.struct(t["at"].alias("start"), (t["at"] + F.length(t["body"])).alias("end")),
    )
    return turns.select("tree", "leaf", formatted.alias("formatted"), mask.alias("mask"))


def _plain(text: str, role: bool = False) -> str:
    out, at = [], 0
    while (cut := text.find("\\", at)) >= 0:
        after = text[cut + 1]
        out += [text[at:cut], "\n" if role and after == "n" else after]
        at = cut + 2
    return "".join([*out, text[at:]])


def read_back(formatted: str, mask) -> tuple[list[tuple[str, str]], str]:
    """The turns (role, text) of a formatted conversation, and the text under the mask, unescaped."""
    turns = []
    for part in formatted.split(OPEN)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((_plain(role, True), _plain(rest[: rest.index(CLOSE)])))
    return turns, "".join(_plain(formatted[a:b]) for a, b in mask)


def digests(formatted: DataFrame) -> DataFrame:
    """Adds what is read back from formatted and mask: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    fields = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, mask in zip(frame["formatted"], frame["mask"]):
                turns, loss = read_back(text, [(int(s["start"]), int(s["end"])) for s in mask])
                told = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append((len(turns), _sha(told), len(loss), _sha(loss), len(text)))
            made = pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            yield pd.concat([frame[["tree"]].reset_index(drop=True), made], axis=1)

    # As text, since pandas would hold numbers with nulls as doubles.
    rows = formatted.select(F.col("tree").cast("string").alias("tree"), "formatted", "mask")
    return rows.mapInPandas(run, f"tree string, {fields}").withColumn("tree", F.col("tree").cast("long"))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def turns_as_trees(conversations: DataFrame) -> DataFrame:
    """Nodes (tree, node, parent, score, role, text) of ``conversations`` (conv_id, turn, role, text).

    Each row answers the one before it in its conversation, by turn (null first), then role and text where turns are
    equal; repeated rows are turns each. Rows with a null conv_id are one conversation without a number. The order is found
    over all rows at once, so a long conversation is not one task.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("tree", "turn", "role", "text")]
    # Within a partition the ids rise one by one, so the row before has the id less one; parts are joined at their ends.
    sorted_rows = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("node", F.monotonically_increasing_id())
    )
    edge = F.struct("node", "tree")
    ends = sorted_rows.groupBy(F.shiftright("node", 33).alias("part")).agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
    before = Window.orderBy("part")  # one row for each part
    first = ends.withColumn("prev", F.lag("last").over(before)).select(
        F.col("first.node").alias("node"), F.when(F.col("prev.tree").eqNullSafe(F.col("first.tree")), F.col("prev.node")).alias("across")
    )
    previous = sorted_rows.select((F.col("node") + 1).alias("node"), F.col("tree").alias("before"), F.lit(True).alias("there"))
    linked = sorted_rows.join(previous, "node", "left").join(first, "node", "left")
    same = F.col("there") & F.col("before").eqNullSafe(F.col("tree"))
    return linked.select(
        "tree", "node", F.when(same, F.col("node") - 1).otherwise(F.col("across")).alias("parent"), F.lit(0.0).alias("score"), "role", "text"
    )
