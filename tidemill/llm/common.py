"""What several operators of this package share: words, row numbers, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import stored

#: A word is a run of characters that are none of these; a space is one of these.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def numbered(docs: DataFrame, name: str = "rid") -> DataFrame:
    """Adds a number to each row, also to repeated ones.

    The number follows the partition and the place in it, so ``docs`` must give the same partitions each
    time it is evaluated: a stored table, or row-wise work on one.
    """
    return docs.withColumn(name, F.monotonically_increasing_id())


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores in front as it takes to be no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def settled(docs: DataFrame) -> DataFrame:
    """``docs`` with rows that have the same place each time: stored, if they come out of a shuffle."""
    plan = docs._jdf.queryExecution().executedPlan().toString()
    return stored(docs, "settled") if "Exchange" in plan else docs


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def components(links: DataFrame) -> DataFrame:
    """Connected components of an undirected graph.

    ``links`` has the end points of each link in columns ``a`` and ``b`` (whole numbers, any order,
    repeats and loops allowed). Returns ``node, component``, one row for each node of a link between
    different nodes; the component is its smallest node.

    Each round hooks every node to its smallest neighbour below it, follows these hooks to their end by
    doubling, and contracts the links. Smaller neighbours only: no cycles. At least half of the nodes
    that still have links go in a round, so there are at most log2(nodes) rounds. All tables are keyed
    joins and sums; nothing is gathered.
    """
    left = stored(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    labels = None
    while not left.isEmpty():
        hooks = _followed(stored(left.groupBy("b").agg(F.min("a").alias("a")), "hooks"))
        if labels is None:
            roots = left.select(F.col("a").alias("node")).distinct().join(hooks, F.col("node") == F.col("b"), "left_anti")
            labels = hooks.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component"))
            )
        else:
            labels = _renamed(labels, "component", hooks)
        labels = stored(labels, "labels")
        left = stored(
            _renamed(_renamed(left, "a", hooks), "b", hooks)
            .where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "links",
        )
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _followed(hooks: DataFrame) -> DataFrame:
    """Points each hook at the end of its chain; a chain of n hooks takes log2(n) rounds."""
    while True:
        up = hooks.select(F.col("b").alias("mid"), F.col("a").alias("top"))
        longer = stored(
            hooks.join(up, hooks.a == up.mid, "left").select("b", F.coalesce("top", "a").alias("a"), F.col("top").isNotNull().alias("moved")), "hooks"
        )
        hooks = longer.select("b", "a")
        if longer.where("moved").isEmpty():
            return hooks


def _renamed(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    to = hooks.select(F.col("b").alias("_from"), F.col("a").alias("_to"))
    return rows.join(to, rows[column] == to["_from"], "left").withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")
