"""Connected components: of graphs by label rounds, and of masks by their runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablework.operators.lineage import kept

#: A key with more than a HEAVY-th of all rows, and more than LEAST_HEAVY, is joined by a broadcast; there are fewer than HEAVY such keys.
HEAVY, LEAST_HEAVY = 1000, 10_000
#: Rows of a task: edges and nodes meet in so many tasks that none grows with the graph.
ROWS = 1_000_000
#: Pixels of a cell in which runs of neighbouring rows meet.
CELL = 64


def _heavy(counts: DataFrame, key: str) -> DataFrame | None:
    """Keys of counts (key, n) that hold too many rows for one task."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    if total <= LEAST_HEAVY:
        return None
    heavy = kept(counts.where(F.col("n") > max(LEAST_HEAVY, total // HEAVY)).select(key))
    return heavy if heavy.limit(1).count() else None


def _look_up(rows: DataFrame, table: DataFrame, key: str, heavy: DataFrame | None, tasks: int) -> DataFrame:
    """rows with what table (one row for each key) says of their key."""
    dealt = lambda some: some.repartition(tasks, key).join(table.repartition(tasks, key), key)
    if heavy is None:
        return dealt(rows)
    few = F.broadcast(table.join(F.broadcast(heavy), key, "left_semi"))
    return dealt(rows.join(F.broadcast(heavy), key, "left_anti")).unionByName(rows.join(few, key))


def _least(rows: DataFrame, value: str, heavy: DataFrame | None, tasks: int) -> DataFrame:
    """The least value of every u in rows (u, v, value). Rows of a heavy u are first dealt out by v."""
    if heavy is not None:
        hub = F.broadcast(heavy.select(F.col("v").alias("u"), F.lit(True).alias("hub")))
        rows = rows.join(hub, "u", "left").withColumn("salt", F.when(F.col("hub"), F.pmod(F.xxhash64("v"), F.lit(tasks))).otherwise(0))
        rows = rows.repartition(tasks, "u", "salt").groupBy("u", "salt").agg(F.min(value).alias(value))
    return rows.repartition(tasks, "u").groupBy("u").agg(F.min(value).alias(value))


def graph_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Least node of every node's component: node, label. Each round takes the least label around, hooks every label to the least that one of
    its nodes has met, and jumps to where the label then leads, so the number of rounds grows with the logarithm of a component's width.
    Rounds are checkpointed, and end when no label changes. Hubs, and labels of very many nodes, are looked up
    in a broadcast of fewer than HEAVY rows; the others meet in tasks of about ROWS rows. Edges may be repeated."""
    one_way = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, 2 * one_way.count() // ROWS)
    both = kept(one_way.union(one_way.select("v", "u")).repartition(tasks, "u", "v").distinct())
    hubs = _heavy(both.groupBy("v").agg(F.count("*").alias("n")), "v")
    labels = kept(_least(both.withColumn("label", F.least("u", "v")), "label", hubs, tasks))
    while True:
        around = _least(_look_up(both, labels.select(F.col("u").alias("v"), F.col("label").alias("near")), "v", hubs, tasks), "near", hubs, tasks)
        least = kept(labels.repartition(tasks, "u").join(around, "u").select("u", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        sizes = least.groupBy("label").agg(F.count("*").alias("n"))
        hook = least.groupBy(F.col("old").alias("label")).agg(F.min("label").alias("met"))
        own = least.select(F.col("u").alias("label"), F.col("label").alias("own"))
        jump = hook.repartition(tasks, "label").join(own.repartition(tasks, "label"), "label").select("label", F.least("met", "own").alias("far"))
        new = kept(_look_up(least, jump, "label", _heavy(sizes, "label"), tasks).select("u", "old", F.least("label", "far").alias("label")))
        if not new.where("label < old").limit(1).count():
            return new.select(F.col("u").alias("node"), "label")
        labels = new.select("u", "label")


def runs(mask: DataFrame) -> DataFrame:
    """Runs of neighbouring pixels in each row of each image's mask (img, x, y): img, y, x0, x1."""
    row = Window.partitionBy("img", "y").orderBy("x")
    at = mask.select("img", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")).distinct()
    return at.withColumn("_run", F.col("x") - F.row_number().over(row)).groupBy("img", "y", "_run").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("_run")


def gaps(held: DataFrame, width: int, height: int) -> DataFrame:
    """Runs of the pixels that no run of held covers, in all rows of the images that have one: img, y, x0, x1."""
    edge = held.select("img").distinct().select("img", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(height - 1).cast("long"))).alias("y"), F.lit(-1).cast("long").alias("x0"), F.lit(-1).cast("long").alias("x1"))
    row = Window.partitionBy("img", "y").orderBy("x0")
    after = edge.union(held.select("img", "y", "x0", "x1")).select("img", "y", (F.col("x1") + 1).alias("x0"), (F.coalesce(F.lead("x0").over(row), F.lit(width)) - 1).cast("long").alias("x1"))
    return after.where("x0 <= x1")


def touching(rows: DataFrame, reach: int) -> DataFrame:
    """Pairs a, b (structs img, y, x0) of runs in neighbouring rows that overlap, or (reach 1) touch at a corner. They meet by cells of
    CELL pixels, so a row of many runs isn't paired with all of the next; a pair that meets in several cells comes once for each."""
    cells = lambda more: F.explode(F.sequence(F.floor((F.col("x0") - more) / CELL), F.floor((F.col("x1") + more) / CELL)))
    upper = rows.select("img", (F.col("y") + 1).alias("y"), F.col("x0").alias("u0"), F.col("x1").alias("u1"), cells(reach).alias("cell"))
    met = rows.withColumn("cell", cells(0)).join(upper, ["img", "y", "cell"]).where((F.col("u0") <= F.col("x1") + reach) & (F.col("x0") <= F.col("u1") + reach))
    run = lambda y, x: F.struct("img", y.alias("y"), F.col(x).alias("x0"))
    return met.select(run(F.col("y") - 1, "u0").alias("a"), run(F.col("y"), "x0").alias("b"))


def run_components(rows: DataFrame, reach: int = 1) -> DataFrame:
    """Runs (img, y, x0, x1) with label: the first run, in raster order, of their component (a struct img, y, x0). Corners connect if reach
    is 1. What is linked are runs, so an image of any size is dealt out, and one image may span tasks."""
    rows = kept(rows)
    node = F.struct("img", "y", "x0")
    found = graph_components(touching(rows, reach))
    return rows.withColumn("node", node).join(found, "node", "left").select("img", "y", "x0", "x1", F.coalesce("label", "node").alias("label"))


def _pixels(rows: DataFrame, *others: str) -> DataFrame:
    return rows.select("img", F.explode(F.sequence("x0", "x1")).alias("x"), "y", *others)


def pixel_components(mask: DataFrame) -> DataFrame:
    """8-connected components of each image's mask (img, x, y): img, x, y, label (the component's least y * 2**20 + x)."""
    found = run_components(runs(mask))
    return _pixels(found.withColumn("label", F.shiftleft("label.y", 20) + F.col("label.x0")), "label")


def component_areas(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("img", "label").agg(F.count("*").alias("area"))


def without_small(labelled: DataFrame, least: int) -> DataFrame:
    """Pixels of components with at least so many."""
    big = component_areas(labelled).where(F.col("area") >= least)
    return labelled.join(big, ["img", "label"], "left_semi").select("img", "x", "y")


def filled_holes(mask: DataFrame, width: int, height: int) -> DataFrame:
    """The mask with the background that the corner (0, 0) doesn't reach (over 4 neighbours) filled. If the corner is in the mask, all of the
    image is. Pixels outside the image are left out."""
    held = kept(runs(mask.where(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1))))
    # The component of the corner is named by it: no run comes before.
    closed = run_components(gaps(held, width, height), reach=0).where((F.col("label.y") > 0) | (F.col("label.x0") > 0))
    return _pixels(held.select("img", "y", "x0", "x1").union(closed.select("img", "y", "x0", "x1")))
