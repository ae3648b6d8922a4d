"""Train, validation and test splits that keep related records together (problem 2).

Method: an incremental, persisted table of components (node, size, component, split, old_split).
A run reads the table of the last one, brings the ends of the new ties to the roots of the
components they lie in, and hooks those roots onto each other, shortening the pointers by
jumping until each points at its root.  Only components that a new tie reaches take part in
that; the rows of all others pass through a single join that leaves them as they are.  The
result is written as a new version beside the last.

A component with members of one earlier split keeps it; a component without earlier members
fills the split that is furthest below its share; a component into which members of several
splits have grown together is quarantined: it is reported and kept out of all splits until it
is decided by hand, and ``old_split`` keeps, for each of its nodes, the split that it had.
Nobody moves from one split into another.

Defined results: nodes without ties are components of their own; a tie from a node to itself
or given twice changes nothing; null nodes are ignored; empty tables give empty results; ties
between nodes that are not listed make those nodes known with size 0.  A node that is given
again grows by the size given.  Shares need not add up to one: they are scaled.  A component
larger than its split's share is kept whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.llm.cells import in_cells
from quernstone.llm.forms import with_form
from quernstone.llm.neardup import near_duplicates
from quernstone.runtime import materialize

QUARANTINE = "quarantine"
#: Components of at least this share of all records are placed one by one, the largest first; there are at most 1 / LARGE.
LARGE = 0.005
#: Slices of the hash order in which the other components are counted before they are placed.
SLICES = 1024


def components(nodes: DataFrame, ties: DataFrame) -> DataFrame:
    """(node, component) for ``nodes`` (node) and ``ties`` (a, b); a component is named by its least node.

    Each round, every root hooks onto the least root that it is tied to, pointers jump until
    they reach a root, and the ties are rewritten to roots, those inside one component being
    dropped.  All steps are joins and aggregations on node ids, so a component of any size is
    spread over tasks; the rewritten ties are written out, which cuts the lineage.
    """
    ties = ties.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ties = materialize(ties, "ties")
    known = nodes.where("node is not null").select("node")
    known = known.unionByName(ties.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    pointers = None
    while not ties.isEmpty():
        hooks = ties.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        while True:  # jump: a hook's root may have hooked itself
            hooks = materialize(hooks, "hooks")
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = hooks.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
            jumped = materialize(jumped, "jumped")
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        roots = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        ends = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = ties.join(roots, "a", "left").join(ends, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        ties = materialize(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ties")
        if pointers is None:
            pointers = hooks
        else:
            further = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = pointers.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            pointers = materialize(moved.unionByName(hooks.join(pointers, "node", "left_anti")), "pointers")
    if pointers is None:
        return known.select("node", F.col("node").alias("component"))
    return known.join(pointers, "node", "left").select("node", F.coalesce("root", "node").alias("component"))


COLUMNS = ("node", "size", "component", "split", "old_split")


def update_components(nodes: DataFrame, ties: DataFrame, targets: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The component table (node, size, component, split, old_split) after the new ``nodes`` (node, size) and ``ties`` (a, b).

    ``existing`` is the table of the last run, or None for the first; its components and
    splits hold.  ``targets`` has (split_name, target_share), a few rows.
    """
    sizes = nodes.where("node is not null").groupBy("node").agg(F.sum("size").alias("size"))
    if existing is None:
        named = components(sizes.select("node"), ties)
        table = named.join(sizes, "node", "left").select("node", F.coalesce("size", F.lit(0)).alias("size"), "component", *(F.lit(None).cast("string").alias(c) for c in ("split", "old_split")))
    else:
        table = _grown(sizes, ties, existing.select(*COLUMNS))
    table = materialize(table, "component-table")
    # one row for each component; its earlier splits decide whether it keeps, fills or is quarantined
    per = table.groupBy("component").agg(F.sum("size").alias("size"), F.min("split").alias("least"), F.max("split").alias("most"))
    kept = F.when(F.col("least") != F.col("most"), QUARANTINE).otherwise(F.col("least"))
    per = materialize(per.select("component", "size", kept.alias("split")), "component-sizes")
    placed = table.join(_placed(per, targets).select("component", F.col("split").alias("now")), "component")
    left = F.when((F.col("now") == QUARANTINE) & (F.col("split") != QUARANTINE), F.col("split")).otherwise(F.col("old_split"))
    return placed.select("node", "size", "component", F.col("now").alias("split"), left.alias("old_split"))


def _grown(sizes: DataFrame, ties: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows of ``existing`` and of new nodes with the components that the new ties make."""
    ties = materialize(ties.where("a is not null and b is not null").select("a", "b").distinct(), "new-ties")
    ends = ties.select(F.explode(F.array("a", "b")).alias("node")).unionByName(sizes.select("node")).distinct()
    # what the new batch mentions, with the root it has so far: itself where it is new
    mentioned = ends.join(existing.select("node", "component"), "node", "left").join(sizes, "node", "left")
    mentioned = materialize(mentioned.select("node", F.coalesce("component", "node").alias("root"), F.col("component").isNull().alias("fresh"), F.coalesce("size", F.lit(0)).alias("more")), "mentioned")
    roots = mentioned.select("node", "root")
    of_a, of_b = (roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    reached = ties.join(of_a, "a").join(of_b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    merged = materialize(components(reached.select(F.col("a").alias("node")).limit(0), reached), "merged-roots")
    merged = merged.where("node <> component").select(F.col("node").alias("root"), F.col("component").alias("into"))
    grown = existing.join(mentioned.where("not fresh").select("node", "more"), "node", "left").select(
        "node", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"), F.col("component").alias("root"), "split", "old_split"
    )
    added = mentioned.where("fresh").select("node", F.col("more").alias("size"), "root", *(F.lit(None).cast("string").alias(c) for c in ("split", "old_split")))
    rows = grown.unionByName(added).join(merged, "root", "left")
    return rows.select("node", "size", F.coalesce("into", "root").alias("component"), "split", "old_split")


def save_components(table: DataFrame, path: str, version: int) -> DataFrame:
    """Write ``table`` as a version of the component table kept at ``path``; versions are never overwritten."""
    target = f"{path.rstrip('/')}/version={version:06d}"
    table.select(*COLUMNS).write.mode("errorifexists").parquet(target)
    return table.sparkSession.read.parquet(target)


def load_components(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """(the last whole version of the table at ``path``, its number), or (None, 0); a version without its success mark was broken off."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None, 0
    mark = spark._jvm.org.apache.hadoop.fs.Path
    whole = [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("version=") and fs.exists(mark(s.getPath(), "_SUCCESS"))]
    if not whole:
        return None, 0
    last = max(whole)
    return spark.read.parquet(f"{path.rstrip('/')}/{last}"), int(last.partition("=")[2])


def add_batch(spark: SparkSession, path: str, nodes: DataFrame, ties: DataFrame, targets: DataFrame) -> DataFrame:
    """One run: the persisted table at ``path`` with a batch of new ``nodes`` and ``ties``, written as its next version."""
    existing, version = load_components(spark, path)
    return save_components(update_components(nodes, ties, targets, existing), path, version + 1)


def _placed(per: DataFrame, targets: DataFrame) -> DataFrame:
    spark = per.sparkSession
    shares = {r.split_name: r.target_share for r in targets.collect()}  # one row a split
    filled = {r.split: r.n for r in per.where("split is not null").groupBy("split").agg(F.sum("size").alias("n")).collect()}
    new = per.where("split is null")
    total = (per.agg(F.sum("size").alias("n")).first().n or 0) - filled.get(QUARANTINE, 0)
    scale = sum(shares.values()) or 1.0
    lack = {s: total * share / scale - filled.get(s, 0) for s, share in shares.items()}
    large = {}
    for row in new.where(F.col("size") >= max(1.0, total * LARGE)).orderBy(F.desc("size"), "component").collect():  # at most 1 / LARGE rows
        split = max(sorted(lack), key=lack.get)
        lack[split] -= row["size"]
        large[row["component"]] = split
    named = spark.createDataFrame(list(large.items()), "component string, large_split string")
    rest = new.join(F.broadcast(named), "component", "left_anti")
    # the others in hash order: slices are counted, then each component knows how many records lie before it
    sliced = rest.withColumn("h", F.xxhash64("component")).withColumn("slice", F.pmod("h", F.lit(SLICES)))
    counts = sorted((r.slice, r.n) for r in sliced.groupBy("slice").agg(F.sum("size").alias("n")).collect())  # at most SLICES rows
    before, at = [], 0
    for k, n in counts:
        before.append((k, at))
        at += n
    starts = spark.createDataFrame(before, "slice long, before long")
    within = F.sum("size").over(Window.partitionBy("slice").orderBy("h", "component").rowsBetween(Window.unboundedPreceding, -1))
    placed = sliced.join(F.broadcast(starts), "slice").withColumn("at", F.col("before") + F.coalesce(within, F.lit(0)) + F.col("size") / 2)
    positive = {s: x for s, x in sorted(lack.items()) if x > 0} or dict.fromkeys(sorted(shares), 1.0)
    choice, edge = F.lit(None).cast("string"), 0.0
    weight = sum(positive.values())
    for split, x in reversed(list(positive.items())):
        choice = F.when(F.col("at") >= at * (1 - (edge + x) / weight), F.lit(split)).otherwise(choice) if edge == 0 else F.when(
            (F.col("at") >= at * (1 - (edge + x) / weight)) & (F.col("at") < at * (1 - edge / weight)), F.lit(split)
        ).otherwise(choice)
        edge += x
    first = next(iter(positive), None)
    small = placed.select("component", "size", F.coalesce(choice, F.lit(first)).alias("split"))
    big = new.join(F.broadcast(named), "component").select("component", "size", F.col("large_split").alias("split"))
    return per.where("split is not null").unionByName(small).unionByName(big)


def class_name(a: str, b: str) -> F.Column:
    """Name of the node of a class of equal word sets."""
    return F.concat(F.lit("q"), F.hex(a), F.hex(b))


def bank_graph(bank: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, nodes, ties) of the question bank.

    A node is a source file by its case-folded form, or the record itself where the file is
    null; a class of near-equal questions is a node of size 0 that ties the files of its
    records.  records: (id, file, node).  Leave records without a file out of ``bank`` where
    they must not tie the files of others.
    """
    rows = with_form(bank.select(F.col("question_id").alias("id"), F.col("source_file").alias("file")).where("id is not null").distinct(), "file", "form", fold_case=True)
    # prefixes keep the names of files, records and classes apart
    node = F.coalesce(F.concat(F.lit("f"), F.md5("form")), F.concat(F.lit("r"), F.md5("id")))
    records = materialize(rows.select("id", "file", node.alias("node")), "split-records")
    nodes = records.select("id", "node").distinct().groupBy("node").agg(F.count("*").alias("size"))
    members, links = near_duplicates(bank.select(F.col("question_id").alias("id"), F.col("question_text").alias("text")))
    of_class = records.select("id", "node").distinct().join(members, "id").select("node", "h1", "h2").distinct()
    linked = links.select(F.col("a1").alias("h1"), F.col("a2").alias("h2")).unionByName(links.select(F.col("b1").alias("h1"), F.col("b2").alias("h2")))
    several = of_class.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    useful = linked.unionByName(several).distinct()
    ties = of_class.join(useful, ["h1", "h2"], "left_semi").select(F.col("node").alias("a"), class_name("h1", "h2").alias("b"))
    ties = ties.unionByName(links.select(class_name("a1", "a2").alias("a"), class_name("b1", "b2").alias("b")))
    return records, nodes, ties


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, group, n_links): for each record its group of linked classes and how many other classes its own is linked to."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a1").alias("h1"), F.col("a2").alias("h2")), F.struct(F.col("b1").alias("h1"), F.col("b2").alias("h2")))).alias("e")).select("e.h1", "e.h2")
    counts = ends.groupBy("h1", "h2").agg(F.count("*").alias("n_links"))
    named = counts.select("h1", "h2", "n_links", class_name("h1", "h2").alias("node"))
    tied = components(named.select("node"), links.select(class_name("a1", "a2").alias("a"), class_name("b1", "b2").alias("b")))
    linked = named.join(tied, "node").select("h1", "h2", "n_links", "component")
    group = F.coalesce("component", class_name("h1", "h2"))
    return members.join(linked, ["h1", "h2"], "left").select("id", group.alias("group"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def file_pairs(records: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs (file_a, file_b) of different stored file names whose nodes lie in one component."""
    files = records.where("file is not null").select("file", "node").distinct().join(table.select("node", "component"), "node").select("file", "component").distinct()
    shared = files.groupBy("component").agg(F.count("*").alias("n")).where("n > 1")
    left, right = in_cells(materialize(files.join(shared, "component"), "split-files"), "file", "n")
    a, b = left.alias("a"), right.alias("b")
    return a.join(b, (F.col("a.component") == F.col("b.component")) & (F.col("a.cell") == F.col("b.cell")) & (F.col("a.file") < F.col("b.file"))).select(
        F.col("a.file").alias("file_a"), F.col("b.file").alias("file_b")
    )
