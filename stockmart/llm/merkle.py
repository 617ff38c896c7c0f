"""Merkle manifest of a dataset, and proofs climbed by a recursive query.

Leaves are ranked per language by a range sort. Levels are built ``SPAN`` at a time: a page of up
to ``2 ** SPAN`` consecutive nodes is folded to one node, and the page keeps, for each of its
nodes, the siblings on the way up. Each stored node row therefore links to its ancestor ``SPAN``
levels above, or to the end of its tree. A recursive query then climbs for each leaf: it appends
the siblings of a link to the proof, folds the leaf's hash over them, and goes on at the ancestor.

Near the top all leaves meet the same few nodes. Links over more than a block of ``2 ** BLOCK``
leaves are therefore repeated per block, so no key of the recursive join has more leaves than a
block, and there are as many such rows as blocks times links.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockmart.llm.common import stored

SPAN = 8
BLOCK = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 7
TOP, END = "top", "end"


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_hash(**changed: Column) -> Column:
    """The hash of a row: each field as its byte count, a colon and its value, or ``-`` for null."""
    values = [changed.get(name, F.col(name)).cast("string") for name in FIELDS]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return sha(F.concat(*parts))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree, leaf, and ``start``, the leaf's hash after tampering."""
    touched = F.crc32(F.col("doc_id").cast("string")) % TAMPER == 0
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        leaf_hash().alias("leaf"),
        F.when(touched, leaf_hash(n_chars=F.col("n_chars") + 1)).otherwise(leaf_hash()).alias("start"),
    )


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with ``pos``, their rank from 0 in ``tree`` by ``order``, and ``total``, its size.

    Rows are sorted over range partitions; of each partition and tree only the count is added up.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    laid = stored(
        rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order).withColumn("at", place),
        "merkle-sorted",
    ).withColumn("part", F.shiftright("at", 33))
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = laid.groupBy(tree, "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).select(
        tree,
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy(tree)).alias("total"),
    )
    return laid.join(starts, [tree, "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def fold_page(hashes: list[str], levels: int) -> tuple[str, list[list[str]]]:
    """The node over a page of nodes, and for each of them the steps up to it.

    A step is ``L`` or ``R`` and the sibling on that side, or ``-`` where a node is alone. A page
    that is a tree of its own is folded over as many levels as it has.
    """
    steps: list[list[str]] = [[] for _ in hashes]
    for level in range(levels):
        last = len(hashes) - 1
        for i, up in enumerate(steps):
            at = (i >> level) ^ 1
            up.append("-" if at > last else ("L" if i >> level & 1 else "R") + hashes[at])
        hashes = [hashlib.sha256("".join(hashes[i : i + 2]).encode()).hexdigest() for i in range(0, last + 1, 2)]
    return hashes[0], steps


def folded(pages: DataFrame, span: int) -> DataFrame:
    """Pages with ``top`` and ``links``, the steps of each node. One page is in memory at a time."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pages.schema)}, top string, links array<array<string>>"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops, links = [], []
            for hashes, whole in zip(batch.column("hashes"), batch.column("whole").to_pylist()):
                hashes = hashes.as_py()
                top, steps = fold_page(hashes, (len(hashes) - 1).bit_length() if whole else span)
                tops.append(top)
                links.append(steps)
            more = [pa.array(tops, pa.string()), pa.array(links, pa.list_(pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "top", "links"])

    return pages.mapInArrow(fold, schema)


def node_name(tree: Column, step: int | Column, pos: Column) -> Column:
    step = F.lit(step) if isinstance(step, int) else step
    return F.concat_ws("|", step.cast("string"), pos.cast("string"), tree)


def _pages(nodes: DataFrame, step: int, span: int, name: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """The folded pages over nodes of (tree, pos, total, hash) and what else each node carries."""
    page = F.shiftright("pos", span)
    rows = nodes.groupBy("tree", page.alias("page"), "total").agg(
        F.array_sort(F.collect_list(F.struct("pos", "hash", *extra))).alias("nodes")
    )
    whole = F.col("total") <= 2**span
    return stored(
        folded(rows.select("*", F.col("nodes.hash").alias("hashes"), whole.alias("whole")), span)
        .drop("hashes")
        .withColumn("step", F.lit(step)),
        name,
    )


def climb_trees(nodes: DataFrame, span: int, name: str, extra: tuple[str, ...] = ()) -> list[DataFrame]:
    """The pages of all trees over the nodes, one table per step."""
    steps = []
    while True:
        pages = _pages(nodes, len(steps), span, name, () if steps else extra)
        steps.append(pages)
        nodes = pages.where(~F.col("whole")).select(
            "tree",
            F.col("page").alias("pos"),
            F.shiftright(F.col("total") + 2**span - 1, span).alias("total"),
            F.col("top").alias("hash"),
        )
        if nodes.isEmpty():
            return steps


def tops(steps: list[DataFrame]) -> DataFrame:
    """The end of each tree: tree and hash."""
    out = [p.where("whole").select("tree", F.col("top").alias("hash")) for p in steps]
    while len(out) > 1:
        out = [out[0].unionByName(out[1]), *out[2:]]
    return out[0]


def links(pages: DataFrame, after: Column) -> DataFrame:
    """Node rows: ``node``, the steps to its ancestor, and ``up``, the ancestor or what follows the tree."""
    up = F.when(F.col("whole"), after).otherwise(node_name(F.col("tree"), F.col("step") + 1, F.col("page")))
    rows = pages.select("*", F.posexplode(F.arrays_zip("nodes", "links")).alias("i", "row"))
    pos = F.col("row.nodes.pos")
    return rows.select(
        "tree", "step", pos.alias("pos"), "row.nodes", F.col("row.links").alias("steps"),
        node_name(F.col("tree"), F.col("step"), pos).alias("node"), up.alias("up"),
    )


# Expressions of the recursive query: a hash folded over the steps of a link, and the siblings.
FOLD = """aggregate({steps}, {hash}, (f, s) -> sha2(case left(s, 1)
    when 'L' then concat(substr(s, 2), f) when 'R' then concat(f, substr(s, 2)) else f end, 256))"""
SIBLINGS = "unhex(array_join(transform(filter({steps}, s -> s <> '-'), s -> substr(s, 2)), ''))"
CLIMB = f"""
with recursive climb as (
    select doc_id, unhex(leaf) as leaf, tree, block, up as node, {FOLD.format(steps="steps", hash="start")} as hash,
        {SIBLINGS.format(steps="steps")} as proof
    from {{first}}
    union all
    select /*+ merge(l) */ c.doc_id, c.leaf, c.tree, c.block, l.up, {FOLD.format(steps="l.steps", hash="c.hash")},
        concat(c.proof, {SIBLINGS.format(steps="l.steps")})
    from climb c join {{ladder}} l on c.tree = l.tree and c.block = l.block and c.node = l.node)
select doc_id, lower(hex(leaf)) as leaf, tree, proof, hash as folded_root from climb where node = '{END}'
"""


def manifest(docs: DataFrame, span: int = SPAN) -> tuple[list[DataFrame], DataFrame, list[DataFrame]]:
    """The stored pages of the languages' trees, the ranked subroots, and the pages of the top tree."""
    # Stored first: finding the ranges of the sort reads the rows once more.
    nodes = ranked(stored(leaves(docs), "merkle-leaves"), "tree", ["doc_id", "leaf"]).withColumnRenamed("leaf", "hash")
    steps = climb_trees(nodes, span, "merkle-pages", ("doc_id", "start"))
    subroots = tops(steps).withColumn("one", F.lit(TOP))
    subroots = stored(ranked(subroots, "one", ["tree"]), "merkle-subroots")
    above = subroots.select(F.col("one").alias("tree"), "pos", "total", "hash")
    return steps, subroots, climb_trees(above, span, "merkle-top")


def ladder(
    steps: list[DataFrame], subroots: DataFrame, above: list[DataFrame], span: int, block: int
) -> tuple[DataFrame, DataFrame]:
    """The leaves' own links, and all links above them, those over whole blocks once per block."""
    rank = subroots.select("tree", "total", node_name(F.lit(TOP), 0, F.col("pos")).alias("after"), "pos")
    tree_links = [links(p.drop("total").join(rank.drop("pos"), "tree"), F.col("after")) for p in steps]
    first = tree_links[0].withColumn("block", F.shiftright("pos", block))
    sizes = stored(
        steps[0].select("tree", F.explode(F.sequence(
            F.shiftright(F.shiftleft("page", span), block),
            F.shiftright(F.shiftleft(F.col("page") + 1, span) - 1, block),
        )).alias("block")).distinct(),
        "merkle-blocks",
    )
    out = sizes.sparkSession.createDataFrame([], "tree string, block long, node string, steps array<string>, up string")
    names = out.columns
    for step, rows in enumerate(tree_links[1:], 1):
        if span * step <= block:
            rows = rows.withColumn("block", F.shiftright("pos", block - span * step))
        else:
            rows = rows.join(sizes.withColumn("pos", F.shiftright("block", span * step - block)), ["tree", "pos"])
        out = out.unionByName(rows.select(*names))
    # A language's blocks all meet the links above its subroot.
    homes = sizes.join(rank.select("tree", "pos"), "tree")
    for step, pages in enumerate(above):
        rows = links(pages, F.lit(END)).drop("tree")
        held = homes.withColumn("pos", F.shiftright("pos", span * step))
        out = out.unionByName(rows.join(held, "pos").select(*names))
    return first.select("nodes.doc_id", "nodes.start", F.col("nodes.hash").alias("leaf"), "tree", "block", "steps", "up"), out


def verify(docs: DataFrame, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for each row.

    The manifest is that of the rows as they are. Rows whose id's checksum ``TAMPER`` divides are
    then changed, and each row's hash is folded over its stored siblings.

    Any field may be null, also the id: such rows come first and are not changed. Rows that share
    an id are ranked by their leaves; equal rows are told apart by nothing but their place. Other
    columns are ignored. An empty table has no tree and gives no rows.
    """
    spark = docs.sparkSession
    if docs.isEmpty():
        kept = docs.select("doc_id").limit(0)
        texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        return kept.select("*", *[F.lit("").alias(t) for t in texts], F.lit(True).alias("verified"))
    steps, subroots, above = manifest(docs, span)
    first, rungs = ladder(steps, subroots, above, span, block)
    views = {name: f"merkle_{name}_{uuid.uuid4().hex}" for name in ("first", "ladder")}
    first.createOrReplaceTempView(views["first"])
    stored(rungs, "merkle-ladder").createOrReplaceTempView(views["ladder"])
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        climbed = stored(spark.sql(CLIMB.format(**views)), "merkle-climb")
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)
        for view in views.values():
            spark.catalog.dropTempView(view)
    root = tops(above).first()["hash"]
    named = climbed.join(subroots.select("tree", F.col("hash").alias("subroot")), "tree")
    return named.select(
        "doc_id", "leaf", "subroot", F.lit(root).alias("root"),
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == root).alias("verified"),
    )
