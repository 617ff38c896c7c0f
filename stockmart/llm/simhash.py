"""SimHash near-duplicates with pivot distance tables.

Fingerprints that differ in ``MOST_BITS`` bits or fewer are linked, and linked documents are
classes. Equal fingerprints are one class from the start. Different ones meet in buckets: the bits
are cut into ``BLOCKS`` blocks, of which two fingerprints that link share ``BLOCKS - MOST_BITS`` at
least, so each choice of that many blocks is a bucket key and no link is missed. In a bucket, the
table of Hamming distances to many reference fingerprints discards pairs: by the triangle
inequality their greatest coordinate difference is at most their distance. Survivors are verified.

A bucket needs connecting, not listing: fingerprints that are connected already are not compared
again, and each bucket gives a spanning forest, never all its pairs. Buckets with many
fingerprints are split into pairs of parts, each a task of bounded size. The links are joined to
classes by alternating star contraction, with every round stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmart.llm.common import row_key, stored, text_of, unused
from stockmart.llm.words import slices, texts_of

SHINGLE = 4
MOST_BITS = 4
BLOCKS = 6
PIVOTS = 16
#: Fingerprints of a bucket that one task handles together; larger buckets are split.
PART = 20_000
SEED = 42


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash over the XXH64 of all word shingles of a text that is lower-cased already."""
    import xxhash

    words = text.split()
    if not words:
        return 0
    whole = b" ".join(words)
    bounds = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
    n = max(1, len(words) - size + 1)
    ends = bounds[size:] if len(words) >= size else bounds[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    starts, stops = bounds[:n].tolist(), (ends - 1).tolist()
    for i in range(0, n, 65_536):
        part = [digest(whole[a:b], SEED) for a, b in zip(starts[i : i + 65_536], stops[i : i + 65_536])]
        hashes = np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8)
        # Summed by byte value, so that the bits are unpacked once per value and not per shingle.
        for byte in range(8):
            counts = np.bincount(hashes[:, byte], minlength=256)
            ones[8 * byte : 8 * byte + 8] += counts @ _BITS
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprints(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = SHINGLE
) -> DataFrame:
    """doc_id and fingerprint (a long with the 64 bits) of each row; nothing is shuffled."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [fingerprint(t.encode().lower(), size) for t in texts_of(part, "text").to_pylist()]
                bits = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(bits)], ["doc_id", "fingerprint"])

    kind = dict(docs.dtypes)[id_col]
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(hashed, f"doc_id {kind}, fingerprint long")


def bucket_keys(bits: Column, blocks: int = BLOCKS, most_bits: int = MOST_BITS) -> Column:
    """Array of bucket keys: the bits of some blocks, and which blocks they are."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    keys = []
    for which, chosen in enumerate(combinations(masks, blocks - most_bits)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(which).alias("which"), bits.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def pivots_of(distinct: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: those with the least hash. ``count`` rows come to the driver."""
    rows = distinct.select("fingerprint").orderBy(F.xxhash64("fingerprint")).limit(count).collect()
    return np.array([r[0] for r in rows], np.int64).view(np.uint64)


def distance_table(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values[:, None] ^ pivots[None, :]).astype(np.int8)


class _Forest:
    """Union by least index over the rows of one bucket."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def near_pairs_by_shift(
    group: np.ndarray, values: np.ndarray, table: np.ndarray, most_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs inside runs of equal ``group``, which are short: each row against the next ones."""
    left, right = [], []
    shift, alive = 1, np.arange(len(group) - 1)
    while len(alive):
        alive = alive[alive + shift < len(group)]
        alive = alive[group[alive] == group[alive + shift]]
        other = alive + shift
        close = np.abs(table[alive] - table[other]).max(axis=1, initial=0) <= most_bits
        a, b = alive[close], other[close]
        near = np.bitwise_count(values[a] ^ values[b]) <= most_bits
        left.append(a[near])
        right.append(b[near])
        shift += 1
    return np.concatenate([*left, np.empty(0, int)]), np.concatenate([*right, np.empty(0, int)])


def spanning_links(values: np.ndarray, table: np.ndarray, most_bits: int) -> list[tuple[int, int]]:
    """Links that connect a bucket as all its near pairs do.

    Searched from one fingerprint to the next: what a component has reached leaves the list of the
    rest, so a bucket of near copies is connected in few passes.
    """
    links: list[tuple[int, int]] = []
    rest = np.arange(len(values))
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            close = np.abs(table[rest] - table[at]).max(axis=1, initial=0) <= most_bits
            some = np.flatnonzero(close)
            near = some[np.bitwise_count(values[rest[some]] ^ values[at]) <= most_bits]
            if len(near):
                found = rest[near].tolist()
                links += [(at, other) for other in found]
                queue += found
                rest = np.delete(rest, near)
    return links


def near_links(
    distinct: DataFrame, most_bits: int = MOST_BITS, blocks: int = BLOCKS, part: int = PART
) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all near ones; a < b as longs."""
    pivots = pivots_of(distinct)
    keyed = stored(
        distinct.select("fingerprint", F.explode(bucket_keys(F.col("fingerprint"), blocks, most_bits)).alias("key"))
        .select("fingerprint", F.xxhash64("key.which", "key.bits").alias("key")),
        "simhash-keys",
    )
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A bucket of more than ``part`` fingerprints becomes all pairs (i, j) of its parts.
    sized = keyed.join(sizes, "key").withColumn("parts", F.ceil(F.col("n") / part).cast("int"))
    mine = F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("parts")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.least(mine, j) * F.col("parts") + F.greatest(mine, j),
    )
    dealt = (
        sized.select("key", "fingerprint", F.explode(cells).alias("cell"))
        .repartition("key", "cell")
        .sortWithinPartitions("key", "cell")
    )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "cell", "fingerprint")])
            kept.append(rows)
            # Whole buckets only; the last one may go on in the next batch.
            if (rows[:2, 0] != rows[:2, -1]).any() or (len(kept) > 1 and (kept[-2][:2, -1] != rows[:2, -1]).any()):
                rows = np.concatenate(kept, axis=1)
                cut = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0))[-1] + 1
                yield links_of(rows[:, :cut])
                kept = [rows[:, cut:]]
        if kept:
            yield links_of(np.concatenate(kept, axis=1))

    def links_of(rows: np.ndarray) -> pa.RecordBatch:
        values = np.ascontiguousarray(rows[2]).view(np.uint64)
        table = distance_table(values, pivots)
        change = np.concatenate(([True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)))
        starts = np.flatnonzero(change)
        sizes = np.diff(np.append(starts, len(values)))
        small = np.repeat(sizes <= 64, sizes)
        group = (np.cumsum(change) - 1)[small]
        places = np.flatnonzero(small)
        a, b = near_pairs_by_shift(group, values[small], table[small], most_bits)
        forest = _Forest(len(values))
        pairs = [(i, j) for i, j in zip(places[a].tolist(), places[b].tolist()) if forest.join(i, j)]
        for start, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
            own = slice(start, start + size)
            pairs += [(start + i, start + j) for i, j in spanning_links(values[own], table[own], most_bits)]
        ends = np.sort(rows[2][np.array(pairs, int).reshape(-1, 2)], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return dealt.mapInArrow(linked, "a long, b long").where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node -> root for the nodes of ``links``; the root is the least node of the component.

    Large-star and small-star steps alternate until the links are stars. Each step groups the
    neighbours of a node by a minimum and a join, so no task holds a node's neighbours.
    """
    links = stored(links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(), "links")
    while True:
        before = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        least = least.withColumn("least", F.least("node", "least"))
        # Large star: neighbours above a node go to the least of its neighbourhood.
        large = (
            both.where("root > node").join(least, "node")
            .select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()
        )
        large = stored(large, "links")
        # Small star: a node and its neighbours below go to the least of those.
        lowest = large.groupBy("node").agg(F.min("root").alias("least"))
        small = (
            large.join(lowest, "node")
            .select(F.explode(F.array(
                F.struct(F.col("node"), F.col("least").alias("root")),
                F.struct(F.col("root").alias("node"), F.col("least").alias("root")),
            )).alias("link"))
            .select("link.*").where("node != root").distinct()
        )
        links = stored(small, "links")
        after = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if before == after:
            return links


def _classes(prints: DataFrame, least: Column, most_bits: int, blocks: int = BLOCKS, part: int = PART) -> DataFrame:
    """fingerprint, root of its component, and the ``least`` of the rows with that fingerprint."""
    distinct = prints.groupBy("fingerprint").agg(F.min(least).alias("least"))
    distinct = stored(distinct, "distinct-fingerprints")
    roots = components(near_links(distinct, most_bits, blocks, part))
    return distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    size: int = SHINGLE,
    most_bits: int = MOST_BITS,
    blocks: int = BLOCKS,
    part: int = PART,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row.

    ``component_id`` is the least id reachable over links; null ids are reached, but only name a
    component without other ids. A null or blank text has fingerprint zero and is linked like any
    other. Texts shorter than a shingle are one shingle. Repeated rows each keep their row; an
    empty table gives no rows; other columns are ignored.
    """
    prints = stored(fingerprints(docs, text_col, id_col, size), "fingerprints")
    classes = _classes(prints, F.col("doc_id"), most_bits, blocks, part)
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(named, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    size: int = SHINGLE,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """One row of each component, with all its columns: the one with the least id.

    Null ids come after all others. Rows that share an id but not their text are rows of their
    own; of those in one component the digest of the text decides. Rows that repeat both id and
    text are one document and are dropped as well, but for one.
    """
    keyed = docs.select(row_key(id_col, text_col).alias("key"), text_of(text_col).alias("text"))
    prints = stored(fingerprints(keyed, "text", "key", size), "fingerprints")
    key = F.col("doc_id")
    order = F.struct(key["id"].isNull().alias("unnamed"), key["id"].alias("id"), key["digest"].alias("digest"))
    first = _classes(prints, order, most_bits).groupBy("root").agg(F.min("least").alias("least"))
    stay = unused(docs, "stay")
    winners = first.select(F.struct(F.col("least.id").alias("id"), F.col("least.digest").alias("digest")).alias(stay))
    # Copies meet map-side first, so a row that is repeated often does not land in one task.
    named = docs.withColumn(unused(docs, "named"), row_key(id_col, text_col))
    once = named.dropDuplicates([named.columns[-1]])
    return once.join(winners, F.col(named.columns[-1]) == F.col(stay), "left_semi").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
