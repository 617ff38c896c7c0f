"""Benchmark decontamination over a positional inverted index of the training texts.

``build_index`` stores the postings (term, document, position) of all benchmark terms, and the
word count of every document. ``find_phrases`` picks the two rarest terms of each item window by
the index's own document frequencies, shifts their postings by the term's place in the item, and
keeps the alignments where the shifted lists meet. ``find_hits`` compares the aligned words and
returns the exact phrase matches; ``near_hits`` returns the proximity matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockmart.llm.common import lower_ascii, row_key, stored, text_of, unused

#: Words before A-Z are lower-cased: A-Z belong to them.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10


def raw_words(text_col: str) -> Column:
    return F.regexp_extract_all(text_of(text_col), F.lit(WORD), F.lit(0))


def words_of(text_col: str) -> Column:
    return F.transform(raw_words(text_col), lower_ascii)


def item_words(items: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """key, item (as a string) and its words; rows that repeat an id with another text are items too.

    Keys stand for items while lists are intersected. If two items ever shared one, both would be
    compared with the texts afterwards, so nothing would be lost or made up.
    """
    named = items.select(F.col(item_col).cast("string").alias("item"), words_of(text_col).alias("words"))
    return named.where(F.size("words") > 0).distinct().withColumn("key", F.xxhash64("item", "words"))


def item_terms(items: DataFrame) -> DataFrame:
    return items.select("key", F.size("words").alias("size"), F.posexplode("words").alias("place", "term"))


def build_index(
    docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Stored postings (doc, term, pos) of the terms that occur in ``items``.

    Each document also has one row without a term, whose ``pos`` is its number of words.
    """
    terms = item_terms(items).select("term").distinct().withColumn("known", F.lit(True))
    places = docs.select(
        row_key(id_col, text_col).alias("doc"),
        F.posexplode(F.concat(raw_words(text_col), F.array(F.lit(None).cast("string"))))
        .alias("pos", "word"),
    ).select("doc", "pos", lower_ascii(F.col("word")).alias("term"))
    postings = (
        places.join(terms, "term", "left")
        .where(F.col("term").isNull() | F.col("known"))
        .select("doc", "term", "pos")
    )
    return stored(postings, "postings")


def rare_places(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The places in the items whose terms are one of the two rarest of some window.

    ``need`` is the number of such places that an alignment must meet: two, or one where the whole
    item is one word. Windows with a term that the index lacks can't occur and are left out.
    """
    frequency = index.where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    size = F.col("size")
    places = item_terms(items).join(frequency, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    first = F.greatest(F.lit(0), F.col("place") - window + 1)
    last = F.greatest(F.lit(0), F.least(F.col("place"), size - window))
    in_windows = places.withColumn("start", F.explode(F.sequence(first, last)))
    by_window = Window.partitionBy("key", "start")
    return (
        in_windows.withColumn("least", F.min("n").over(by_window))
        .withColumn("rank", F.row_number().over(by_window.orderBy("n", "place")))
        .where("least > 0 and rank <= 2")
        .select("key", "place", "term", F.least(F.lit(2), size).alias("need"))
        .distinct()
    )


def find_phrases(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Alignments (doc, item, words, shift) where the shifted lists of rare terms meet."""
    places = stored(rare_places(index, items, window), "rare-places")
    rare = places.select("term").distinct()
    return (
        index.where("term is not null")
        # Spark sends the rare terms to all tasks where they are few enough; then only their
        # postings are dealt out.
        .join(rare, "term", "left_semi")
        .join(places, "term")
        .select("doc", "key", "need", (F.col("pos") - F.col("place")).alias("shift"))
        .groupBy("doc", "key", "need", "shift")
        .agg(F.count(F.lit(1)).alias("met"))
        .where("met >= need")
        .join(items, "key")
        .select("doc", "item", "words", "shift")
    )


def _spans(a: Column, words: Column, window: int) -> Column:
    """Runs of equal words, as long as a window at least, of one alignment with a document."""
    n = F.size(a["words"])
    equal = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.when(
            F.get(words, a["shift"] + i) == F.get(a["words"], i), F.lit("1")
        ).otherwise(F.lit("0")),
    )
    start = F.struct(
        a["shift"].alias("at"),
        F.array().cast("array<struct<start:int,end:int,item:string>>").alias("spans"),
    )

    def step(acc: Column, run: Column) -> Column:
        size = F.length(run).cast("int")
        span = F.struct(acc["at"].alias("start"), (acc["at"] + size).alias("end"), a["item"].alias("item"))
        spans = F.when(
            size >= F.least(F.lit(window), n), F.concat(acc["spans"], F.array(span))
        ).otherwise(acc["spans"])
        return F.struct((acc["at"] + size + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(F.split(F.array_join(equal, ""), "0", -1), start, step)["spans"]


def find_hits(
    docs: DataFrame,
    found: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    window: int = WINDOW,
) -> DataFrame:
    """Exact phrase matches: per document with any, its ``spans`` of (start, end, item)."""
    aligned = found.groupBy("doc").agg(
        F.collect_list(F.struct("item", "words", "shift")).alias("aligned")
    )
    texts = docs.select(row_key(id_col, text_col).alias("doc"), text_of(text_col).alias("text"))
    # A repeated row has the same hits, so one of each is enough.
    rows = texts.join(aligned, "doc").select(
        "doc", "aligned",
        # As an exploded row the words are made once; as a mere column they would be inlined into
        # the comparison of every single place.
        F.explode(F.array(words_of("text"))).alias("doc_words"),
    )
    spans = F.flatten(F.transform("aligned", lambda a: _spans(a, F.col("doc_words"), window)))
    return rows.select("doc", F.array_sort(spans).alias("spans")).where(F.size("spans") > 0)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_col: str = "item_id",
    window: int = WINDOW,
) -> DataFrame:
    """For each document row: n_words, n_hit, n_items, items (their ids as sorted strings).

    Null texts have no words; items without words occur nowhere; items shorter than the window
    are one window. Repeated rows each get their row of the result. Null ids stay as they are, and
    a null item id counts as an item without a name in ``n_items`` only. Empty tables give no
    rows, or rows without hits. Other columns are ignored.
    """
    items = item_words(benchmark, text_col, item_col)
    index = build_index(docs, items, text_col, id_col)
    hits = find_hits(docs, find_phrases(index, items, window), text_col, id_col, window).dropDuplicates(["doc"])
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["start"]))).alias("n"),
        ),
    )["n"]
    names = F.array_distinct(F.transform("spans", lambda s: s["item"]))
    hits = hits.select(
        "doc",
        covered.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.array_sort(F.array_compact(names)).alias("items"),
    )
    counts = index.where("term is null").select("doc", F.col("pos").cast("bigint").alias("n_words"))
    return counts.join(hits, "doc", "left").select(
        F.col("doc.id").alias("doc_id"),
        "doc",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def start_places(index: DataFrame, items: DataFrame, share: float) -> DataFrame:
    """The rarest places of each item, as many as a match of ``share`` of its places can't all miss."""
    frequency = index.where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    places = item_terms(items).join(frequency, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("n", "place"))
    return (
        places.withColumn("rank", rank)
        .where(F.col("rank") <= F.col("size") - F.ceil(F.lit(share) * F.col("size")) + 1)
        .select("key", "place", "term")
    )


def near_hits(
    index: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = 4, share: float = 0.8
) -> DataFrame:
    """Proximity matches (doc, item, zone, met): places near one alignment, with words between.

    Alignments whose shifts differ by up to ``slack`` count as one zone; zones overlap, so that no
    neighbours are parted. A zone matches where ``share`` of the item's places are met inside it.
    At most m - ceil(share * m) of m places are missed, so a match meets one at least of the rarest
    m - ceil(share * m) + 1: zones of those are where the search starts. Whether the corpus has the
    other words, or any exact window, does not matter.
    """
    places = start_places(index, items, share)
    shift = F.col("pos") - F.col("place")
    zone = F.explode(F.array(F.floor(shift / (2 * slack)), F.floor((shift + slack) / (2 * slack)) + 0.5))
    near = lambda rows: (
        index.where("term is not null").join(rows, "term").select("doc", "key", "place", zone.alias("zone"))
    )
    started = near(places).select("doc", "key", "zone").distinct()
    return (
        near(item_terms(items))
        .join(started, ["doc", "key", "zone"], "left_semi")
        .groupBy("doc", "key", "zone")
        .agg(F.countDistinct("place").alias("met"))
        .join(items, "key")
        .where(F.col("met") >= share * F.size("words"))
        .select("doc", "item", "zone", "met")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW
) -> DataFrame:
    """The document rows without any exact phrase match, with all their columns."""
    items = item_words(benchmark)
    index = build_index(docs, items, text_col, id_col)
    hits = find_hits(docs, find_phrases(index, items, window), text_col, id_col, window)
    hit = unused(docs, "hit")
    bad = hits.select(F.col("doc").alias(hit)).distinct()
    return docs.join(bad, row_key(id_col, text_col) == F.col(hit), "left_anti")
