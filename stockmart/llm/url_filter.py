"""URL filter: host and path rules, and a character language-model ratio for the rest.

Two variable-order Markov models are counted from the addresses that the rules accept and reject.
The probability of a character after its context is interpolated over all context lengths with
Witten-Bell weights: P_k(c | h) = (N(hc) + T(h) P_{k-1}(c | h')) / (N(h) + T(h)), where T(h) is the
number of different characters seen after h, and P_{-1} = 1/256. An address scores the mean over
its characters of the log ratio of the two models, so long and short addresses compare. The
threshold is calibrated on labelled addresses that the models have not counted: it lies as many
standard deviations above the mean of the rejected as below the mean of the accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockmart.llm.common import UPPER, stored

#: Fixed values of the contract: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDER = 4
START, END = "\u0002", "\u0003"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both are empty for null and where there is no ``://``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host = F.regexp_extract(url, PARTS, 1)
    return pages.withColumns(
        {"host": F.translate(host, UPPER, UPPER.lower()), "path": F.regexp_extract(url, PARTS, 2)}
    )


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def grams(addresses: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per character of ``host || path`` and the end mark, with its context before it."""
    text = F.concat(F.lit(START * order), "host", "path", F.lit(END))
    return addresses.withColumn("padded", text).select(
        "*",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("padded") - order),
                lambda i: F.substring(F.col("padded"), i, F.lit(order + 1)),
            )
        ).alias("gram"),
    ).drop("padded")


def model_ratio(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """gram -> log ratio of the accepted and the rejected model, for all grams in ``counts``.

    ``counts`` has (gram, a, b): how often the gram occurs in accepted and rejected addresses.
    """
    below = None
    for k in range(order + 1):
        level = (
            counts.groupBy(F.substring("gram", order - k + 1, k + 1).alias("gram"))
            .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        )
        context = Window.partitionBy(F.substring("gram", 1, k))
        level = level.select(
            "gram", "a", "b",
            *[F.sum(x).over(context).cast("double").alias(f"n_{x}") for x in "ab"],
            *[F.sum(F.when(F.col(x) > 0, 1).otherwise(0)).over(context).cast("double").alias(f"t_{x}") for x in "ab"],
        )
        if below is None:
            level = level.withColumns({"p_a": F.lit(1 / 256), "p_b": F.lit(1 / 256)})
        else:
            level = level.withColumn("short", F.substring("gram", 2, k)).join(below, "short")
        below = level.select(
            F.col("gram").alias("short"),
            *[
                F.when(
                    F.col(f"n_{x}") + F.col(f"t_{x}") > 0,
                    (F.col(x) + F.col(f"t_{x}") * F.col(f"p_{x}")) / (F.col(f"n_{x}") + F.col(f"t_{x}")),
                ).otherwise(F.col(f"p_{x}")).alias(f"p_{x}")
                for x in "ab"
            ],
        )
    return below.select(F.col("short").alias("gram"), (F.log("p_a") - F.log("p_b")).alias("ratio"))


def _held_back(labelled: DataFrame) -> Column:
    """Every fourth address or so, by a digest of host and path: for the calibration only."""
    return F.substring(F.md5(F.concat("host", "path")), 1, 1).isin("0", "1", "2", "3")


def judge(
    pages: DataFrame, url_col: str = "url", id_col: str = "page_id", rules=RULES, order: int = ORDER
) -> DataFrame:
    """page_id, host, path, rule, verdict and score of each page row.

    Equal (host, path) are scored once, weighted by how often they occur. A null url, or one
    without ``://``, has empty host and path; its one character is the end mark. If the rules
    leave nothing to learn from on one side, the threshold is zero and ties are allowed. Repeated
    rows each keep their row; other columns are ignored.
    """
    rows = with_parts(pages, url_col).select(F.col(id_col).alias("page_id"), "host", "path")
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    addresses = stored(
        rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"rule": rule, "said": verdict}),
        "addresses",
    )
    seen = addresses.withColumns({
        "a": F.when((F.col("said") == "allow") & ~_held_back(addresses), F.col("n")).otherwise(0),
        "b": F.when((F.col("said") == "block") & ~_held_back(addresses), F.col("n")).otherwise(0),
    })
    counts = stored(
        grams(seen, order).groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "gram-counts"
    )
    ratios = stored(model_ratio(counts, order), "gram-ratios")
    scored = stored(
        grams(addresses, order).join(ratios, "gram")
        .groupBy("host", "path", "rule", "said", "n")
        .agg((F.sum("ratio") / F.count(F.lit(1))).alias("score")),
        "url-scores",
    )
    limit = threshold(scored)
    judged = scored.withColumn(
        "verdict", F.coalesce("said", F.when(F.col("score") >= limit, "allow").otherwise("block"))
    )
    return rows.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "score")


def threshold(scored: DataFrame) -> float:
    """Calibrated on the held-back labelled addresses; one row comes to the driver."""
    held = scored.where(F.col("said").isNotNull() & _held_back(scored))
    sums = held.groupBy("said").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("score")).alias("s"),
        F.sum(F.col("n") * F.col("score") * F.col("score")).alias("q"),
    )
    by = {r["said"]: r for r in sums.collect()}
    if len(by) < 2:
        return 0.0
    mean = {k: r["s"] / r["n"] for k, r in by.items()}
    spread = {k: max(r["q"] / r["n"] - mean[k] ** 2, 0.0) ** 0.5 for k, r in by.items()}
    total = spread["allow"] + spread["block"]
    if total == 0.0:
        return (mean["allow"] + mean["block"]) / 2
    return (mean["allow"] * spread["block"] + mean["block"] * spread["allow"]) / total


def keep_accepted(pages: DataFrame, url_col: str = "url", id_col: str = "page_id", rules=RULES) -> DataFrame:
    """The page rows whose verdict is ``allow``, with all their columns."""
    verdicts = judge(pages, url_col, id_col, rules).where("verdict = 'allow'")
    good = verdicts.select(F.col("host").alias("good_host"), F.col("path").alias("good_path")).distinct()
    parts = with_parts(pages.select(F.struct("*").alias("row"), F.col(url_col).alias("_url")), "_url")
    same = (F.col("host") == F.col("good_host")) & (F.col("path") == F.col("good_path"))
    return parts.join(good, same, "left_semi").select("row.*")
