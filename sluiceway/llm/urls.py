"""URL filter: rules first, then the ratio of two character language models.

Urls that a rule allows or blocks are the corpora of two variable-order Markov models over characters. Each model's
probability of a character mixes the orders from none to `ORDER` characters of context, each order weighted by how often
its context was seen against how many different characters followed it (Witten-Bell). A url's score is the mean over
its characters of the logarithm of accepted over rejected probability. Models learn from four fifths of the judged urls,
by a checksum of the text; the threshold is the one that tells the other fifth apart best.

Counts, models and scores are tables: counting is a sum over all urls of the corpora, and a url is scored by a join of
its character sequences with the table of their ratios.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import staged

ORDER = 4
# Marks in front of the first and after the last character; neither can be in a url.
START, END = "\x02", "\x03"
# Scores are compared with the threshold by steps of this size.
STEP = 0.005
# One of so many different urls is held out of the models, to set the threshold by.
HELD_OUT = 5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], what) -> Column:
    """`what` of the longest rule that fits; NULL if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(what(rule))).otherwise(found)
    return found


def _grams(texts: DataFrame) -> DataFrame:
    """Each character of a text with the `ORDER` characters before it."""
    padded = F.concat(F.lit(START * ORDER), "text", F.lit(END))
    places = F.sequence(F.lit(1), F.length("text") + 1)
    return texts.select(
        "*", F.explode(F.transform(places, lambda i: F.substring(padded, i, F.lit(ORDER + 1)))).alias("gram")
    )


def _ratios(counts: DataFrame) -> DataFrame:
    """Logarithm of the accepted over the rejected probability of each gram's last character: (gram, ratio)."""
    sums = [F.sum(c).alias(c) for c in ("yes", "no")]
    # The unseen character counts as one more; every character is as likely without any context.
    letters = counts.agg(F.count_distinct(F.substring("gram", -1, 1))).first()[0] + 1
    below = None
    for order in range(ORDER + 1):
        rows = (
            counts.groupBy(F.right("gram", F.lit(order + 1)).alias("gram")).agg(*sums)
            if order < ORDER
            else counts.select("gram", "yes", "no")
        )
        of = F.substring("gram", 1, order) if order else F.lit("")
        rows = rows.withColumn("before", of)
        totals = rows.groupBy(F.col("before").alias("context")).agg(
            *[F.sum(c).cast("double").alias(f"all_{c}") for c in ("yes", "no")],
            *[F.count(F.when(F.col(c) > 0, 1)).cast("double").alias(f"kinds_{c}") for c in ("yes", "no")],
        )
        rows = rows.join(totals, F.col("before") == F.col("context"))
        if below is None:
            rows = rows.select("*", *[F.lit(1 / letters).alias(f"low_{c}") for c in ("yes", "no")])
        else:
            rows = rows.join(below, F.right("gram", F.lit(order)) == F.col("shorter"))
        share = {
            c: F.when(
                F.col(f"all_{c}") > 0,
                (F.col(c) + F.col(f"kinds_{c}") * F.col(f"low_{c}")) / (F.col(f"all_{c}") + F.col(f"kinds_{c}")),
            ).otherwise(F.col(f"low_{c}"))
            for c in ("yes", "no")
        }
        below = staged(rows.select(F.col("gram").alias("shorter"), *[s.alias(f"low_{c}") for c, s in share.items()]), "order")
    return below.select(F.col("shorter").alias("gram"), F.log(F.col("low_yes") / F.col("low_no")).alias("ratio"))


def threshold_of(scored: DataFrame) -> DataFrame:
    """One row (threshold): the step with the best mean of allowed urls at or above it and blocked urls below it.

    NULL unless both kinds exist. Of steps with equal means, the lowest.
    """
    bins = (
        scored.where("known is not null")
        .groupBy(F.floor(F.col("score") / STEP).alias("bin"))
        .agg(*[F.sum(F.when(F.col("known") == v, F.col("rows")).otherwise(0)).alias(v) for v in ("allow", "block")])
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lost, caught = [
        F.coalesce(F.sum(v).over(below), F.lit(0)) / F.nullif(F.sum(v).over(whole), F.lit(0)) for v in ("allow", "block")
    ]
    return (
        bins.select("bin", (caught - lost).alias("gain"))
        .where("gain is not null")
        .agg(F.max(F.struct("gain", (-F.col("bin")).alias("low"))).alias("best"))
        .select((-F.col("best.low")).alias("threshold"))
    )


def judged_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row (key, url, host, path, rule, verdict, score) per row of `pages`.

    The verdict is the longest fitting rule's, else the models': allow at or above the threshold. Where the rules allow
    no url at all or block none, there is nothing to compare, and the verdict is allow; where only the urls held out lack
    one of both, all judged urls set the threshold. A NULL url is scored as an empty
    text, has empty host and path and fits no rule. Repeated rows get equal results; other columns are ignored; an empty
    table gives an empty result.
    """
    link = F.col(url).cast("string")
    rows = pages.select(F.col(key).alias("key"), link.alias("url")).select(
        "key",
        "url",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.coalesce(F.regexp_replace("url", r"(?s)^.*?://", ""), F.lit("")).alias("text"),
    )
    ruled = [rule_of(F.col("host"), F.col("path"), rules, what) for what in (lambda r: r.name, lambda r: r.verdict)]
    rows = rows.select("*", ruled[0].alias("rule"), ruled[1].alias("known"))
    # Equal texts are scored once. A text may have urls with and without a rule, since a text leaves the scheme out.
    held = F.crc32(F.col("text").cast("binary")) % HELD_OUT == 0
    texts = staged(rows.groupBy("text", "known").agg(F.count(F.lit(1)).alias("rows")).withColumn("held", held), "texts")
    counts = staged(
        _grams(texts).groupBy("gram").agg(
            *[F.sum(F.when((F.col("known") == v) & ~F.col("held"), F.col("rows")).otherwise(0)).alias(c) for c, v in (("yes", "allow"), ("no", "block"))]
        ),
        "grams",
    )
    ratios = staged(_ratios(counts), "ratios")
    # Characters of a text are joined with their ratios; sequences that all urls share are hot, and adaptive joins split them.
    occurring = _grams(texts.select("text").distinct())
    scores = staged(
        occurring.join(ratios, "gram").groupBy("text").agg(F.avg("ratio").alias("score")), "scores"
    )
    scored = texts.join(scores, "text")
    level = threshold_of(scored.where("held")).first()
    if level is None or level.threshold is None:
        level = threshold_of(scored).first()
    allowed = F.lit(True) if level is None or level.threshold is None else F.floor(F.col("score") / STEP) >= level.threshold
    return (
        rows.join(scores.withColumnRenamed("text", "of"), F.col("text") == F.col("of"))
        .select("key", "url", "host", "path", "rule", F.coalesce("known", F.when(allowed, "allow").otherwise("block")).alias("verdict"), "score")
    )


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return judged.select(F.col("key").alias("page_id"), "host", "path", "rule", "verdict", "score")
