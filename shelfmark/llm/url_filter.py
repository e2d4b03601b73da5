"""URL filter by rules and by a character language-model ratio.

Rules decide the URLs that they fit. All other URLs get the verdict of two variable-order
Markov models over characters, one learned from URLs that the rules allow, one from those that
they block: the mean difference of the log-probabilities per character is compared with a
threshold calibrated on a fifth of the rule-judged URLs that the models did not see.

Only DataFrame functions. A model has at most ``len(SYMBOLS) ** 4`` (about 3.1 million) rows
whatever the input, since URLs are first folded to a fixed alphabet; that bound is why its
table may be broadcast. Counting has map-side combine, so a host with a third of all pages is
no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What URLs are folded to: digits are 0, any other character is *, ^ and ! mark the ends.
SYMBOLS = LOWER + "0" + "-._/?#=&:%+@" + "*^!"
ORDER = 3  # characters of context at most
BINS = 100  # score bins per natural-log unit in the calibration

#: (verdict, rule): a host and the start of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for URLs without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        cut = text.index("/")
        own, start = text[:cut].lower(), text[cut:]
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def grams(url: Column) -> Column:
    """Each character of the folded URL behind its context, as text of ORDER + 1 symbols."""
    folded = F.regexp_replace(F.translate(lower_ascii(url), "123456789", "000000000"), r"[^a-z0\-._/?#=&:%+@]", "*")
    padded = F.concat(F.lit("^" * ORDER), folded, F.lit("!"))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - ORDER), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))


def log_ratios(counts: DataFrame) -> DataFrame:
    """gram, log P(last symbol | context) of the allow model less that of the block model.

    ``counts``: gram, allow, block (how often the training URLs of each class have it), with a
    row for every gram to be scored. Witten-Bell smoothing: each order is mixed with the next
    shorter one by the number of different symbols seen in its context; the shortest is mixed
    with the uniform distribution.
    """
    sides = ("allow", "block")
    out = counts.select("gram", *[F.lit(1.0 / len(SYMBOLS)).alias(f"p_{s}") for s in sides])
    for k in range(ORDER + 1):
        tail = F.substring("gram", ORDER + 1 - k, k + 1)
        here = counts.groupBy(tail.alias("tail")).agg(*[F.sum(s).alias(s) for s in sides])
        before = here.groupBy(F.substring("tail", 1, k).alias("context")).agg(
            *[F.sum(s).alias(f"n_{s}") for s in sides],
            *[F.count(F.when(F.col(s) > 0, 1)).alias(f"kinds_{s}") for s in sides])
        here = here.withColumn("context", F.substring("tail", 1, k)).join(before, "context").drop("context")
        out = out.withColumn("tail", tail).join(here, "tail").select("gram", *[
            F.when(F.col(f"n_{s}") > 0, (F.col(s) + F.col(f"kinds_{s}") * F.col(f"p_{s}")) / (F.col(f"n_{s}") + F.col(f"kinds_{s}")))
            .otherwise(F.col(f"p_{s}")).alias(f"p_{s}") for s in sides])
    return out.select("gram", F.log(F.col("p_allow") / F.col("p_block")).alias("ratio"))


def calibrated(scored: DataFrame) -> float:
    """The threshold with the best mean of both classes' hit rates on rule-judged URLs.

    The middle of the best stretch; minus infinity, so that all are allowed, without URLs of
    both classes. Scores are counted by bins of 1 / BINS, so the driver gets a bounded table.
    """
    bins = scored.groupBy(F.floor(F.greatest(F.least(F.col("score"), F.lit(20.0)), F.lit(-20.0)) * BINS).alias("bin")).agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("allow"), F.count(F.when(F.col("verdict") == "block", 1)).alias("block")).collect()
    allow, block = sum(r.allow for r in bins), sum(r.block for r in bins)
    if not allow or not block:
        return float("-inf")
    best, below, ends = -1.0, [0, 0], []
    bins = sorted(bins)
    for r, following in zip(bins, [*bins[1:], None]):
        below = [below[0] + r.allow, below[1] + r.block]
        hits = (1 - below[0] / allow) + below[1] / block
        if hits > best + 1e-12:
            best, ends = hits, [r.bin + 1, following.bin if following else r.bin + 1]
    return sum(ends) / 2 / BINS


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), score (null where a rule decided).

    One row for each input row. A null or empty URL has empty host and path and, as there is
    nothing to score but the end mark, is scored like any other. Without rule-judged URLs of
    both kinds nothing can be learned and URLs without rule are allowed. Other columns of
    ``pages`` are not read.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = url_parts(url)
    parts = pages.select("page_id", url.alias("_url"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = parts.select("*", rule.alias("rule"), verdict.alias("verdict"), (F.pmod(F.xxhash64("_url"), F.lit(5)) == 0).alias("_held"))

    learns = F.col("verdict").isNotNull() & ~F.col("_held")
    counts = judged.select("verdict", learns.alias("learns"), F.explode(grams(F.col("_url"))).alias("gram")).groupBy("gram").agg(
        *[F.count(F.when(F.col("learns") & (F.col("verdict") == s), 1)).alias(s) for s in ("allow", "block")])
    model = keep(log_ratios(keep(counts, "url-counts")), "url-model")

    def scored(rows: DataFrame) -> DataFrame:
        # a row number that any rerun of a task gives again; sums are combined before the shuffle
        rows = rows.withColumn("_row", F.monotonically_increasing_id())
        return (rows.select("*", F.explode(grams(F.col("_url"))).alias("gram"))
                .join(F.broadcast(model), "gram")
                .groupBy(*rows.columns).agg(F.avg("ratio").alias("score")).drop("_row"))

    threshold = calibrated(scored(judged.where(F.col("rule").isNotNull() & F.col("_held"))))
    by_model = scored(judged.where(F.col("rule").isNull())).withColumn(
        "verdict", F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block"))
    columns = ["page_id", "host", "path", "rule", "verdict", "score"]
    return judged.where(F.col("rule").isNotNull()).withColumn("score", F.lit(None).cast("double")).select(columns).unionByName(by_model.select(columns))
