"""URL filter: allow and block rules, and a ratio of two character language models for what no rule decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, stage

#: Characters the models tell apart; digits are one, every other character is `~`. With the marks for begin and end
#: there are 39, so a model of order k has at most 39 ** (k + 1) grams whatever the input: at order 3, 2.3 million.
KNOWN = "abcdefghijklmnopqrstuvwxyz0./-_?=&#%~"
ALPHABET = len(KNOWN) + 2
#: Weight of the next lower order in a smoothed probability, as a count.
BACK_OFF = 2.0
#: Steps of the threshold that is calibrated, in nats a character.
STEP = 0.01


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls. A rule is host and path prefix, as `org/`."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))

    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        inside = (host == name) | host.endswith("." + name)
        return inside & path.startswith(slash + rest)

    def first(value):
        return F.coalesce(*[F.when(fits(r), F.lit(value(r, v))) for r, v in ordered], F.lit(None).cast("string"))

    return first(lambda r, v: r), first(lambda r, v: v)


def characters(url: Column) -> Column:
    """What the models read: the lower-cased url behind its scheme, in the known characters."""
    rest = ascii_lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^(?s:.*?)://", ""))
    return F.regexp_replace(F.translate(rest, "123456789", "000000000"), r"[^a-z0./\-_?=&#%]", "~")


def grams(texts: DataFrame, order: int) -> DataFrame:
    """One row per character and one for the end: the character behind up to `order` characters before it."""
    padded = F.concat(F.lit("^" * order), F.col("chars"), F.lit("$"))
    at = F.sequence(F.lit(1), F.length("chars") + 1)
    return texts.withColumn("gram", F.explode(F.transform(at, lambda k: F.substring(padded, k, F.lit(order + 1)))))


def smoothed(counts: DataFrame, wanted: DataFrame, order: int, name: str) -> DataFrame:
    """log P(last character | those before it) of every wanted gram.

    The orders are interpolated: what a context of k characters says is weighted by how often it was seen, and the
    rest comes from the context of k - 1 characters. A context that was never seen leaves it all to the shorter one.
    """
    out = wanted.withColumn(name, F.lit(1.0 / ALPHABET))
    for k in range(order + 1):
        tail, context = F.expr(f"right(gram, {k + 1})"), F.expr(f"substring(right(gram, {k + 1}), 1, {k})")
        of_gram = counts.groupBy(tail.alias("tail")).agg(F.sum("n").alias("n_gram"))
        of_context = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("n_context"))
        seen = F.coalesce("n_gram", F.lit(0)) + F.lit(BACK_OFF) * F.col(name)
        out = (
            out.withColumns({"tail": tail, "context": context})
            .join(of_gram, "tail", "left")
            .join(of_context, "context", "left")
            .withColumn(name, seen / (F.coalesce("n_context", F.lit(0)) + F.lit(BACK_OFF)))
            .drop("tail", "context", "n_gram", "n_context")
        )
    return out.withColumn(name, F.log(name))


def gram_ratios(labelled: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """Log ratio of the accepted over the rejected model for every gram in `wanted`.

    labelled: chars, accepted (boolean). Both results have at most ALPHABET ** (order + 1) rows.
    """
    counts = stage(grams(labelled, order).groupBy("accepted", "gram").agg(F.count(F.lit(1)).alias("n")), "gram-counts")
    out = smoothed(counts.where("accepted"), wanted, order, "log_accepted")
    out = smoothed(counts.where("not accepted"), out, order, "log_rejected")
    return out.select("gram", (F.col("log_accepted") - F.col("log_rejected")).alias("ratio"))


def scored(texts: DataFrame, ratios: DataFrame, order: int, keys: Sequence[str]) -> DataFrame:
    """keys, score: mean log ratio of a text's characters.

    The table of ratios is broadcast: its size is bound by the alphabet and does not follow the input.
    """
    each = grams(texts.select(*keys, "chars"), order).join(F.broadcast(ratios), "gram", "left")
    return each.groupBy(*keys).agg(F.avg(F.coalesce("ratio", F.lit(0.0))).alias("score"))


def calibrated_threshold(scores: DataFrame) -> float:
    """The score that best parts accepted from rejected: most of true accepts plus true rejects, each as a share.

    Reads counts in steps of STEP between -10 and 10, at most 2,001 rows. It lies in the middle between the steps that
    it parts; of equal cuts the lowest is taken; with rows of one kind only the threshold is 0.
    """
    step = F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.col("score"))) / STEP
    bins = scores.groupBy(F.floor(step).alias("step")).agg(
        F.sum(F.when(F.col("accepted"), 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("accepted"), 0).otherwise(1)).alias("bad"),
    )
    rows = sorted(bins.collect())
    good, bad = sum(r.good for r in rows), sum(r.bad for r in rows)
    if not good or not bad:
        return 0.0
    best, threshold, below_good, below_bad, last = -1.0, 0.0, 0, 0, rows[0].step
    for r in rows:
        share = (good - below_good) / good + below_bad / bad
        if share > best:
            best, threshold = share, (last + r.step) / 2 * STEP
        below_good, below_bad, last = below_good + r.good, below_bad + r.bad, r.step + 1
    return threshold


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    order: int = 3,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict (allow or block), score.

    Rules decide first. The urls that rules allow and block are the examples of two character models; the threshold is
    calibrated on half of the examples with models that were counted on the other half (by a hash of the url), then
    both models are counted on all of them. A url that no rule decides is allowed from the threshold on.

    Null urls and urls without `://` have an empty host and path; a null or empty url scores 0. Without examples of
    both kinds every score is judged against 0, which allows. Repeated rows and null ids keep a row each; other columns
    are ignored.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    rows = stage(
        rows.withColumns({"rule": rule, "said": said, "chars": characters(F.col("url"))}).drop("url"), "urls"
    )
    # equal texts score equally: each is scored once
    texts = stage(rows.select("chars").distinct(), "url-texts")
    wanted = stage(grams(texts, order).select("gram").distinct(), "grams")
    labelled = rows.where("said is not null").select("chars", (F.col("said") == "allow").alias("accepted"))
    half = F.conv(F.substring(F.md5("chars"), 1, 8), 16, 10).cast("long") % 2

    trial = scored(
        labelled.where(half == 1), stage(gram_ratios(labelled.where(half == 0), wanted, order), "trial"), order,
        ["chars", "accepted"],
    )
    threshold = calibrated_threshold(trial)
    ratios = stage(gram_ratios(labelled, wanted, order), "ratios")
    scores = stage(scored(texts.where("chars != ''"), ratios, order, ["chars"]), "url-scores")
    score = F.coalesce("score", F.lit(0.0))
    judged = F.when(score >= threshold, "allow").otherwise("block")
    return rows.join(scores, "chars", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("said", judged).alias("verdict"), score.alias("score")
    )
