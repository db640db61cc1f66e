"""URL filter: host and path rules, and a character language-model ratio for the rest.

URLs that a rule allows or blocks train two variable-order Markov models over characters: what follows ``ORDER``
characters, each order smoothed with the next shorter one by the number of different continuations (Witten-Bell).
The characters are those of the URLs, in any script; the counts are tables of grams that grow with the corpus.  A URL's
score is the mean difference of the two models' log-likelihoods over its characters.  A part of the labelled URLs, chosen
by digest, is held out of the models; the limit between accepted and rejected URLs is calibrated on these.

Shorter orders are summed up from the longest, and every gram joins the one without its first character, so no key of these
joins has more rows than there are characters.  Grams that are more than one in ``HOT`` of all windows, at most
``HOT`` of them, are broadcast; all others join by shuffle, where none of them is a large key.
Log-likelihoods are kept as whole billionths, so sums do not depend on order.

Cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is judged
by the models like the empty string; if one side has no held-out URL, all URLs without a rule are allowed;
repeated rows are judged alike; new columns sit beside a struct of the page, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clauselens.llm.common import stored

# fixed values: (host, path, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\x02", "\x03"
ORDER = 5
# the share of a character that was never seen, before smoothing
UNSEEN = 1 / 65_536
# digests of held-out URLs begin with one of these
HELD_OUT = "012"
HOT = 4096
SCALE = 1_000_000_000
VERDICTS = ("allow", "block")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]], part: str) -> Column:
    """The longest rule that fits (``part`` = rule), or its verdict; null without one."""
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for h, p, _ in longest]
    values = [F.lit(f"{h}{p}" if part == "rule" else v) for h, p, v in longest]
    return F.coalesce(*[F.when(f, v) for f, v in zip(fits, values)])


def spelled(host: Column, path: Column) -> Column:
    """Host and path behind start signs for the longest context, and an end sign."""
    return F.concat(F.lit(START * ORDER), host, path, F.lit(END))


def grams(text: Column) -> Column:
    """All stretches of ``ORDER`` characters and the next one."""
    return F.transform(F.sequence(F.lit(1), F.length(text) - ORDER), lambda i: F.substr(text, i, F.lit(ORDER + 1)))


def smoothed(count: Column, kinds: Column, total: Column, shorter: Column) -> Column:
    """Witten-Bell: the share of the shorter context is that of its different continuations."""
    return F.when(total > 0, (count + kinds * shorter) / (total + kinds)).otherwise(shorter)


def model_table(counts: DataFrame) -> DataFrame:
    """(gram, diff) from (gram, allow, block): accepted minus rejected log-likelihood of a gram's last character."""
    orders = [counts]
    for _ in range(ORDER):
        orders.append(orders[-1].groupBy(F.substr("gram", F.lit(2)).alias("gram")).agg(*[F.sum(v).alias(v) for v in VERDICTS]))
    shares = None
    for order, table in enumerate(reversed(orders)):
        if order == 0:
            sums = table.groupBy().agg(*[f(v).alias(f"{n}_{v}") for v in VERDICTS for n, f in (
                ("total", F.sum), ("kinds", lambda c: F.count_if(F.col(c) > 0)))])
            rated = table.join(F.broadcast(sums))  # one row
        else:
            context = Window.partitionBy(F.substr("gram", F.lit(1), F.lit(order)))
            rated = table.withColumns({f"total_{v}": F.sum(v).over(context) for v in VERDICTS} | {
                f"kinds_{v}": F.count_if(F.col(v) > 0).over(context) for v in VERDICTS})
            shorter = shares.select(F.col("gram").alias("rest"), *[F.col(f"p_{v}").alias(f"less_{v}") for v in VERDICTS])
            rated = rated.join(shorter, F.substr("gram", F.lit(2)) == F.col("rest"))
        shares = rated.select("gram", *[smoothed(
            F.col(v), F.col(f"kinds_{v}"), F.col(f"total_{v}"), F.lit(UNSEEN) if order == 0 else F.col(f"less_{v}")).alias(f"p_{v}")
            for v in VERDICTS])
    diff = F.log("p_allow") - F.log("p_block")
    return shares.select("gram", F.round(diff * SCALE).cast("long").alias("diff"))


def scores(spellings: DataFrame) -> DataFrame:
    """(id, score) from (id, text, label, held, n): the score in billionths of a nat."""
    windows = spellings.select("id", "label", "held", "n", F.explode(grams(F.col("text"))).alias("gram"))
    trains = ~F.col("held")
    counts = stored(windows.groupBy("gram").agg(F.count("*").alias("windows"), *[
        F.sum(F.when(trains & (F.col("label") == v), F.col("n")).otherwise(0)).alias(v) for v in VERDICTS]))
    total = counts.groupBy().agg(F.sum("windows").alias("n")).scalar()
    model = stored(model_table(counts.drop("windows")).join(counts.select("gram", (F.col("windows") * HOT > total).alias("hot")), "gram"))
    hot = F.broadcast(model.where("hot").select("gram", F.col("diff").alias("known")))
    met = windows.select("id", "gram").join(hot, "gram", "left")
    cold = met.where("known is null").select("id", "gram").join(model.where("not hot"), "gram").select("id", "diff")
    every = met.where("known is not null").select("id", F.col("known").alias("diff")).unionByName(cold)
    return every.groupBy("id").agg((F.sum("diff") / F.count("*")).alias("score"))


def judge_urls(
    pages: DataFrame, url: str = "url", keep: list[str] | None = None, rules: list[tuple[str, str, str]] | None = None,
) -> DataFrame:
    """(doc, host, path, rule, score, verdict): doc holds the kept columns (default all).

    Different spellings are scored once and joined back, so a URL that a third of the rows repeat is
    one row there; the join is left to AQE's skew handling.
    """
    rules = RULES if rules is None else rules
    kept = F.struct(*[F.col(f"`{c}`") for c in (pages.columns if keep is None else keep)]).alias("doc")
    host, path = F.col("host"), F.col("path")
    parsed = pages.select(kept, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    ruled = parsed.select(
        "*", rule_of(host, path, rules, "rule").alias("rule"), rule_of(host, path, rules, "verdict").alias("ruled"),
        spelled(host, path).alias("text"))
    # the verdict of a rule follows from host and path
    spellings = stored(ruled.groupBy("text").agg(F.first("ruled").alias("label"), F.count("*").alias("n")).withColumns({
        "id": F.monotonically_increasing_id(), "held": F.substr(F.md5("text"), F.lit(1), F.lit(1)).isin(*HELD_OUT)}))
    # stored, so that the join back is between two exchanges, which AQE can split where one URL is repeated
    scored = stored(spellings.join(scores(spellings), "id"))
    limit = calibrated(scored.where("held")).scalar()
    judged = ruled.join(scored.select("text", "score"), "text")
    verdict = F.coalesce(F.col("ruled"), F.when(F.col("score") < limit, "block"), F.lit("allow"))
    return judged.select("doc", "host", "path", "rule", (F.col("score") / SCALE).alias("score"), verdict.alias("verdict"))


def calibrated(scored: DataFrame) -> DataFrame:
    """The score between the two labelled groups, as many spreads from the one's mean as from the other's.

    Means and spreads come from sums of whole numbers (thousandths of a nat), so that they do not depend on the
    order of the rows.
    """
    milli = F.round(F.col("score") / (SCALE // 1000)).cast("long")
    sums = {}
    for v in VERDICTS:
        own = F.col("label") == v
        n, s, q = (F.sum(F.when(own, x)).cast("double") for x in (F.col("n"), F.col("n") * milli, F.col("n") * milli * milli))
        sums[v] = (s / n, F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))) + 1)
    (ma, da), (mb, db) = sums["allow"], sums["block"]
    return scored.groupBy().agg(F.round((ma * db + mb * da) / (da + db) * (SCALE // 1000)).alias("limit_value"))
