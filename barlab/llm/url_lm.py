"""URL filter: host/path rules, and a character language-model ratio for the rest.

URLs that a rule decides are the labelled ones. Two variable-order Markov models
(contexts of 0 to ``ORDER`` symbols, Witten-Bell interpolation, so an unseen
context falls back to the longest seen one) are counted from the accepted and
the rejected URLs. A URL's score is the log-likelihood difference per symbol;
the threshold is calibrated on held-out labelled URLs (a hash fold the models
never see) for the best balanced accuracy.

Symbols come from an alphabet of ``len(ALPHABET)`` after folding, so there are at most
``len(ALPHABET) ** (ORDER + 1)`` (2.56 million) grams however many URLs there are;
this bound is what makes the score table safe to broadcast. All rows are
counted, none sampled.

Native. Edge cases: a null URL or one without ``://`` has empty host and path,
matches no rule and is scored as the text it is (null as empty); repeated rows
count and return repeatedly; with no accepted or no rejected training URL there
is no model and undecided URLs are allowed; an empty table gives no rows; only
page_id and url are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.workspace import Workspace

#: (host and path, verdict)
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
ORDER = 3
START, END, OTHER = "^", "$", "*"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-_?=&#%:" + START + END + OTHER
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HELD_OUT_FOLDS = 5
BIN = 1000
MAX_SCORE = 16


def host_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, v in sorted(rules, key=lambda r: len(r[0])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def folded(url: Column) -> Column:
    """The URL over ALPHABET, padded with ORDER starts and one end."""
    u = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    u = F.regexp_replace(F.regexp_replace(u, "[0-9]", "0"), r"[^a-z0/.\-_?=&#%:]", OTHER)
    return F.concat(F.lit(START * ORDER), u, F.lit(END))


def grams(s: Column) -> Column:
    """All (ORDER + 1)-symbol windows: a context and the symbol behind it."""
    return F.transform(F.sequence(F.lit(1), F.length(s) - ORDER), lambda i: F.substr(s, i, F.lit(ORDER + 1)))


def score_table(ws: Workspace, counts: DataFrame) -> DataFrame:
    """gram, score: log P(symbol | context) of the accepted model less the rejected one's.

    ``counts`` has gram, a and b (training occurrences in either class).
    """
    t = counts.withColumn("pa", F.lit(1.0 / len(ALPHABET))).withColumn("pb", F.lit(1.0 / len(ALPHABET)))
    for k in range(ORDER + 1):
        key = F.substring("gram", ORDER + 1 - k, k + 1)
        seen = counts.groupBy(key.alias("g")).agg(F.sum("a").alias("ga"), F.sum("b").alias("gb"))
        ctx = seen.groupBy(F.substring("g", 1, k).alias("c")).agg(
            F.sum("ga").alias("ca"), F.sum("gb").alias("cb"), F.count_if(F.col("ga") > 0).alias("da"),
            F.count_if(F.col("gb") > 0).alias("db"))
        seen = ws.stage(seen.join(ctx, F.substring("g", 1, k) == F.col("c")).drop("c"), f"order{k}")
        t = t.join(seen, key == F.col("g"))
        for x in "ab":
            n, d = F.col("c" + x), F.col("d" + x)
            t = t.withColumn("p" + x, F.when(n > 0, (F.col("g" + x) + d * F.col("p" + x)) / (n + d)).otherwise(F.col("p" + x)))
        t = t.select("gram", "pa", "pb")
    return ws.stage(t.select("gram", (F.log("pa") - F.log("pb")).alias("score")), "scores")


def calibrate(scored: DataFrame) -> float:
    """Threshold of best balanced accuracy on labelled rows, from a histogram of bounded size."""
    b = F.greatest(F.lit(-MAX_SCORE * BIN), F.least(F.lit(MAX_SCORE * BIN), F.floor(F.col("score") * BIN)))
    h = scored.groupBy(b.alias("bin")).agg(F.count_if(F.col("label") == "allow").alias("a"),
                                           F.count_if(F.col("label") == "block").alias("b"))
    every, below = Window.partitionBy(), Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    na, nb = F.sum("a").over(every), F.sum("b").over(every)
    miss_a, hit_b = F.coalesce(F.sum("a").over(below), F.lit(0)), F.coalesce(F.sum("b").over(below), F.lit(0))
    acc = F.coalesce(F.try_divide(na - miss_a, na), F.lit(0.0)) + F.coalesce(F.try_divide(hit_b, nb), F.lit(0.0))
    # halfway to the next bin below, the widest margin on either side
    at = (F.col("bin") + F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, F.col("bin"))) / 2
    best = h.select(at.alias("at"), acc.alias("acc")).orderBy(F.desc("acc"), F.abs("at"), "at").first()
    return best["at"] / BIN if best else 0.0


def judge_urls(ws: Workspace, pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score (null where there is no model)."""
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    fold = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT_FOLDS))
    rows = rows.withColumns({"rule": name, "label": verdict, "held_out": fold == 0})
    per_symbol = rows.select("label", "held_out", F.explode(grams(folded(F.col("url")))).alias("gram"))
    train = lambda v: F.count_if((F.col("label") == v) & ~F.col("held_out"))
    counts = ws.stage(per_symbol.groupBy("gram").agg(train("allow").alias("a"), train("block").alias("b")), "grams")
    have = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    cols = ["page_id", "url", "host", "path", "rule", "label", "held_out"]
    if not have["a"] or not have["b"]:
        out = rows.withColumn("score", F.lit(None).cast("double"))
        return out.select("page_id", "host", "path", "rule", F.coalesce("label", F.lit("allow")).alias("verdict"), "score")
    scores = score_table(ws, counts)
    each = (rows.withColumn("rid", F.monotonically_increasing_id())
            .select("rid", *cols, F.explode(grams(folded(F.col("url")))).alias("gram")))
    # at most len(ALPHABET) ** (ORDER + 1) short rows
    scored = ws.stage(each.join(F.broadcast(scores), "gram").groupBy("rid", *cols)
                      .agg(F.avg("score").alias("score")), "scored")
    t = calibrate(scored.filter(F.col("held_out") & F.col("label").isNotNull()))
    by_model = F.when(F.col("score") >= t, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("label", by_model).alias("verdict"), "score")
