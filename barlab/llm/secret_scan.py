"""Secret scan: base rules, and character Markov models of random strings and of ordinary identifiers.

Base rules find assigned values, access keys and hex strings. What they can't
name is a long run of ``[A-Za-z0-9+/_-]`` (``LONG`` characters or more, up to two
``=`` behind it, a letter in it, no base span on it) that looks random: the log
likelihood of its characters under a model of random strings exceeds the one
under a model of identifiers by the log odds ``1 / PRIOR`` of a secret.

Both are Markov models of order 0 to ``ORDER``, each order interpolated with the
one below (Witten-Bell), trained from labelled strings, each distinct one once,
so that copies of a document don't change them:

* random: all values that base rules found, and ``DIGESTS`` digests written in
  four alphabets;
* ordinary: all runs of ``SHORT`` to ``LONG - 1`` characters of the corpus outside
  assigned values. They are too short to be candidates, so no candidate is in
  its own training data.

Counts cover all documents and grow with them; grams, contexts and candidates
are joined by shuffles unless their stored tables are small.

Places come from one split per rule: the code points between matches and those
of the matches add up, in a window over the matches of one document and rule.
Searching for a hex run of 24 characters or an access key of 20 gives what
searching any and dropping the short gives, as a run starts where the class does.
An assigned value is searched at any length and dropped after, since a short one
may hold the next rule's name.

Native. Edge cases: null text is empty; rows are told apart by a row number, so
null or repeated ids and repeated rows each keep their own spans; without
ordinary strings every context falls back to equal chances; an empty table gives
no rows; only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlab.llm.workspace import Workspace

KINDS = ("assign", "access", "hex", "random")
SHORT, LONG = 8, 16
ORDER = 3
#: Share of candidates taken to be secrets before their characters are seen.
PRIOR = 1e-6
#: Bound on the digests the random model is started with.
DIGESTS = 4096
#: Characters of base values and runs; an unseen one has this chance under either model.
SYMBOLS = 68
PAD = "^"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = f"({NAMES})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (ASSIGN, "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", f"[A-Za-z0-9+/_-]{{{LONG},}}={{0,2}}")
VALUE_MIN = 6


def hits(text: Column, kind: int) -> Column:
    """Matches of a rule in order: kind, i, found, and gap, the code points before it and behind the last one."""
    p = PATTERNS[kind]
    pieces = F.arrays_zip(F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias("found"), F.transform(F.split(text, p, -1), F.length).alias("gap"))
    found = F.filter(F.transform(pieces, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["found"].alias("found"),
                                                               x["gap"].alias("gap"))), lambda x: x["found"].isNotNull())
    return F.when(F.regexp_like(text, F.lit(p)), found).otherwise(F.array())


def read(ws: Workspace, docs: DataFrame) -> DataFrame:
    """row, doc_id, hits and runs (the text's distinct runs of SHORT characters or more): the one pass over texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    outside = F.when(F.regexp_like(text, F.lit(ASSIGN)), F.regexp_replace(text, ASSIGN, " ")).otherwise(text)
    runs = F.array_distinct(F.regexp_extract_all(outside, F.lit(f"[A-Za-z0-9+/_-]{{{SHORT},}}"), F.lit(0)))
    out = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.concat(*[hits(text, k) for k in range(len(KINDS))]).alias("hits"), runs.alias("runs"))
    return ws.stage(out, "read")


def located(ws: Workspace, seen: DataFrame) -> DataFrame:
    """row, kind, s, e, value of base spans that hold, and of candidates outside them."""
    each = seen.select("row", F.explode("hits").alias("h")).select("row", "h.*").repartition("row")
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("e", F.sum(F.col("gap") + F.length("found")).over(upto))
    value = F.when(F.col("kind") == 0, F.regexp_extract("found", ASSIGN, 2)).otherwise(F.col("found"))
    each = each.select("row", "kind", (F.col("e") - F.length("found")).alias("s"), "e", value.alias("value"))
    base = F.col("kind") < 3
    each = each.filter(~((F.col("kind") == 0) & (F.length("value") < VALUE_MIN)) & (base | F.col("value").rlike("[A-Za-z]")))
    order = Window.partitionBy("row").orderBy("s")
    before = F.max(F.when(base, F.col("e"))).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(base, F.col("s"))).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    each = each.withColumns({"before": before, "after": after})
    covered = F.coalesce(F.col("before") > F.col("s"), F.lit(False)) | F.coalesce(F.col("after") < F.col("e"), F.lit(False))
    return ws.stage(each.filter(base | ~covered).drop("before", "after"), "located")


def digests(spark: SparkSession) -> DataFrame:
    """Random strings by construction: hex, and three alphabets of base 64."""
    d = F.sha2(F.col("id").cast("string"), 256)
    b = F.replace(F.base64(F.unhex(d)), F.lit("="), F.lit(""))
    return spark.range(DIGESTS).select(F.explode(F.array(d, b, F.upper(b), F.lower(b))).alias("s"))


def grams(s: Column) -> Column:
    """Every character with the ORDER before it."""
    padded = F.concat(F.lit(PAD * ORDER), s)
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substr(padded, i, F.lit(ORDER + 1)))


def trained(ws: Workspace, seen: DataFrame, spans: DataFrame) -> DataFrame:
    """gram and how often it stands in the distinct random (r) and ordinary (o) strings."""
    random = spans.filter("kind < 3").select(F.col("value").alias("s")).union(digests(seen.sparkSession)).distinct()
    ordinary = seen.select(F.explode("runs").alias("s")).filter(F.length("s") < LONG).distinct()
    each = random.withColumn("is_random", F.lit(1)).union(ordinary.withColumn("is_random", F.lit(0)))
    each = each.select("is_random", F.explode(grams(F.col("s"))).alias("gram"))
    return ws.stage(each.groupBy("gram").agg(F.sum("is_random").alias("r"), F.sum(1 - F.col("is_random")).alias("o")), "grams")


def scored(ws: Workspace, wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """gram and ratio, log P(character | context) as random less as ordinary, of the wanted grams."""
    t = wanted.withColumns({"pr": F.lit(1.0 / SYMBOLS), "po": F.lit(1.0 / SYMBOLS)})
    for k in range(ORDER + 1):
        key = F.substring("gram", ORDER + 1 - k, k + 1)
        g = counts.groupBy(key.alias("g")).agg(F.sum("r").alias("gr"), F.sum("o").alias("go"))
        c = g.groupBy(F.substring("g", 1, k).alias("c")).agg(F.sum("gr").alias("cr"), F.sum("go").alias("co"), F.count_if(F.col("gr") > 0).alias("dr"),
                                                             F.count_if(F.col("go") > 0).alias("do"))
        t = t.join(g, key == F.col("g"), "left").join(c, F.substring("gram", ORDER + 1 - k, k) == F.col("c"), "left")
        for x in "ro":
            n, d, p = F.col(f"c{x}"), F.col(f"d{x}"), F.col(f"p{x}")
            t = t.withColumn(f"p{x}", F.when(n > 0, (F.coalesce(f"g{x}", F.lit(0)) + d * p) / (n + d)).otherwise(p))
        t = t.select("gram", "pr", "po")
    return t.select("gram", (F.log("pr") - F.log("po")).alias("ratio"))


def secrets(ws: Workspace, seen: DataFrame, spans: DataFrame, prior: float = PRIOR) -> DataFrame:
    """Distinct candidates that look random: value and their log-likelihood ratio."""
    counts = trained(ws, seen, spans)
    each = spans.filter("kind = 3").select("value").distinct()
    each = ws.stage(each.select("value", F.explode(grams(F.rtrim("value", F.lit("=")))).alias("gram")), "candidates")
    ratios = ws.stage(scored(ws, each.select("gram").distinct(), counts), "ratios")
    total = each.join(ratios, "gram").groupBy("value").agg(F.sum("ratio").alias("ratio"))
    return ws.stage(total.filter(F.col("ratio") >= math.log(1 / prior)), "secrets")


def scan(ws: Workspace, docs: DataFrame, prior: float = PRIOR) -> DataFrame:
    """Per row doc_id and ``found``: its spans (s, kind, e, value) by place, kinds numbered as in KINDS."""
    seen = read(ws, docs)
    spans = located(ws, seen)
    like_random = spans.filter("kind = 3").join(secrets(ws, seen, spans, prior).select("value"), "value")
    both = spans.filter("kind < 3").unionByName(like_random)
    per = both.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("s", "kind", "e", "value"))).alias("found"))
    none = F.array().cast("array<struct<s:bigint,kind:int,e:bigint,value:string>>")
    return seen.select("row", "doc_id").join(per, "row", "left").select("doc_id", F.coalesce("found", none).alias("found"))


def joined(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(ws: Workspace, docs: DataFrame, prior: float = PRIOR) -> DataFrame:
    """doc_id, counts of base spans, base_sha256 and spans of every row."""
    out = scan(ws, docs, prior)
    base = F.filter("found", lambda x: x["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return out.select("doc_id", count(0), count(1), count(2), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
