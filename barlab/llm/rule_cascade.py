"""Quality rules as a short-circuit cascade.

Every rule has a *fails* condition over a document's text. On a sample each
rule's cost (seconds over a plain scan) and selectivity (share rejected) are
measured; rules then run in order of rejection per cost, and a document that
one rule rejects is never shown to the rest (``CASE WHEN`` stops at the first
hit). The order moves only the cost: a document is kept when no rule fails, so
the verdict is the same in every order.

Native: column expressions only. The arrays an expression builds belong to one
document and are linear in its length.

Edge cases: null and empty texts have no words (the word-count rule rejects
them); repeated rows are judged one by one; an empty table keeps the given rule
order; extra columns pass through (the added ones are ``keep_verdict`` and
``rejected_by``, replaced if they exist).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.workspace import Workspace, let

WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_SYMBOLS_PER_10_WORDS = 1
MAX_DUP_LINE_PCT = 50
MAX_EXCLAIM_PER_10_WORDS = 5
MIN_MEAN_WORD, MAX_MEAN_WORD = 2, 20
#: Rows aimed at when cost and selectivity are measured.
SAMPLE_ROWS = 2000


def words(text: Column) -> Column:
    """Maximal runs of characters other than the six white-space ones; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), WORD_SPACE, "")).cast("long")


def n_chars_of(text: Column, chars: str) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.translate(t, chars, ""))).cast("long")


def word_lines(text: Column) -> Column:
    """``\\n``-split lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                    lambda s: F.length(F.translate(s, WORD_SPACE, "")) > 0)


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier one."""
    return let(word_lines(text), lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def n_repeat_words(text: Column, window: int = 3) -> Column:
    """Words covered by a word window that occurs twice or more in the text.

    Windows are sorted with their positions by hash; those equal to a neighbour
    are repeated, and one pass over their positions adds up what they cover.
    """
    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - window)
        return F.when(F.size(h) >= window, F.transform(
            at, lambda i: F.struct(F.xxhash64(*[F.get(h, i + k) for k in range(window)]).alias("t"), i.alias("p")))
        ).otherwise(F.expr("array()").cast("array<struct<t:bigint,p:int>>"))

    def repeated(s: Column) -> Column:
        same = F.filter(s, lambda x, i: (F.get(s, i - 1)["t"] == x["t"]).eqNullSafe(F.lit(True))
                        | (F.get(s, i + 1)["t"] == x["t"]).eqNullSafe(F.lit(True)))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(p, zero, lambda a, x: F.struct(
            (a["n"] + (x + window - F.greatest(a["end"], x))).cast("long").alias("n"), (x + window).alias("end")),
            lambda a: a["n"])

    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    return let(F.sort_array(let(hashes, windows)), lambda s: covered(repeated(s)))


def signals(text: Column) -> dict[str, Column]:
    return {"n_words": n_words(text), "word_chars": word_chars(text), "n_symbols": n_chars_of(text, SYMBOLS),
            "n_exclaim": n_chars_of(text, "!"), "n_lines": F.size(word_lines(text)).cast("long"),
            "n_dup_lines": n_dup_lines(text), "n_repeat_words": n_repeat_words(text)}


@dataclass(frozen=True)
class Rule:
    """``fails`` maps the signal columns to the condition that rejects a document."""

    name: str
    fails: Callable[[dict[str, Column]], Column]


BASE_RULES = (
    Rule("too_few_words", lambda s: s["n_words"] < MIN_WORDS),
    Rule("repeated_windows", lambda s: 100 * s["n_repeat_words"] > MAX_REPEAT_PCT * s["n_words"]),
)
EXTRA_RULES = (
    Rule("symbols", lambda s: 10 * s["n_symbols"] > MAX_SYMBOLS_PER_10_WORDS * s["n_words"]),
    Rule("exclamations", lambda s: 10 * s["n_exclaim"] > MAX_EXCLAIM_PER_10_WORDS * s["n_words"]),
    Rule("duplicate_lines", lambda s: 100 * s["n_dup_lines"] > MAX_DUP_LINE_PCT * s["n_lines"]),
    Rule("word_length", lambda s: (s["word_chars"] < MIN_MEAN_WORD * s["n_words"])
         | (s["word_chars"] > MAX_MEAN_WORD * s["n_words"])),
)
RULES = BASE_RULES + EXTRA_RULES


def measure(sample: DataFrame, rules, sig: dict[str, Column]) -> list[dict]:
    """Cost (seconds beyond a bare scan of the texts) and selectivity of each rule on ``sample``."""
    def timed(col: Column) -> tuple[float, int, int]:
        t0 = time.perf_counter()
        r = sample.agg(F.count_if(col).alias("hit"), F.count(F.lit(1)).alias("n")).first()
        return time.perf_counter() - t0, r["hit"], r["n"]

    scan = F.length(F.col("text")) < 0
    timed(scan)
    base = timed(scan)[0]
    out = []
    for r in rules:
        cond = r.fails(sig)
        timed(cond)  # compiles the expression
        cost, hit, n = timed(cond)
        out.append({"rule": r, "cost": max(cost - base, 1e-3), "selectivity": hit / n if n else 0.0})
    return out


def order_rules(ws: Workspace, docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per cost, highest first, both measured on about ``sample_rows`` rows."""
    total = docs.count()
    if not total:
        return list(rules)
    frac = min(1.0, sample_rows / total)
    sample = ws.stage(docs.select("text").sample(fraction=frac, seed=7), "rule-sample")
    found = measure(sample, rules, signals(F.col("text")))
    return [m["rule"] for m in sorted(found, key=lambda m: -m["selectivity"] / m["cost"])]


def verdict(rules, sig: dict[str, Column]) -> Column:
    """Name of the first rule that rejects, in the given order; null when kept."""
    out = F.lit(None).cast("string")
    for r in reversed(list(rules)):
        out = F.when(r.fails(sig), F.lit(r.name)).otherwise(out)
    return out


def cascade(ws: Workspace, docs: DataFrame, rules=RULES, text_col: str = "text",
            sig: dict[str, Column] | None = None) -> DataFrame:
    """Add ``rejected_by`` and ``keep_verdict`` from the ordered cascade.

    ``sig`` may name columns that already hold the signals; otherwise they are
    computed from the text inside the cascade, so a rejected document never pays
    for the rules behind the one that rejected it.
    """
    ordered = order_rules(ws, docs.select(F.col(text_col).alias("text")), rules)
    by = verdict(ordered, sig or signals(F.col(text_col)))
    return docs.withColumn("rejected_by", by).withColumn("keep_verdict", F.col("rejected_by").isNull())


def judge(ws: Workspace, docs: DataFrame) -> DataFrame:
    """Per document: the base signals, ``base_failed`` and ``kept``."""
    sig = signals(F.col("text"))
    rows = docs.select("doc_id", "text", *[c.alias(k) for k, c in sig.items()])
    cols = {k: F.col(k) for k in sig}
    out = cascade(ws, rows, RULES, sig=cols)
    base = BASE_RULES[0].fails(cols) | BASE_RULES[1].fails(cols)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), (F.col("keep_verdict") & ~base).alias("kept"))


def keep(ws: Workspace, docs: DataFrame) -> DataFrame:
    """Documents that no rule rejects, columns unchanged."""
    cols = docs.columns
    return cascade(ws, docs).filter("keep_verdict").select(*cols)
