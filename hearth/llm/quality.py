"""Quality rules as a short-circuit cascade, built from Spark functions only.

Every rule is a Boolean column that is true where a document is rejected. On a
sample of raw texts each rule is timed, with the measures that it needs, and the rules' joint outcomes are
counted; the rules are then ordered greedily by rejected share per second among the documents
that the earlier rules let through. ``keep`` applies them one after the other in that order: a rule's
measures are computed only for the documents that all rules before it let through. ``assess`` reports
every measure of every document, so there the order, compiled into one lazy CASE, saves only the
rules themselves. The verdict does not depend on the order; ``rejected_by``, the first rule that rejects, does,
and as costs are times, ties in it may fall differently in another run.

Null texts count as texts without words. A document without words fails the
first base rule. Repeated rows are all kept or all rejected; texts of any length are measured whole. Other
columns stay, but for ones named like a measure or verdict, which ``assess`` replaces and ``keep`` leaves
alone. An empty table gives an empty one. Nothing is grouped or shuffled, so no source or key can be hot.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import discard, materialize, text_or_empty

BLANK = "[\\x20\\x09-\\x0D]+"
#: Rows of the sample on which costs and selectivities are estimated (expected number).
SAMPLE_ROWS = 2000

# Thresholds of the rules beyond the base. Shares are of words, lines or letters.
MAX_SYMBOLS_PER_WORD = 0.3
MAX_DUP_LINES = 0.5
MAX_CAPITALS = 0.6
MEAN_WORD = (2, 20)
MAX_BANGS_PER_WORD = 0.2


def measures(df: DataFrame, text: str = "text", known: Sequence[str] = ()) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of the whole text, but for those that it has already.

    What is not used of it is not computed.

    Repeated three-word windows are found by sorting one integer per window
    (hash in the high bits, position in the low ones); the few candidates are
    then compared by their words, so a hash collision changes nothing.
    """
    keep = df.columns
    t = text_or_empty(F.col(f"`{text}`"))
    d = df.withColumn("__w", F.array_remove(F.split(t, BLANK), ""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = d.withColumn("__l", lines).withColumn("__n", F.size("__w"))
    high = F.lit(-(1 << 31))  # clears the low 31 bits
    window_keys = F.transform(
        F.sequence(F.lit(1), F.col("__n") - 2),
        lambda i: F.xxhash64(F.get("__w", i - 1), F.get("__w", i), F.get("__w", i + 1)).bitwiseAND(high).bitwiseOR(i.cast("bigint")),
    )
    d = d.withColumn("__k", F.when(F.col("__n") >= 3, F.sort_array(window_keys)).otherwise(F.array().cast("array<bigint>")))
    at = lambda i: F.shiftright(F.get("__k", i), 31)
    low = F.lit((1 << 31) - 1)
    twin = F.filter("__k", lambda x, i: F.coalesce(F.shiftright(x, 31) == at(i - 1), F.lit(False)) | F.coalesce(F.shiftright(x, 31) == at(i + 1), F.lit(False)))
    d = d.withColumn("__c", F.transform(twin, lambda x: x.bitwiseAND(low).cast("int")))
    word = lambda i: F.get("__w", i)
    d = d.withColumn("__s", F.array_sort(F.transform("__c", lambda p: F.struct(F.concat_ws(" ", word(p - 1), word(p), word(p + 1)).alias("w"), p.alias("p")))))
    same = lambda x, j: F.coalesce(x["w"] == F.get("__s", j)["w"], F.lit(False))
    d = d.withColumn("__p", F.sort_array(F.transform(F.filter("__s", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"])))
    covered = F.transform("__p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("__p", i + 1) - p, F.lit(3))).cast("bigint"))
    cols = {
        "n_words": F.col("__n").cast("bigint"),
        "word_chars": F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("bigint"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("bigint"),
        "n_lines": F.size("__l").cast("bigint"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint"),
        "n_repeat_words": F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x),
    }
    cols = {k: v for k, v in cols.items() if k not in known}
    return d.select(*[F.col(f"`{c}`") for c in keep if c not in cols], *[v.alias(k) for k, v in cols.items()])


def base_rules() -> dict[str, Column]:
    return {
        "too_few_words": F.col("n_words") < 50,
        "repeated_words": F.col("n_repeat_words") * 100 > F.col("n_words") * 50,
    }


def further_rules(text: str = "text") -> dict[str, Column]:
    t = text_or_empty(F.col(f"`{text}`"))
    capitals = F.length(F.regexp_replace(t, "[^\\p{Lu}]+", ""))
    small = F.length(F.regexp_replace(t, "[^\\p{Ll}]+", ""))
    return {
        "symbols": F.col("n_symbols") > F.col("n_words") * MAX_SYMBOLS_PER_WORD,
        "repeated_lines": F.col("n_dup_lines") > F.col("n_lines") * MAX_DUP_LINES,
        "word_length": ~F.col("word_chars").between(F.col("n_words") * MEAN_WORD[0], F.col("n_words") * MEAN_WORD[1]),
        "capitals": capitals > (capitals + small) * MAX_CAPITALS,
        "bangs": (F.length(t) - F.length(F.translate(t, "!", ""))) > F.col("n_words") * MAX_BANGS_PER_WORD,
    }


def plan(docs: DataFrame, text: str, rules: Mapping[str, Column], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Order of the rules by rejection per cost on a sample of about ``sample_rows`` rows."""
    total = docs.count()
    if not total:
        return list(rules)
    sample = docs if total <= sample_rows else docs.sample(fraction=sample_rows / total, seed=7)
    sample = materialize(sample.select(F.col(f"`{text}`")), "quality-sample")
    flagged = measures(sample, text).select(*[F.coalesce(r, F.lit(False)).alias(n) for n, r in rules.items()])
    outcomes = [(r.asDict(), r["__rows"]) for r in flagged.groupBy(*rules).agg(F.count("*").alias("__rows")).collect()]  # 2 ** rules rows at most
    cost = {}
    for n, r in rules.items():
        began = time.perf_counter()
        measures(sample, text).agg(F.count_if(r)).collect()
        cost[n] = time.perf_counter() - began
    discard(sample)
    order: list[str] = []
    while len(order) < len(rules):
        alive = [(o, k) for o, k in outcomes if not any(o[n] for n in order)]
        left = sum(k for _, k in alive) or 1
        order.append(max((n for n in rules if n not in order), key=lambda n: (sum(k for o, k in alive if o[n]) / left / cost[n], -cost[n])))
    return order


def cascade(df: DataFrame, rules: Mapping[str, Column], order: list[str], reason: str = "rejected_by") -> DataFrame:
    """``df`` with the name of the first rule, in ``order``, that rejects the row; null if none does."""
    case = F
    for n in order:
        case = case.when(F.coalesce(rules[n], F.lit(False)), F.lit(n))
    return df.withColumn(reason, case if order else F.lit(None).cast("string"))


def assess(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the measures, base_failed, rejected_by and kept."""
    d = measures(docs, text)
    rules = base_rules() | further_rules(text)
    order = plan(docs, text, rules, sample_rows)
    base = base_rules()
    return cascade(d, rules, order).withColumn("base_failed", base["too_few_words"] | base["repeated_words"]).withColumn("kept", F.col("rejected_by").isNull())


def keep(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    rules = base_rules() | further_rules("text")
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(f"`{text}`").alias("text"))  # names cannot clash
    left = measures(boxed).select("__row", "text", "n_words")  # most rules need the number of words
    for name in plan(boxed.select("text"), "text", rules, sample_rows):
        # the partition number makes the verdict nondeterministic to the optimizer, which then leaves the filter above
        # its measures and below those of the next rule; merged, they would all be computed for every document
        verdict = (~F.coalesce(rules[name], F.lit(False)) & (F.spark_partition_id() >= 0)).alias("__passed")
        left = measures(left, "text", ["n_words"]).select("__row", "text", "n_words", verdict).where("__passed").select("__row", "text", "n_words")
    return left.select("__row.*")
