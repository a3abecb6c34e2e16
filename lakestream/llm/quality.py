"""Quality rules whose cutoffs are certified on labelled documents to reject few good ones.

Every rule compares one measure of a text with a cutoff. Strata are language and length. For each stratum and
rule the cutoffs of a fixed grid are tested from the most lenient to the strictest on the good documents of the
labelled holdout: the hypothesis that a cutoff rejects more than `RISK / rules` of the good ones is given up if
the exact binomial probability of so few rejections is at most `ERROR / (strata x rules)`, and testing stops at
the first cutoff that keeps it. Testing in this order needs no correction along the grid, and the division
corrects for all strata and rules, so with probability 1 - ERROR no stratum loses more than RISK of its good
documents. Of the certified cutoffs the one that best separates bad documents from good ones is used; a stratum
with too few labelled documents certifies none and rejects nothing beyond the base rules.

Everything is a DataFrame expression. Null texts have no words. Documents without a label are judged and not
learned from; of several labels of an id the worst counts. A null language is a stratum of its own. Repeated
rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestream.functions.payload import computed_once
from lakestream.llm.corpus import only, settled

#: Share of the good documents of a stratum that may be rejected, and the chance of a stratum that loses more.
RISK, ERROR = 0.05, 0.05
#: Words where one length band ends and the next begins.
BANDS = (300,)
WINDOW_WORDS = 8
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30

#: Separators between words: blank, tab, line feed, vertical tab, form feed, carriage return (fixed values).
SEPARATORS = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Of each rule its measure and its grid, the most lenient cutoff first; a document above a cutoff is rejected.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / word_chars", tuple(0.5 * 0.8**i for i in range(20))),
    "duplicate_lines": ("n_dup_lines / n_lines", tuple(0.9 - 0.045 * i for i in range(20))),
    "long_words": ("word_chars / n_words", tuple(20.0 - 0.7 * i for i in range(20))),
    "distinct": ("1 - n_distinct_words / n_words", tuple(0.98 - 0.02 * i for i in range(20))),
    "upper_case": ("n_upper / word_chars", tuple(0.95 * 0.85**i for i in range(20))),
}


def _at_least_one(n: Column) -> Column:
    return F.greatest(n, F.lit(1))


def features(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per document: id, its `stratum`, and the counts that the rules are made of."""
    docs = only(documents, id_col, text_col, lang_col).toDF("id", "text", "lang")
    docs = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    words = F.filter(F.split("text", SEPARATORS), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(A_WORD))
    docs = computed_once(docs, {"words": words, "lines": lines})
    n = F.size("words")
    starts = F.when(n >= WINDOW_WORDS, F.sequence(F.lit(1), n - (WINDOW_WORDS - 1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, F.lit(WINDOW_WORDS))))
    joined = F.array_join("words", "")
    counts = {
        "n_words": n,
        "word_chars": F.length(joined),
        "n_symbols": F.size(F.split("text", SYMBOLS)) - 1,
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_lines": F.size("lines"),
        "n_distinct_words": F.size(F.array_distinct("words")),
        "n_upper": F.size(F.split(joined, r"\p{Lu}")) - 1,
    }
    counts = {name: count.cast("long") for name, count in counts.items()}
    docs = computed_once(docs, counts | {"hashes": F.coalesce(hashes, F.array().cast("array<long>"))})
    docs = docs.drop("text", "words", "lines")
    # Equal windows become neighbours when sorted by hash; only texts that repeat any are looked at further.
    pairs = F.transform("hashes", lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
    twice = F.size(F.array_distinct("hashes")) < F.size("hashes")
    docs = computed_once(docs, {"windows": F.when(twice, F.sort_array(pairs))}).drop("hashes")
    size = F.size("windows")
    like_next = F.zip_with("windows", F.slice("windows", 2, size), lambda a, b: a["hash"].eqNullSafe(b["hash"]))
    docs = computed_once(docs, {"like_next": like_next})
    after = F.zip_with("windows", "like_next", lambda w, e: F.struct(w["place"].alias("place"), e.alias("like")))
    like_last = F.concat(F.array(F.lit(False)), "like_next")
    places = F.zip_with(after, like_last, lambda w, last: F.when(w["like"] | last, w["place"]))
    docs = computed_once(docs, {"places": F.sort_array(F.filter(places, lambda p: p.isNotNull()))})
    reach = F.lit(WINDOW_WORDS)
    steps = F.zip_with(
        "places",
        F.slice("places", 2, F.size("places")),
        lambda a, b: F.least(reach, F.coalesce(b - a, reach)),
    )
    repeated = F.aggregate(steps, F.lit(0), lambda total, step: total + step)
    band = reduce(lambda b, end: b + (F.col("n_words") >= end).cast("int"), BANDS, F.lit(0))
    return docs.select(
        F.col("id").alias(id_col),
        F.struct(F.col("lang").alias("lang"), band.alias("band")).alias("stratum"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"),
        *("n_distinct_words", "n_upper"),
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeated


def measure(rule: str) -> Column:
    above, below = RULES[rule][0].rsplit(" / ", 1)
    return F.when(F.col(below) > 0, F.expr(RULES[rule][0].replace(below, f"cast({below} as double)"))).otherwise(0.0)


def _log_factorial(n: Column) -> Column:
    """Exact for the first values, Stirling's series from 10 on, where its error is below 1e-12."""
    x = n.cast("double")
    small = F.array(*(F.lit(math.lgamma(i + 1.0)) for i in range(10)))
    series = (
        x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    ) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    return F.when(n < 10, F.try_element_at(small, n.cast("int") + 1)).otherwise(series)


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """The probability of at most `k` of `n` at rate `p`, for k below the mean; 1 from there on.

    Terms are added from k downwards, where they fall; those beyond forty standard deviations vanish in a
    double, so their number need not grow with n.
    """
    first = F.exp(
        _log_factorial(n)
        - _log_factorial(k)
        - _log_factorial(n - k)
        + k * math.log(p)
        + (n - k) * math.log1p(-p)
    )
    count = F.least(k, F.ceil(40 * F.sqrt(n * p * (1 - p)) + 100)).cast("int")
    start = F.struct(first.alias("term"), first.alias("total"))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, start, add, lambda acc: acc["total"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(total, F.lit(1.0)))


def cutoffs(
    judged: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "quality",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """Of each stratum and rule with a certified cutoff: `stratum`, `rule`, `cutoff`, and what certified it."""
    known = only(labels, id_col, label_col).filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(id_col).agg(F.min(label_col).alias("good"))
    rows = judged.filter(~base_failed()).join(known, id_col)
    marks = []
    for rule, (_, grid) in RULES.items():
        passed = F.size(F.filter(F.array(*map(F.lit, grid)), lambda c: measure(rule) > c))
        marks.append(F.struct(F.lit(rule).alias("rule"), passed.alias("above")))
    counts = (
        rows.select("stratum", "good", F.inline(F.array(*marks)))
        .groupBy("stratum", "rule", "above")  # at most 21 for each stratum and rule
        .agg(F.count_if(F.col("good") > 0).alias("good"), F.count_if(F.col("good") <= 0).alias("bad"))
    )
    # A document that lies above `above` cutoffs exceeds the strictest ones: those from place 20 - above on.
    whole = Window.partitionBy("stratum", "rule")
    places = F.posexplode(F.array(*(F.lit(i) for i in range(20)))).alias("place", "_")
    totals = settled(
        counts.groupBy("stratum", "rule").agg(
            F.sum("good").alias("n"),
            F.sum("bad").alias("n_bad"),
            F.map_from_entries(F.collect_list(F.struct("above", F.struct("good", "bad")))).alias("by"),
        )
    )
    tested = totals.select("stratum", "rule", "n", "n_bad", "by", places).drop("_")

    def rejected(of: str) -> Column:
        hits = F.filter(F.map_entries("by"), lambda e: e["key"] >= 20 - F.col("place"))
        return F.aggregate(hits, F.lit(0).cast("long"), lambda t, e: t + e["value"][of])

    tested = tested.withColumns({"k": rejected("good"), "k_bad": rejected("bad")}).drop("by")
    level = error / (max(1, totals.select("stratum").distinct().count()) * len(RULES))
    p_value = binomial_at_most(F.col("k"), F.col("n"), risk / len(RULES))
    tested = tested.withColumn("p_value", p_value)
    lenient_first = whole.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    certified = tested.withColumn("fails", F.max(F.col("p_value") > level).over(lenient_first)).filter("not fails")
    gain = F.col("k_bad") / _at_least_one(F.col("n_bad")) - F.col("k") / _at_least_one(F.col("n"))
    best = certified.withColumn("gain", gain).filter("gain > 0")
    best = best.groupBy("stratum", "rule").agg(
        F.max(F.struct("gain", (-F.col("place")).alias("lenient"), "place", "n", "k", "k_bad", "p_value")).alias("b")
    )
    grids = F.create_map(*(x for rule, (_, g) in RULES.items() for x in (F.lit(rule), F.array(*map(F.lit, g)))))
    cutoff = F.element_at(grids[F.col("rule")], F.col("b.place") + 1).alias("cutoff")
    return best.select("stratum", "rule", cutoff, "b.n", "b.k", "b.p_value")


def judge(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "quality",
) -> DataFrame:
    """One row per document: the counts, `base_failed`, `kept`, and the first rule that rejected it, if any."""
    judged = settled(features(documents, id_col, text_col, lang_col))
    chosen = cutoffs(judged, labels, id_col, label_col)
    per_stratum = settled(
        chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    )
    cuts = per_stratum.select(F.col("stratum").alias("own_stratum"), "cuts")
    joined = judged.join(cuts, F.col("stratum").eqNullSafe(F.col("own_stratum")), "left")
    broken = F.coalesce(*(F.when(measure(rule) > F.col("cuts")[rule], F.lit(rule)) for rule in RULES))
    rejected_by = F.when(base_failed(), F.lit("base")).otherwise(broken)
    return joined.select(
        id_col,
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        base_failed().alias("base_failed"),
        rejected_by.isNull().alias("kept"),
        rejected_by.alias("rejected_by"),
    )
