"""Quality rules (3): native text measures, and a cutoff for each rule that labelled documents select and certify.

Measures are DataFrame functions only. Four rules refuse documents; each has its own list of cutoffs, lenient to strict
(`RULES`). The labelled documents of a stratum are parted by a hash of their id. A quarter tunes: for each of some
shares (`LEVELS`), each rule takes the strictest cutoff that refuses no larger share of the tuning good documents. That
makes a path of steps, each a cutoff for every rule, from the most lenient ones on. The other documents are the
holdout: a step is certified if an exact binomial test rejects "more than `ALPHA` of the good documents are refused".
Steps are tested in their order up to the first failure (a fixed sequence needs no further correction); strata, and the
two quantities below, are corrected by Bonferroni. Of the certified steps, the most lenient of those that refuse most bad
documents is taken. A stratum that certifies nothing keeps all that passes the base rules.

What is promised, with probability 1 - `DELTA` for all strata at once: where the base rules themselves allow it, at most
`ALPHA` of a stratum's good documents are refused, by base rules and cutoffs together (`all`); where the base rules
alone refuse too many, or can't be shown not to, at most `ALPHA` of the good documents that pass the base rules are
refused by the cutoffs (`passed`). `certificates` tells which it is, with both rates as measured on the holdout.

Defined results: null and empty texts have no words, so fail the base rule; rows with the same or no id are judged
each by itself (an id labelled twice counts as good if any label says so); null strata are a stratum of their own;
an empty table gives an empty table; other columns are ignored or passed on untouched.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import carried, materialize, restored, table, tune

ALPHA, DELTA = 0.05, 0.05
MIN_WORDS = 50
#: Cutoffs of each rule, lenient to strict: symbols a character, letters of a word, share of repeated lines (above), letters of a word (below).
RULES = [
    ("symbols", (0.30, 0.25, 0.20, 0.15, 0.10, 0.075, 0.05, 0.03, 0.02)),
    ("long_words", (12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0)),
    ("repeated_lines", (0.90, 0.85, 0.80, 0.75, 0.70, 0.65, 0.60, 0.55, 0.50)),
    ("short_words", (1.6, 1.8, 2.0, 2.2, 2.4, 2.6, 2.8, 3.0, 3.2)),
]
#: Shares of the tuning good documents (in thousandths) that a rule may refuse at each step after the first.
LEVELS = (0, 2, 5, 10, 15, 20, 30, 40)
_WHITE = " \t\n\x0b\x0c\r"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Names that a document's own columns are unlikely to have.
_P = "__quality_"


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with the measures of the whole text, in columns with a prefix, and with what the rules need."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    bare = F.translate(text, _WHITE, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _WHITE, "") != "")
    out = docs.withColumns(
        {
            f"{_P}words": F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda x: x != ""),
            f"{_P}lines": lines,
            f"{_P}word_chars": F.length(bare).cast("long"),
            f"{_P}n_symbols": (F.length(bare) - F.length(F.translate(bare, "#*$%&|<>", ""))).cast("long"),
            f"{_P}n_chars": F.length(text).cast("long"),
        }
    )
    w = F.col(f"{_P}words")
    n = F.size(w)
    # windows as (hash, position) in order of hash: equal windows are neighbours
    windows = F.when(
        n >= 3,
        F.array_sort(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))),
    )
    out = out.withColumns(
        {
            f"{_P}n_words": n.cast("long"),
            f"{_P}n_lines": F.size(f"{_P}lines").cast("long"),
            f"{_P}n_dup_lines": (F.size(f"{_P}lines") - F.size(F.array_distinct(f"{_P}lines"))).cast("long"),
            f"{_P}sorted": windows,
        }
    ).drop(f"{_P}words", f"{_P}lines")
    s = F.col(f"{_P}sorted")
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    twice = F.filter(s, lambda x, j: same(F.get(s, j - 1), x) | same(F.get(s, j + 1), x))
    out = out.withColumn(f"{_P}twice", F.array_sort(F.transform(twice, lambda x: x["i"])))
    # words of the windows' union: each window adds what lies beyond the one before it
    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    union = F.aggregate(
        F.col(f"{_P}twice"), zero, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"]
    )
    return out.withColumn(f"{_P}n_repeat_words", F.coalesce(union, F.lit(0).cast("long"))).drop(f"{_P}sorted", f"{_P}twice")


def base_failed() -> Column:
    return (F.col(f"{_P}n_words") < MIN_WORDS) | (100 * F.col(f"{_P}n_repeat_words") > 50 * F.col(f"{_P}n_words"))


def refused_from() -> list[Column]:
    """For each rule, the first of its cutoffs that refuses a document (their number: none does)."""
    share = lambda a, b: F.col(_P + a) / F.greatest(F.col(_P + b), F.lit(1))
    letters = share("word_chars", "n_words")
    values = {"symbols": share("n_symbols", "n_chars"), "long_words": letters, "repeated_lines": share("n_dup_lines", "n_lines"), "short_words": letters}
    out = []
    for name, cutoffs in RULES:
        first = F.lit(len(cutoffs))
        for k in range(len(cutoffs) - 1, -1, -1):
            beyond = (values[name] < cutoffs[k]) & (F.col(f"{_P}n_words") > 0) if name == "short_words" else values[name] > cutoffs[k]
            first = F.when(beyond, k).otherwise(first)
        out.append(first)
    return out


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k)."""
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, math.fsum(math.exp(log(i)) for i in range(k + 1)))


Path = list[tuple[int, ...]]


def tuned_paths(counts: list[tuple]) -> dict[str, Path]:
    """Stratum -> cutoffs of each rule, step by step, from (stratum, rule, first cutoff that refuses, tuning good documents)."""
    found: dict[str, list[list[int]]] = defaultdict(lambda: [[0] * (len(c) + 1) for _, c in RULES])
    for stratum, rule, first, n in counts:
        found[stratum][rule][first] += n
    out = {}
    for stratum, rules in found.items():
        steps = [tuple(0 for _ in RULES)]
        for level in LEVELS:
            allowed = [[k for k in range(len(c) - 1) if 1000 * sum(c[: k + 1]) <= level * sum(c)] for c in rules]
            steps.append(tuple(max(k, default=0) for k in allowed))
        out[stratum] = steps
    return out


def _step(paths: dict[str, Path], stratum: Column, firsts: list[Column]) -> Column:
    """The first step of its stratum's path that refuses a document (the path's length: never)."""
    never = len(LEVELS) + 1
    out = F.lit(never)
    for name, steps in paths.items():
        here = F.lit(never)
        for j in range(len(steps) - 1, -1, -1):
            refused = F.lit(False)
            for first, k in zip(firsts, steps[j]):
                refused = refused | (first <= k)
            here = F.when(refused, j).otherwise(here)
        out = F.when(stratum == name, here).otherwise(out)
    return out


@dataclass(frozen=True)
class Certificate:
    """What is promised for a stratum (`all`, `passed` or nothing), the cutoffs taken (None: none), and counts of the holdout's good documents."""

    stratum: str
    promise: str | None
    cutoffs: tuple[int, ...] | None
    good: int
    base_failed: int
    refused: int

    @property
    def rates(self) -> tuple[float, float]:
        """Shares of good documents refused: of all, and of those that pass the base rules."""
        return (self.base_failed + self.refused) / max(1, self.good), self.refused / max(1, self.good - self.base_failed)


def certified(stratum: str, path: Path, good: list[int], base_failed: int, bad: list[int], level: float, alpha: float = ALPHA) -> Certificate:
    """A stratum's certificate; `good` and `bad`: documents that pass the base rules, by the first step that refuses them (the last: none does)."""
    n = sum(good)
    for promise, before, of in (("all", base_failed, n + base_failed), ("passed", 0, n)):
        last = -1
        while last + 1 < len(path) and of and binomial_tail(before + sum(good[: last + 2]), of, alpha) <= level:
            last += 1
        if last >= 0:
            refused = [sum(bad[: j + 1]) for j in range(last + 1)]
            step = refused.index(refused[-1])
            return Certificate(stratum, promise, path[step], n + base_failed, base_failed, sum(good[: step + 1]))
    return Certificate(stratum, None, None, n + base_failed, base_failed, 0)


def certificates(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str | None = "lang", alpha: float = ALPHA, delta: float = DELTA) -> list[Certificate]:
    """A certificate for each stratum, from measured rows and labels (doc_id, quality): counts by stratum, rule and step are all that is collected."""
    stratum = F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) if stratum_col else F.lit("")
    known = labels.select(F.col("doc_id").cast("long").alias(f"{_P}id"), (F.col("quality") == 1).alias("good")).dropna().groupBy(f"{_P}id").agg(F.max("good").alias("good"))
    firsts = [first.alias(f"first{r}") for r, first in enumerate(refused_from())]
    judged = rows.select(F.col(f"`{id_col}`").cast("long").alias(f"{_P}id"), stratum.alias("stratum"), base_failed().alias("base_failed"), *firsts).join(known, f"{_P}id")
    judged = materialize(judged.withColumn("tuning", F.md5(F.col(f"{_P}id").cast("string").cast("binary")) < "4"))
    firsts = [F.col(f"first{r}") for r in range(len(RULES))]
    tuned = judged.filter("good and tuning and not base_failed").select("stratum", F.posexplode(F.array(*firsts)).alias("rule", "first"))
    paths = tuned_paths([tuple(r) for r in tuned.groupBy("stratum", "rule", "first").count().collect()])
    strata = [r[0] for r in judged.filter("good").select("stratum").distinct().collect()]
    paths = {s: paths.get(s, [tuple(0 for _ in RULES)] * (len(LEVELS) + 1)) for s in strata}
    found = judged.filter("not good or not tuning").groupBy("stratum", "good", "base_failed", _step(paths, F.col("stratum"), firsts).alias("step")).count().collect()
    out = []
    for s in strata:
        counts = {(r["good"], r["base_failed"], r["step"]): r["count"] for r in found if r["stratum"] == s}
        by_step = lambda good, counts=counts: [counts.get((good, False, j), 0) for j in range(len(LEVELS) + 2)]
        failed = sum(n for (good, base, _), n in counts.items() if good and base)
        out.append(certified(s, paths[s], by_step(True), failed, by_step(False), delta / (2 * len(strata)), alpha))
    return out


def verdict(found: list[Certificate], stratum_col: str | None = "lang") -> Column:
    """Is a measured row kept?"""
    stratum = F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) if stratum_col else F.lit("")
    paths = {c.stratum: [c.cutoffs] for c in found if c.cutoffs}
    return ~base_failed() & (_step(paths, stratum, refused_from()) > 0)


def quality_filter(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", stratum_col: str | None = "lang") -> DataFrame:
    """The rows of `docs` that pass, with the columns of `docs`."""
    tune(docs.sparkSession)
    stratum = F.col(f"rest.`{stratum_col}`").cast("string") if stratum_col else F.lit("")
    # texts are written with their measures, so that the verdict needs no join
    rows = materialize(measured(carried(docs, id_col, text_col).select("doc_id", stratum.alias("stratum"), "text", "rest")))
    return restored(rows.filter(verdict(certificates(rows, labels, "doc_id", "stratum"), "stratum")), docs, text_col)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: measures and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = materialize(measured(docs).drop("text"))
    found = certificates(rows, table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *[F.col(_P + c).alias(c) for c in MEASURES], base_failed().alias("base_failed"), verdict(found).alias("kept"))


def _first_sql() -> str:
    """Columns first0, first1, ...: for each rule, the first of its cutoffs that refuses a document."""
    values = {"symbols": "n_symbols / greatest(n_chars, 1)", "long_words": "word_chars / greatest(n_words, 1)", "repeated_lines": "n_dup_lines / greatest(n_lines, 1)", "short_words": "word_chars / greatest(n_words, 1)"}
    beyond = lambda name, c: f"{values[name]} < {c} AND n_words > 0" if name == "short_words" else f"{values[name]} > {c}"
    return ", ".join("CASE " + " ".join(f"WHEN {beyond(name, c)} THEN {k}" for k, c in enumerate(cutoffs)) + f" ELSE {len(cutoffs)} END AS first{r}" for r, (name, cutoffs) in enumerate(RULES))


_SPACES = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, stratum, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
             [x FOR x IN string_split(t, chr(10)) IF translate(x, {_SPACES}, '') <> ''] AS l FROM d),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM w),
z AS (SELECT doc_id, i, concat_ws(' ', x, lead(x, 1) OVER a, lead(x, 2) OVER a) AS h, lead(x, 2) OVER a AS third FROM p WINDOW a AS (PARTITION BY doc_id ORDER BY i)),
q AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS c FROM z WHERE third IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i+1, i+2]) AS j FROM q WHERE c >= 2) GROUP BY doc_id),
m AS (SELECT w.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(t, {_SPACES}, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(length(t) AS BIGINT) AS n_chars,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
s AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, {_first_sql()} FROM m),
g AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
j AS (SELECT *, md5(CAST(doc_id AS VARCHAR)) < '4' AS tuning FROM s JOIN g USING (doc_id)),
strata AS (SELECT DISTINCT stratum FROM j WHERE good),
rules AS (SELECT unnest(range({len(RULES)})) AS rule),
tn AS (SELECT stratum, rule, [first0, first1, first2, first3][rule + 1] AS f FROM j, rules WHERE good AND tuning AND NOT base_failed),
ks AS (SELECT stratum, rule, k, count(*) AS n, count(*) FILTER (WHERE f <= k) AS refused FROM tn, (SELECT unnest(range({len(RULES[0][1])})) AS k) GROUP BY ALL),
lv AS (SELECT 0 AS step, -1 AS thousandths UNION ALL SELECT unnest(range(1, {len(LEVELS) + 1})), unnest({list(LEVELS)})),
pa AS (SELECT strata.stratum, step, rules.rule, coalesce(max(k) FILTER (WHERE 1000 * refused <= thousandths * n), 0) AS cutoff
       FROM strata CROSS JOIN rules CROSS JOIN lv LEFT JOIN ks ON ks.stratum = strata.stratum AND ks.rule = rules.rule GROUP BY ALL),
st AS (SELECT stratum, step, max(cutoff) FILTER (WHERE rule = 0) AS c0, max(cutoff) FILTER (WHERE rule = 1) AS c1, max(cutoff) FILTER (WHERE rule = 2) AS c2, max(cutoff) FILTER (WHERE rule = 3) AS c3 FROM pa GROUP BY ALL),
h AS (SELECT stratum, step, good, base_failed, first0 <= c0 OR first1 <= c1 OR first2 <= c2 OR first3 <= c3 AS refused FROM j JOIN st USING (stratum) WHERE NOT (good AND tuning)),
q2 AS (SELECT stratum, step, count(*) FILTER (WHERE good) AS n_all, count(*) FILTER (WHERE good AND (base_failed OR refused)) AS r_all,
              count(*) FILTER (WHERE good AND NOT base_failed) AS n_passed, count(*) FILTER (WHERE good AND NOT base_failed AND refused) AS r_passed,
              count(*) FILTER (WHERE NOT good AND NOT base_failed AND refused) AS bad FROM h GROUP BY ALL),
t AS (SELECT stratum, step, 'all' AS promise, n_all AS n, r_all AS fr, bad FROM q2 UNION ALL SELECT stratum, step, 'passed', n_passed, r_passed, bad FROM q2),
u AS (SELECT *, n > 0 AND (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA}) + (n - i) * ln(1 - {ALPHA}))) FROM (SELECT unnest(range(fr + 1)) AS i)) <= {DELTA} / (2 * (SELECT count(*) FROM strata)) AS met FROM t),
v AS (SELECT *, bool_and(met) OVER (PARTITION BY stratum, promise ORDER BY step) AS certified FROM u),
x AS (SELECT stratum, promise, arg_min(step, struct_pack(a := -bad, b := step)) AS step FROM v WHERE certified GROUP BY ALL),
y AS (SELECT stratum, arg_min(step, promise) AS step FROM x GROUP BY stratum),
z2 AS (SELECT stratum, c0, c1, c2, c3 FROM y JOIN st USING (stratum, step))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(first0 <= c0 OR first1 <= c1 OR first2 <= c2 OR first3 <= c3, false) AS kept
FROM s LEFT JOIN z2 USING (stratum)
"""
