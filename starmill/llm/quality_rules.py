"""Rules of text quality: fixed counts, and a decision list learned from labels.

Every count is an expression on one text. The decision list is learned by sequential covering:
a rule starts empty and grows by the threshold test with the largest information gain; then
tests are dropped from its end where that raises (rejected - kept) / (rejected + kept) on
labelled documents it was not grown from; then what it covers is taken out, until the next
rule is right for fewer than ``PRECISION`` of those. Rules reject; what no rule covers stays.
The list becomes one chain of Spark conditions. It is learned on the driver from the counts,
not the texts, of at most ``ROWS`` labelled documents.

NULL and empty texts have no words. Shares of a text without words are 0. Without labels of
both kinds there is no rule.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm import labelled

BLANK = r"[\x20\x09-\x0D]"
ROWS = 20_000
HELD_OUT = (3, 1)
MAX_RULES, MAX_TESTS, CUTS = 12, 4, 24
PRECISION, LEAST_COVERED = 0.9, 5

# The counts that rules test, per word or per character so that length alone decides little.
FEATURES = {
    "n_words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}


def counts(rows: DataFrame) -> DataFrame:
    """Adds the counts of ``_text`` to rows; the text itself is dropped."""
    others = [c for c in rows.columns if c != "_text"]
    split = rows.select(
        *others,
        "_text",
        F.filter(F.split("_text", BLANK + "+"), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
    )
    only = lambda kept: F.length(F.regexp_replace("_text", kept, "")).cast("bigint")
    hashed = split.select(
        *others,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        only(r"[^#*$%&|<>]+").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.array_distinct("_words")).cast("bigint").alias("n_distinct"),
        only(r"[^A-Z]+").alias("n_capitals"),
        only(r"[^!?]+").alias("n_marks"),
        F.when(
            F.size("_words") >= 5,
            F.expr("transform(sequence(1, size(_words) - 4), i -> xxhash64(slice(_words, i, 5)))"),
        )
        .otherwise(F.expr("cast(array() AS array<bigint>)"))
        .alias("_windows"),
    )
    kept = [c for c in hashed.columns if c != "_windows"]
    # Only texts with a repeated window need the positions; sorting brings equal ones together.
    repeats = hashed.select(
        *kept,
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_sorted"),
    )
    places = repeats.select(
        *kept,
        F.expr("""
            sort_array(transform(
              filter(sequence(0, size(_sorted) - 1), k ->
                (k > 0 AND _sorted[if(k > 0, k - 1, 0)].h = _sorted[k].h) OR
                (k + 1 < size(_sorted) AND
                 _sorted[if(k + 1 < size(_sorted), k + 1, 0)].h = _sorted[k].h)),
              k -> _sorted[k].i))
        """).alias("_at"),
    )
    covered = F.expr("""
        aggregate(sequence(0, size(_at) - 1), 0L, (sum, k) ->
          sum + if(k + 1 < size(_at), least(5, _at[if(k + 1 < size(_at), k + 1, 0)] - _at[k]), 5))
    """)
    return places.select(*kept, F.when(F.col("_at").isNull(), F.lit(0)).otherwise(covered).cast("bigint").alias("n_repeat_words"))


# --- learning on the driver, from a bounded table of numbers ----------------------------


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    cut: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.cut if self.above else row[self.feature] <= self.cut

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature]).cast("double")
        return value > self.cut if self.above else value <= self.cut


def _cuts(rows: list[dict]) -> dict[str, list[float]]:
    """Midpoints between neighbouring quantiles of each feature."""
    out = {}
    for name in FEATURES:
        values = sorted({r[name] for r in rows})
        steps = min(CUTS, len(values) - 1)
        places = {round(k * (len(values) - 1) / (steps + 1)) for k in range(1, steps + 1)} if steps > 0 else set()
        ordered = sorted(r[name] for r in rows)
        ranks = {ordered[round(k * (len(ordered) - 1) / (CUTS + 1))] for k in range(1, CUTS + 1)}
        marks = sorted({values[p] for p in places if p + 1 < len(values)} | {v for v in ranks if v < values[-1]})
        after = dict(zip(values, values[1:], strict=False))
        out[name] = [(v + after[v]) / 2 for v in marks]
    return out


def _grow(bad: list[dict], good: list[dict], cuts: dict[str, list[float]]) -> list[Test]:
    rule: list[Test] = []
    while good and len(rule) < MAX_TESTS:
        before = math.log2(len(bad) / (len(bad) + len(good)))
        best, gain = None, 0.0
        for name, marks in cuts.items():
            p_values, n_values = sorted(r[name] for r in bad), sorted(r[name] for r in good)
            i = j = 0
            for cut in marks:
                while i < len(p_values) and p_values[i] <= cut:
                    i += 1
                while j < len(n_values) and n_values[j] <= cut:
                    j += 1
                for above, p, n in ((False, i, j), (True, len(p_values) - i, len(n_values) - j)):
                    if p >= LEAST_COVERED:
                        value = p * (math.log2(p / (p + n)) - before)
                        if value > gain + 1e-9:
                            best, gain = Test(name, above, cut), value
        if best is None:
            break
        rule.append(best)
        bad, good = [r for r in bad if best.holds(r)], [r for r in good if best.holds(r)]
    return rule


def _covered(rule: list[Test], rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(t.holds(r) for t in rule)]


def learn(rows: list[dict]) -> list[list[Test]]:
    """Rules that reject, from rows of features with ``label`` (0: reject) and ``doc_id``."""
    grow = [r for r in rows if r["fold"] != 0]
    prune = [r for r in rows if r["fold"] == 0]
    rules: list[list[Test]] = []
    if not any(r["label"] for r in rows) or all(r["label"] for r in rows):
        return rules
    cuts = _cuts(rows)
    while len(rules) < MAX_RULES:
        bad, good = ([r for r in grow if r["label"] == k] for k in (0, 1))
        if len(bad) < LEAST_COVERED:
            break
        rule = _grow(bad, good, cuts)

        def worth(tests: list[Test]) -> tuple[float, float]:
            """On documents the rule was not grown from; ties go to the better on all."""
            values = []
            for part in (prune, rows):
                hit = _covered(tests, part)
                wrong = sum(r["label"] for r in hit)
                values.append((len(hit) - 2 * wrong) / len(hit) if hit else -1.0)
            return values[0], values[1]

        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=[])
        hit = _covered(rule, rows)
        right = sum(1 - r["label"] for r in hit)
        if not rule or right < max(LEAST_COVERED, PRECISION * len(hit)):
            break
        rules.append(rule)
        grow = [r for r in grow if not all(t.holds(r) for t in rule)]
        prune = [r for r in prune if not all(t.holds(r) for t in rule)]
        rows = [r for r in rows if not all(t.holds(r) for t in rule)]
    return rules


def decision(rules: list[list[Test]]) -> Column:
    """The number of the first rule that rejects, or NULL."""
    out = F.lit(None).cast("int")
    for k in range(len(rules) - 1, -1, -1):
        every = F.lit(True)
        for test in rules[k]:
            every = every & test.column()
        out = F.when(every, F.lit(k + 1)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> list[list[Test]]:
    allowed = labelled.remainder(HELD_OUT[0]) != HELD_OUT[1]
    sample = counts(labelled.sample(docs, labels, "quality", rows, allowed))
    values = [F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()]
    fold = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(3)).alias("fold")
    got = sample.select("doc_id", (F.col("label") > 0).cast("int").alias("label"), fold, *values).collect()
    return learn(sorted((r.asDict() for r in got), key=lambda r: r["doc_id"]))


def judge(docs: DataFrame, rules: list[list[Test]]) -> DataFrame:
    """One row per row of ``docs``: the counts, base_failed, kept, and the rule that rejected."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    ruled = counts(rows).select("*", base.alias("base_failed"), decision(rules).alias("rule"))
    return ruled.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule",
    )


def score(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    return judge(docs, fit(docs, labels, rows))
