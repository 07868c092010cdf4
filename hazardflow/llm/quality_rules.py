"""Quality rules as a decision list learned by sequential covering.

Statistics of a text are native column expressions. A list is learned from labelled statistics: a rule
is grown by adding the threshold that gains most information about the bad rows, pruned on rows held
aside for that, and kept while it stays precise; the rows it covers are taken out and the next rule is
grown. The rules become one ordered CASE expression, so applying them is part of the scan: no Python
runs on the executors.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame, functions as F

from hazardflow.llm.store import least_rows

#: Most labelled rows the rules are learned from, taken in hash order of their ids.
MOST_LABELLED = 20_000
#: Least share of bad rows among those a rule covers, and least bad rows it covers.
PRECISION, SUPPORT = 0.9, 8
MOST_RULES, MOST_CONDITIONS = 12, 3
#: Thresholds tried for each statistic.
CUTS = 24

#: Characters between words, and the symbols counted by ``n_symbols``. Fixed values.
SPACE = "[ \\t\\n\\x0B\\f\\r]"
SYMBOLS = "#*$%&|<>"
#: Words of a window of ``n_repeat_words``.
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_echoes")
#: Statistics that rules put thresholds on, from the counts; per 1,000 where they are shares.
RATIOS = {
    "words": "n_words",
    "word_length": "floor(1000 * word_chars / greatest(n_words, 1))",
    "symbols": "floor(1000 * n_symbols / greatest(word_chars, 1))",
    "dup_lines": "floor(1000 * n_dup_lines / greatest(n_lines, 1))",
    "repeats": "floor(1000 * n_repeat_words / greatest(n_words, 1))",
    "upper": "floor(1000 * n_upper / greatest(word_chars, 1))",
    "marks": "floor(1000 * n_marks / greatest(word_chars, 1))",
    "echoes": "floor(1000 * n_echoes / greatest(n_words, 1))",
    "line_words": "floor(n_words / greatest(n_lines, 1))",
}


def _let(value: Column, function) -> Column:
    """``function`` of a value that is computed once, however often the function names it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated(hashes: Column) -> Column:
    """Words in windows that occur twice or more, from the hashes of all windows in order."""

    def covered(sorted_rows: Column) -> Column:
        def place(row: Column, i: Column) -> Column:
            near = (F.get(sorted_rows, i - 1)["h"] == row["h"]) | (F.get(sorted_rows, i + 1)["h"] == row["h"])
            return F.when(near, row["i"])

        places = F.array_sort(F.filter(F.transform(sorted_rows, place), lambda p: p.isNotNull()))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            places, start,
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    return _let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``COUNTS`` (long) in place of the text; a null text counts as empty."""
    value = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        *[c for c in docs.columns if c != text], value.alias("__text"),
        F.filter(F.split(value, SPACE + "+"), lambda w: w != "").alias("__words"),
        F.filter(F.split(value, "\n"), lambda line: F.length(F.translate(line, " \t\x0b\x0c\r", "")) > 0).alias("__lines"),
    )
    words, content = F.col("__words"), F.col("__text")
    windows = split.withColumn(
        "__windows",
        F.when(F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")),
    )
    hashes = F.col("__windows")
    repeats = F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _repeated(hashes)).otherwise(0)
    echoes = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(a == b, 1))
    return windows.select(
        *[c for c in docs.columns if c != text],
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length(content) - F.length(_without(content, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.length(content) - F.length(_without(content, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).cast("long").alias("n_upper"),
        (F.length(content) - F.length(_without(content, "!?"))).cast("long").alias("n_marks"),
        F.size(F.array_compact(echoes)).cast("long").alias("n_echoes"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclasses.dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return (row[self.name] > self.threshold) == self.above

    def __str__(self) -> str:
        return f"{RATIOS[self.name]} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _tally(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    """Bad and good rows covered."""
    bad = good = 0
    for row in rows:
        if _covers(rule, row):
            bad, good = bad + row["bad"], good + 1 - row["bad"]
    return bad, good


def _candidates(rows: list[dict]) -> list[Condition]:
    out = []
    for name in RATIOS:
        values = sorted(row[name] for row in rows)
        cuts = {values[len(values) * i // CUTS] for i in range(CUTS)} | {values[-1 - len(values) // 200], 0}
        out += [Condition(name, above, cut) for cut in sorted(cuts) for above in (True, False)]
    return out


def _grow(rows: list[dict], candidates: list[Condition]) -> Rule:
    """Add the condition of the greatest gain until no good row is covered or none gains."""
    rule: Rule = ()
    covered = rows
    while len(rule) < MOST_CONDITIONS:
        bad = sum(r["bad"] for r in covered)
        if not bad or bad == len(covered):
            break
        before, best = math.log2(bad / len(covered)), (1e-9, None, None)
        for condition in candidates:
            kept = [r["bad"] for r in covered if condition.holds(r)]
            hits = sum(kept)
            if hits >= SUPPORT:
                gain = hits * (math.log2(hits / len(kept)) - before)
                if gain > best[0]:
                    best = gain, condition, None
        if best[1] is None:
            break
        rule += (best[1],)
        covered = [r for r in covered if best[1].holds(r)]
    return rule


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    """The beginning of the rule with the best share of bad rows on the rows held aside."""

    def worth(length: int) -> float:
        bad, good = _tally(rule[:length], rows)
        return (bad + 1) / (bad + good + 2)

    return rule[: max(range(1, len(rule) + 1), key=lambda n: (worth(n), -n))] if rule else rule


def learn(rows: list[dict]) -> list[Rule]:
    """Ordered rules for bad rows; each row has the statistics of ``RATIOS`` and ``bad`` (0 or 1)."""
    grow, aside, rules = rows[: 2 * len(rows) // 3], rows[2 * len(rows) // 3 :], []
    candidates = _candidates(rows) if rows else []
    while len(rules) < MOST_RULES:
        rule = _prune(_grow(grow, candidates), aside)
        if not rule:
            break
        bad, good = (sum(x) for x in zip(_tally(rule, grow), _tally(rule, aside)))
        if bad < SUPPORT or bad < PRECISION * (bad + good):
            break
        rules.append(rule)
        grow = [r for r in grow if not _covers(rule, r)]
        aside = [r for r in aside if not _covers(rule, r)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that covers a row, null if none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(F.expr(" AND ".join(map(str, rule))), number).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> list[Rule]:
    """Rules that cover rows of label 0, from ``labels`` (doc_id, ``label``) and ``docs`` (doc_id, text).

    Rows with a null id or label are left out. Equal texts of an id count once. At most ``most`` labels
    are used, the first in hash order of their ids, and of their texts as many, in hash order of id and text,
    however often an id stands in ``docs``; only statistics reach the driver. Without labels there are no rules.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    rows = rows.sort(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = statistics(texts.join(F.broadcast(rows), "doc_id").withColumn("key", F.xxhash64("doc_id", "text")))
    bad = (1 - F.col("label")).alias("bad")
    found = found.select(bad, "key", F.xxhash64("doc_id").alias("order"), *[F.expr(sql).cast("long").alias(name) for name, sql in RATIOS.items()])
    found = least_rows(found.dropDuplicates(["key", "bad"]), most, "key", "bad")
    given = [row.asDict() for row in found.collect()]
    return learn(sorted(given, key=lambda r: tuple(r[k] for k in ("order", "bad", *RATIOS))))


def apply(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, rule, kept) of every row.

    ``rule`` is the number of the first rule that covers the row. A row is kept unless the base
    check fails or a rule covers it. A null or empty text has zero counts and fails the base check;
    null and repeated ids are passed on.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = statistics(docs).select("doc_id", *COUNTS, base_failed().alias("base_failed"), verdict(rules).alias("rule"))
    return counted.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
