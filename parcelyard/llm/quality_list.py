"""Quality rules: an ordered list of threshold conjunctions learned from labels.

Statistics are DataFrame functions over whole texts. A decision list is learned by
sequential covering from the statistics of labelled documents: a rule grows by the
condition with the best information gain, is pruned on held-back rows, and the rows
it covers leave the training set before the next one is grown. The list becomes one
ordered Spark conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.storage import carried, text_or_empty

#: White space between words, and the characters that count as symbols.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE_COUNTS = ["n_distinct_words", "n_lines", "n_capitals", "n_exclamations", "n_digits"]


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES)
    )


def _window_hashes(words: Column) -> Column:
    """Hash and start of every three-word window, ordered by hash.

    Neighbours are zipped rather than looked up, here and below: a lambda that refers
    to another column would compute that column anew for every element wherever the
    optimizer merges the two.
    """
    n = F.size(words)
    triples = F.arrays_zip(
        words.alias("a"),
        F.slice(words, F.lit(2), n).alias("b"),
        F.slice(words, F.lit(3), n).alias("c"),
    )
    whole = F.slice(triples, F.lit(1), F.greatest(n - 2, F.lit(0)))
    return F.sort_array(
        F.transform(
            whole, lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("p"))
        )
    )


def _repeated_starts(windows: Column) -> Column:
    """Starts of the windows whose hash a neighbour in hash order shares."""
    hashes = F.transform(windows, lambda x: x["h"])
    zipped = F.arrays_zip(
        windows.alias("this"),
        F.concat(F.array(F.lit(None).cast("long")), hashes).alias("last"),
        F.slice(hashes, F.lit(2), F.size(hashes)).alias("next"),
    )

    def shared(x: Column) -> Column:
        same = (x["this"]["h"] == x["last"]) | (x["this"]["h"] == x["next"])
        return F.coalesce(same, F.lit(False)) & x["this"].isNotNull()

    return F.sort_array(F.transform(F.filter(zipped, shared), lambda x: x["this"]["p"]))


def _covered(starts: Column) -> Column:
    """Words inside the windows that begin at the sorted ``starts``."""
    nothing = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(
        starts,
        nothing,
        lambda a, x: F.struct(
            (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")
        ),
    )["n"].cast("long")


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with the counts of each text; a null text counts as empty.

    Every count covers the whole text. Work and memory per row grow with the text's
    own length only (times a logarithm), and no row is shuffled.
    """
    whole = text_or_empty(text)
    lines = F.filter(
        F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""
    )
    kept = carried(df, text, *COUNTS, *MORE_COUNTS)
    split = df.select(
        F.struct(*kept).alias("row") if kept else F.lit(None).cast("string").alias("row"),
        F.length(F.translate(whole, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        _count_of(whole, SYMBOLS).alias("n_symbols"),
        _count_of(whole, CAPITALS).alias("n_capitals"),
        _count_of(whole, "!").alias("n_exclamations"),
        _count_of(whole, "0123456789").alias("n_digits"),
        lines.alias("lines"),
        _words(whole).alias("words"),
    )
    counted = split.select(
        *[c for c in split.columns if c not in ("lines", "words")],
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _window_hashes(F.col("words")).alias("windows"),
    )
    found = counted.select(
        *[c for c in counted.columns if c != "windows"],
        _covered(_repeated_starts(F.col("windows"))).alias("n_repeat_words"),
    )
    return found.select(*(["row.*"] if kept else []), *COUNTS, *MORE_COUNTS)


def _share(top: str, bottom: str) -> Column:
    return F.coalesce(F.try_divide(F.col(top), F.col(bottom)), F.lit(0.0))


#: What rules look at. Variety is the logarithm of the distinct words over that of all
#: words, as their plain share falls with the length of any text. Word length is left
#: out: it tells languages apart better than it tells quality.
FEATURES = {
    "symbol_share": lambda: _share("n_symbols", "word_chars"),
    "capital_share": lambda: _share("n_capitals", "word_chars"),
    "exclamation_share": lambda: _share("n_exclamations", "word_chars"),
    "digit_share": lambda: _share("n_digits", "word_chars"),
    "duplicate_line_share": lambda: _share("n_dup_lines", "n_lines"),
    "repeated_word_share": lambda: _share("n_repeat_words", "n_words"),
    "variety": lambda: F.when(
        F.col("n_words") > 1, F.ln("n_distinct_words") / F.ln("n_words")
    ).otherwise(1.0),
}


def feature(name: str) -> Column:
    return FEATURES[name]()


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold``, or ``feature < threshold``."""

    name: str
    at_least: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return (row[self.name] >= self.threshold) == self.at_least

    def column(self) -> Column:
        value = feature(self.name)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]
Labelled = tuple[dict[str, float], bool]


def _covers(rule: Rule, row: dict[str, float]) -> bool:
    return all(c.holds(row) for c in rule)


def _best_condition(rows: list[Labelled]) -> Condition | None:
    """The single condition with the highest gain in information about the bad rows."""
    bad = sum(y for _, y in rows)
    if not bad or bad == len(rows):
        return None
    before = math.log2(bad / len(rows))
    best, best_gain = None, 1e-9
    for name in FEATURES:
        ordered = sorted((x[name], y) for x, y in rows)
        seen_bad = 0
        for k in range(1, len(ordered)):
            seen_bad += ordered[k - 1][1]
            low, high = ordered[k - 1][0], ordered[k][0]
            if low == high:
                continue
            for at_least, p, n in ((False, seen_bad, k), (True, bad - seen_bad, len(rows) - k)):
                if p:
                    gain = p * (math.log2(p / n) - before)
                    if gain > best_gain:
                        best, best_gain = Condition(name, at_least, (low + high) / 2), gain
    return best


def _grow(rows: list[Labelled], most_conditions: int) -> Rule:
    rule: Rule = ()
    while len(rule) < most_conditions and (best := _best_condition(rows)):
        rule += (best,)
        rows = [r for r in rows if best.holds(r[0])]
    return rule


def _worth(rule: Rule, rows: list[Labelled]) -> tuple[float, int]:
    """Share of bad among the rows covered, cautiously counted, and how many are bad."""
    hits = [y for x, y in rows if _covers(rule, x)]
    return (sum(hits) / (len(hits) + 1), sum(hits)) if hits else (0.0, 0)


def _prune(rule: Rule, rows: list[Labelled]) -> Rule:
    """The leading conditions that do best on rows the rule was not grown on."""
    if not rule:
        return rule
    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: _worth(r, rows))


def learn(
    rows: list[Labelled],
    least_precision: float = 0.95,
    least_hits: int = 3,
    most_rules: int = 12,
    most_conditions: int = 4,
) -> list[Rule]:
    """Sequential covering over (features, is bad) rows.

    Every third row is held back for pruning. A rule is added while at least
    ``least_precision`` of what it covers among the held-back rows is bad and it
    finds ``least_hits`` bad ones there; no labelled rows give an empty list.
    """
    grow = [r for i, r in enumerate(rows) if i % 3 != 2]
    hold = [r for i, r in enumerate(rows) if i % 3 == 2]
    rules: list[Rule] = []
    while len(rules) < most_rules:
        rule = _prune(_grow(grow, most_conditions), hold)
        share, hits = _worth(rule, hold)
        if not rule or hits < least_hits or share * (1 + 1 / hits) < least_precision:
            break
        rules.append(rule)
        grow = [r for r in grow if not _covers(rule, r[0])]
        hold = [r for r in hold if not _covers(rule, r[0])]
    return rules


def labelled_rows(
    df: DataFrame, labels: DataFrame, most_rows: int = 6000, key: str = "doc_id"
) -> list[Labelled]:
    """Features of at most ``most_rows`` labelled documents, those with the smallest key hash.

    Labels without a key or a quality are left out. The broadcast and what reaches
    the driver are bounded by ``most_rows`` labels.
    """
    order = F.xxhash64(F.col(key))
    picked = (
        labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(key)
        .agg(F.min("quality").alias("quality"))
        .orderBy(order, key)
        .limit(most_rows)
    )
    texts = df.select(key, "text").join(F.broadcast(picked), key)
    found = (
        statistics(texts)
        .orderBy(order, key)
        .limit(2 * most_rows)
        .select("quality", *[feature(n).alias(n) for n in FEATURES])
        .collect()
    )
    return [({n: r[n] for n in FEATURES}, r["quality"] == 0) for r in found]


def first_rule(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; null if none does."""
    verdict = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        held = F.lit(True)
        for condition in rules[k - 1]:
            held = held & condition.column()
        verdict = F.when(held, F.lit(k)).otherwise(verdict)
    return verdict


def judged(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` without its text, with counts, ``base_failed``, ``rule`` and ``kept``.

    A null or empty text has no words and fails the base test. Repeated rows are
    judged alike, one result row each; columns of ``df`` named like a result give way.
    """
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    counted = statistics(df.select(*carried(df, "base_failed", "rule", "kept")))
    return counted.withColumns({"base_failed": failed, "rule": first_rule(rules)}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def accepted(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``df``, all columns untouched, that ``judged`` keeps."""
    row = F.struct(*df.columns).alias("_row")
    found = judged(df.select(row, "text"), rules)
    # the partition number is there so that the optimizer leaves the filter above the
    # statistics; below them, it would compute each one anew for every mention
    return found.withColumn("_part", F.spark_partition_id()).filter("kept AND _part >= 0").select("_row.*")
