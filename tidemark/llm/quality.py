"""Quality rules as weak supervision.

Every rule votes good, bad or abstains. Expectation-maximisation over the counts of vote patterns estimates, for each
rule, how often it votes what on good and on bad documents (Dawid and Skene's model with abstention as a third
answer), and the share of good documents. The posterior probability of a document then replaces all-must-pass
filtering. Only DataFrame functions are used; measures, votes and posterior are row expressions, so texts are neither
shuffled nor leave the JVM. One aggregate reduces the table to at most 3^rules pattern counts, which bounds what the
estimation sees, whatever the input.

Edge cases: a null or empty text has zero words and fails the base rule. An empty table gives an empty result. Columns
of the input other than those named are ignored or kept as they are; measures live in one struct, so names cannot clash.
Window equality inside one text is taken from 64-bit hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

WINDOW = 8
SPACE = r"\x20\x09-\x0D"


def let(value: Column, body) -> Column:
    """Bind an expression once for use inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of eight words standing twice or more in the text; takes the hashes of the words."""
    size = WINDOW

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            n = F.size(s)

            def twice(x, k):
                after = (k + 1 < n) & (F.get(s, k + 1)["h"] == x["h"])
                return after | ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))

            return F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))

        def length(p: Column) -> Column:
            step = F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size))))
            return F.aggregate(step, F.lit(0), lambda a, x: a + x)

        found = let(let(pairs, positions), length)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(found)

    n = F.size(words)
    # hashes of runs of 2, 4 and 8 words, each from two of the length before; runs past the end are cut off
    joined = lambda h, d: F.zip_with(h, F.slice(h, d + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))
    runs = let(let(joined(words, 1), lambda h: joined(h, 2)), lambda h: joined(h, 4))
    return F.when(n > size, let(F.slice(runs, 1, n - (size - 1)), covered)).otherwise(0).cast("long")


def measures(text: Column) -> Column:
    """A struct of counts over the whole text."""
    text = F.coalesce(text, F.lit(""))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    # what is no small letter and no space: a fraction of the text, read once for every kind of character
    marks = F.regexp_replace(text, rf"[\p{{Ll}}{SPACE}]+", "")
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+", -1))

    def of(words: Column, hashes: Column, marks: Column, lines: Column) -> Column:
        kept = lambda pattern: F.length(F.regexp_replace(marks, f"[^{pattern}]+", "")).cast("long")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            kept(r"#*$%&|<>").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(hashes).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            kept(r"\p{Lu}").alias("n_upper"),
            F.length(F.regexp_replace(marks, r"\p{L}+", "")).cast("long").alias("n_marks"),
            kept(r"!").alias("n_calls"),
            F.size(F.array_distinct(hashes)).cast("long").alias("n_distinct"),
        )

    with_hashes = lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: with_marks(w, h))
    with_marks = lambda w, h: let(marks, lambda m: let(lines, lambda x: of(w, h, m, x)))
    return let(words, with_hashes)


@dataclass(frozen=True)
class Rule:
    """Votes bad above ``bad`` and good up to ``good``; in between, or without a ratio, it abstains."""

    name: str
    ratio: str
    good: float
    bad: float

    def vote(self) -> Column:
        ratio = F.expr(self.ratio.replace("$", "_m."))
        return F.when(ratio > self.bad, 0).when(ratio <= self.good, 1).otherwise(2)


# ratios over the measures; $ stands for the struct, a ratio over zero is null and abstains
RULES = (
    Rule("symbols", "try_divide($n_symbols, $n_words)", 0.02, 0.1),
    Rule("duplicate_lines", "try_divide($n_dup_lines, $n_lines)", 0.1, 0.3),
    Rule("repeated_windows", "try_divide($n_repeat_words, $n_words)", 0.05, 0.2),
    Rule("capitals", "try_divide($n_upper, $word_chars)", 0.15, 0.4),
    Rule("calls", "try_divide($n_calls, $n_words)", 0.02, 0.1),
    Rule("few_letters", "try_divide($n_marks, $word_chars)", 0.12, 0.25),
    Rule("word_length", "abs(try_divide($word_chars, $n_words) - 6)", 2.5, 4.0),
    Rule("repeated_vocabulary", "if($n_words >= 20, 1 - $n_distinct / least($n_words, 50 * sqrt($n_words)), null)", 0.4, 0.75),
)


@dataclass(frozen=True)
class Model:
    """Share of good documents and, per rule, the probabilities of voting bad, good or nothing on (bad, good) ones."""

    prior: float
    votes: tuple[tuple[tuple[float, ...], tuple[float, ...]], ...]

    def logit(self, pattern) -> float:
        z = math.log(self.prior) - math.log(1 - self.prior)
        return z + sum(math.log(v[1][x]) - math.log(v[0][x]) for v, x in zip(self.votes, pattern))

    def posterior(self, pattern: list[Column]) -> Column:
        z = F.lit(math.log(self.prior) - math.log(1 - self.prior))
        for (bad, good), x in zip(self.votes, pattern):
            part = F.lit(math.log(good[2]) - math.log(bad[2]))
            for k in (0, 1):
                part = F.when(x == k, math.log(good[k]) - math.log(bad[k])).otherwise(part)
            z = z + part
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def start_model(rules: int, prior: float = 0.85, accuracy: float = 0.75, silence: float = 0.2) -> Model:
    """Every rule is better than chance, which tells the two classes apart."""
    speak = 1 - silence
    bad, good = (speak * accuracy, speak * (1 - accuracy), silence), (speak * (1 - accuracy), speak * accuracy, silence)
    return Model(prior, tuple((bad, good) for _ in range(rules)))


def estimate(counts: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 60, strength: float = 20.0) -> Model:
    """Expectation-maximisation over counts of vote patterns, at most 3^rules of them.

    ``strength``: documents' worth of belief in the starting model, which also keeps every probability above zero.
    """
    begin = model = start_model(rules)
    for _ in range(rounds):
        mass = [0.0, 0.0]
        seen = [[[0.0] * 3, [0.0] * 3] for _ in range(rules)]
        for pattern, n in counts:
            good = 1 / (1 + math.exp(-model.logit(pattern)))
            for c, share in ((0, n * (1 - good)), (1, n * good)):
                mass[c] += share
                for r, x in enumerate(pattern):
                    seen[r][c][x] += share
        votes = tuple(
            tuple(
                tuple((seen[r][c][x] + strength * begin.votes[r][c][x]) / (mass[c] + strength) for x in range(3))
                for c in (0, 1)
            )
            for r in range(rules)
        )
        prior = (mass[1] + strength * begin.prior) / (mass[0] + mass[1] + strength)
        model = Model(prior, votes)
    return model


def _judged(documents: DataFrame, *keep: Column, rules=RULES) -> DataFrame:
    """``keep`` with ``_m`` (measures), ``_failed`` and ``_v`` (votes)."""
    m = documents.select(*keep, measures(F.col("text")).alias("_m"))
    failed = (F.col("_m.n_words") < 20) | (100 * F.col("_m.n_repeat_words") > 30 * F.col("_m.n_words"))
    return m.select("*", failed.alias("_failed"), F.array(*[r.vote() for r in rules]).alias("_v"))


def fit(judged: DataFrame, rules=RULES, rounds: int = 60) -> Model:
    """The rules' accuracies on documents that pass the base rule."""
    patterns = judged.filter(~F.col("_failed")).groupBy("_v").count().collect()  # at most 3^rules rows
    return estimate(sorted((tuple(r["_v"]), r["count"]) for r in patterns), len(rules), rounds)


def verdict(model: Model, rules=RULES) -> Column:
    return model.posterior([F.col("_v")[k] for k in range(len(rules))])


def score_quality(documents: DataFrame, threshold: float = 0.5, rules=RULES) -> DataFrame:
    """Measures, ``base_failed``, ``quality`` (posterior) and ``kept`` per document."""
    judged = materialise(_judged(documents, F.col("doc_id"), rules=rules), "judged")
    good = verdict(fit(judged, rules), rules)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *[F.col(f"_m.{n}").alias(n) for n in names], F.col("_failed").alias("base_failed"),
        F.round(good, 9).alias("quality"), (~F.col("_failed") & (good >= threshold)).alias("kept"),
    )


def keep_good(documents: DataFrame, threshold: float = 0.5, rules=RULES) -> DataFrame:
    """The documents whose posterior reaches the threshold, with their columns as they came.

    Votes are written next to the rows, so that texts are measured once.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    judged = _judged(documents, row, rules=rules)
    judged = materialise(judged.filter(~F.col("_failed")).select("_row", "_failed", "_v"), "judged")
    return judged.filter(verdict(fit(judged, rules), rules) >= threshold).select("_row.*")
