"""Quality rules by weak supervision, in DataFrame functions alone: rules vote or abstain, and
expectation-maximisation finds out how far each can be trusted."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclaim"]


def count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns ``STATS``, counted over the whole text (NULL: zeros); columns of these names are replaced.

    Words stand between space and \\t to \\r.  n_dup_lines: lines with a word that equal an earlier line.
    n_repeat_words: words inside any three-word window that the text holds twice or more, the first included.
    A row stays one row: windows are hashed and sorted in an array of their own text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    own = docs.drop(*STATS).withColumn("__text", whole)
    trimmed = F.btrim("__text", F.lit(SPACES))
    own = own.withColumns({
        "__words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")),
        "__lines": F.filter(F.split("__text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != ""),
        "word_chars": F.length(F.translate("__text", SPACES, "")).cast("long"),
        "n_symbols": count_of(F.col("__text"), SYMBOLS),
        "n_upper": count_of(F.col("__text"), UPPER),
        "n_exclaim": count_of(F.col("__text"), "!"),
    })
    words = F.col("__words")
    triple = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    own = own.withColumns({
        "n_words": F.size("__words").cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__windows": F.when(F.size("__words") >= 4, F.transform(F.sequence(F.lit(0), F.size("__words") - 3), triple)).otherwise(F.array().cast("array<bigint>")),
    })
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    own = own.withColumn("__sorted", F.when(repeats, F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = F.col("__sorted")
    same = lambda e, j: F.coalesce(e["h"] == F.get(near, j - 1)["h"], F.lit(False)) | F.coalesce(e["h"] == F.get(near, j + 1)["h"], F.lit(False))
    own = own.withColumn("__places", F.sort_array(F.transform(F.filter("__sorted", same), lambda e: e["i"])))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    add = lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"))
    own = own.withColumn("n_repeat_words", F.coalesce(F.aggregate("__places", start, add, lambda a: a["n"]), F.lit(0).cast("long")))
    return own.select(*[c for c in docs.columns if c not in STATS], *STATS)


def default_rules() -> dict[str, Column]:
    """Votes over the columns of ``text_stats``: 1 for, -1 against, 0 no opinion."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))

    def vote(against: Column, good: Column) -> Column:
        return F.when(against, -1).when(good, 1).otherwise(0)

    mean, symbols, caps = F.col("word_chars") / words, F.col("n_symbols") / words, F.col("n_upper") / F.greatest("word_chars", F.lit(1))
    shouts, repeats, twice = F.col("n_exclaim") / words, F.col("n_repeat_words") / words, F.col("n_dup_lines") / lines
    return {
        "length": vote(F.col("n_words") < 20, F.col("n_words") >= 50),
        "word_length": vote((mean < 2.5) | (mean > 12), (mean >= 3.5) & (mean <= 9)),
        "symbols": vote(symbols > 0.1, symbols <= 0.02),
        "shouting": vote((caps > 0.3) | (shouts > 0.1), (caps <= 0.12) & (shouts <= 0.02)),
        "repeats": vote(repeats > 0.4, repeats <= 0.1),
        "double_lines": vote((twice >= 0.5) & (F.col("n_lines") >= 4), (twice <= 0.1) & (F.col("n_lines") >= 4)),
    }


class Trust:
    """What expectation-maximisation has learned: the share of good documents, and for each rule how often a vote on
    a bad and on a good document is against it.  Abstaining says nothing."""

    def __init__(self, good: float, against: list[tuple[float, float]]):
        self.good, self.against = good, against

    def odds(self) -> list[tuple[float, float]]:
        """Of each rule: what a vote against and a vote for add to the log-odds of good quality."""
        return [(math.log(g / b), math.log((1 - g) / (1 - b))) for b, g in self.against]

    def posterior(self, votes: tuple[int, ...]) -> float:
        total = math.log(self.good / (1 - self.good)) + sum(o[v > 0] for v, o in zip(votes, self.odds()) if v)
        return 1 / (1 + math.exp(-total))

    def column(self, votes: list[Column]) -> Column:
        total = F.lit(math.log(self.good / (1 - self.good)))
        for v, (no, yes) in zip(votes, self.odds()):
            total = total + F.when(v < 0, no).when(v > 0, yes).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def accuracies(self) -> list[float]:
        """Of each rule: how often it is right when it votes, were its votes spread like the classes."""
        return [self.good * (1 - g) + (1 - self.good) * b for b, g in self.against]


#: How many votes are against a document before anything is learned: a bad document mostly has one fault, and the
#: rules for other faults vote for it; a rule seldom blames a good one.
BAD, GOOD, SHARE = 0.28, 0.002, 0.85


def corroborated(patterns: Mapping[tuple[int, ...], int], lift: float = 1.5) -> list[bool]:
    """Of each rule: whether it votes against documents that another rule is against at least ``lift`` times as often as
    against the others, 20 made-up votes at the latter rate included."""
    out = []
    for r in range(len(next(iter(patterns), ()))):
        alone, company = [0, 0], [0, 0]  # votes, those against
        for votes, count in patterns.items():
            if votes[r]:
                n = company if any(v < 0 for i, v in enumerate(votes) if i != r) else alone
                n[0] += count
                n[1] += count * (votes[r] < 0)
        rate = alone[1] / max(alone[0], 1)
        out.append(company[1] > 0 and company[1] + 20 * rate >= lift * rate * (company[0] + 20))
    return out


def learn(patterns: Mapping[tuple[int, ...], int], prior: float = 0.02, blame: float = 0.002, most: int = 500, close: float = 1e-9, good_prior: float = 0.1) -> Trust:
    """Expectation-maximisation over counted vote patterns.

    Votes are independent given the class.  It starts from ``BAD``, ``GOOD`` and ``SHARE`` and is held to them by
    made-up votes, 20 and for each document ``prior`` (``good_prior`` for votes on good documents), so it learns alike
    at every size.  How often a rule is against bad and against good documents is learned freely where the rules are
    ``corroborated``.  Where a rule's votes against do not come with those of others, the patterns of a fault that never
    comes with another and of a rule that misfires are the same: such a rule is believed, that is, taken to blame at
    most the share ``blame`` of good documents, and one vote against rejects.  Without documents the start is the result.
    """
    n_rules = len(next(iter(patterns), ()))
    trust = Trust(SHARE, [(BAD, GOOD)] * n_rules)
    total, last = sum(patterns.values()), -math.inf
    held, held_good = 20 + prior * total, 20 + good_prior * total
    free = corroborated(patterns)
    for _ in range(most if total else 0):
        cast = [[held, held_good] for _ in range(n_rules)]  # votes on bad and on good documents
        against = [[held * BAD, held_good * GOOD] for _ in range(n_rules)]
        good = SHARE * held
        for votes, count in patterns.items():
            p = trust.posterior(votes)
            good += count * p
            for v, n, no in zip(votes, cast, against):
                if v:
                    n[0] += count * (1 - p)
                    n[1] += count * p
                if v < 0:
                    no[0] += count * (1 - p)
                    no[1] += count * p
        shares = [(no[0] / n[0], no[1] / n[1]) for n, no in zip(cast, against)]
        shares = [(b, g) if f else (max(b, 2 * min(g, blame)), min(g, blame)) for (b, g), f in zip(shares, free)]
        trust = Trust(good / (total + held), shares)
        if abs(trust.good - last) < close:
            break
        last = trust.good
    return trust


def judge(stats: DataFrame, rules: Mapping[str, Column], least: float = 0.5, name: str = "kept", max_patterns: int = 100_000) -> tuple[DataFrame, Trust]:
    """Add a vote column per rule (vote_<name>), ``posterior`` and ``name`` (posterior >= ``least``).

    Equal vote patterns are counted in Spark; only those counts, at most 3 ** rules, reach the driver, where a few
    hundred turns over them take well under a second.  More than ``max_patterns`` are an error.  NULL votes abstain;
    columns of the added names are replaced.  Returns the rows and what was learned.
    """
    names = [f"vote_{r}" for r in rules]
    voted = stats.drop(*names, "posterior", name).withColumns({n: F.coalesce(F.signum(v).cast("int"), F.lit(0)) for n, v in zip(names, rules.values())})
    counted = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).limit(max_patterns + 1).collect()
    if len(counted) > max_patterns:
        raise ValueError(f"more than {max_patterns} vote patterns")
    patterns = {tuple(r[n] for n in names): r["__n"] for r in sorted(counted, key=tuple)}
    trust = learn(patterns or {(0,) * len(names): 0})
    judged = voted.withColumn("posterior", trust.column([F.col(n) for n in names]))
    return judged.withColumn(name, F.col("posterior") >= least), trust


def quality_rules(docs: DataFrame, text: str = "text", rules: Callable[[], Mapping[str, Column]] = default_rules, least: float = 0.5, min_words: int = 50, max_repeats: int = 50) -> DataFrame:
    """Documents with their text counts, votes, posterior and verdict.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeats`` of 100 words in repeated windows;
    such documents are never kept.  The others are kept when the posterior probability of good quality, given all
    votes, is at least ``least``.  Texts are read once: the counts are stored without them, then votes are counted and
    applied.  NULL and empty texts fail; an empty table stays empty.
    """
    slim = stored(text_stats(docs, text).drop(text))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeats * F.col("n_words"))
    judged, _ = judge(slim.withColumn("base_failed", failed), rules(), least)
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("kept"))
