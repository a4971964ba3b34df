"""Quality rules by weak supervision, in DataFrame and SQL expressions alone.

Every rule votes good, bad or abstains. Expectation-maximisation over the counts of the vote patterns estimates
how often each rule votes and how often it is right, for good and for bad texts; a text's posterior probability
of being good replaces the test that all rules pass. The patterns are at most three to the power of the number
of rules, whatever the number of documents, and the counts cover all documents.

Defined results: a null text has no words; texts that fail the base check are not kept, whatever the votes.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import written

#: Words of a window whose repetition counts.
WINDOW = 5
#: The rules, with the condition for a good and for a bad vote over the measures; else abstain.
RULES = {
    "symbols": ("n_symbols * 50 <= n_words", "n_symbols * 5 > n_words"),
    "repeats": ("n_repeat_words * 20 <= n_words", "n_repeat_words * 8 > n_words"),
    "lines": ("n_dup_lines = 0", "n_dup_lines * 4 > n_lines"),
    "length": ("n_words >= 50", "n_words < 20"),
    "word_size": ("word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    "capitals": ("n_upper * 10 <= word_chars", "n_upper * 3 > word_chars"),
    "stops": ("n_stops * 20 >= n_words", "n_stops = 0"),
    "letters": ("n_signs * 12 <= word_chars", "n_signs * 6 > word_chars"),
    "endings": ("n_endings * 2 >= n_lines", "n_endings * 5 < n_lines"),
}
#: Keep from this posterior on.
LEAST_POSTERIOR = 0.5

_WHITE = r"[ \\x09-\\x0D]+"


def _words(text: str) -> str:
    return rf"filter(split({text}, '{_WHITE}'), w -> w <> '')"


def repeated_words(hashes: str, windows: str) -> str:
    """SQL: the words covered by windows that occur twice or more in the array of their hashes.

    Only texts that repeat a hash reach the second part, which sorts the windows themselves with their
    places, finds those equal to a neighbour, and adds up what each covers beyond the one before it.
    """
    ordered = f"array_sort(transform({windows}, (w, i) -> struct(w AS w, i AS i)))"
    places = (
        "array_sort(transform(filter(transform(s, (x, k) -> struct(x.i AS i, "
        "coalesce(x.w = get(s, k - 1).w, false) OR coalesce(x.w = get(s, k + 1).w, false) AS twice)), "
        "x -> x.twice), x -> x.i))"
    )
    covered = f"aggregate(transform(p, (i, k) -> least({WINDOW}, coalesce(get(p, k + 1) - i, {WINDOW}))), 0L, (a, x) -> a + x)"
    slow = f"get(transform(array({ordered}), s -> get(transform(array({places}), p -> {covered}), 0)), 0)"
    return f"CASE WHEN size(array_distinct({hashes})) = size({hashes}) THEN 0L ELSE {slow} END"


def measured(docs: DataFrame) -> DataFrame:
    """The measures of every whole text."""
    word = [f"get(words, i + {k})" for k in range(WINDOW)]
    starts = f"CASE WHEN size(words) >= {WINDOW} THEN sequence(0, size(words) - {WINDOW}) ELSE cast(array() AS array<int>) END"
    windows = f"transform(starts, i -> concat_ws(' ', {', '.join(word)}))"
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .selectExpr("doc_id", "text", f"{_words('text')} AS words", rf"split(text, '\\n') AS lines")
        .selectExpr("*", f"{starts} AS starts", "array_join(words, '') AS body")
        .selectExpr("*", f"transform(starts, i -> xxhash64({', '.join(word)})) AS hashes")
        .selectExpr("*", rf"filter(lines, x -> x rlike '[^ \\x09-\\x0D]') AS full_lines")
        .selectExpr(
            "doc_id",
            "cast(size(words) AS long) AS n_words",
            "cast(char_length(body) AS long) AS word_chars",
            "cast(char_length(body) - char_length(translate(body, '#*$%&|<>', '')) AS long) AS n_symbols",
            "cast(size(full_lines) - size(array_distinct(full_lines)) AS long) AS n_dup_lines",
            f"{repeated_words('hashes', windows)} AS n_repeat_words",
            "cast(size(full_lines) AS long) AS n_lines",
            "cast(char_length(body) - char_length(regexp_replace(body, '[A-Z]+', '')) AS long) AS n_upper",
            r"cast(char_length(regexp_replace(body, '\\p{L}+', '')) AS long) AS n_signs",
            "cast(size(filter(words, w -> char_length(w) <= 3)) AS long) AS n_stops",
            rf"cast(size(filter(full_lines, x -> x rlike '[.!?][ \\x09-\\x0D]*$')) AS long) AS n_endings",
        )
    )


def base_failed() -> Column:
    return F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")


def voted(measures: DataFrame) -> DataFrame:
    """A column ``votes`` with one letter per rule: + good, - bad, 0 abstained."""
    votes = ", ".join(f"CASE WHEN {bad} THEN '-' WHEN {good} THEN '+' ELSE '0' END" for good, bad in RULES.values())
    return measures.withColumn("votes", F.expr(f"concat({votes})"))


def posteriors(counts: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """The probability that a text with each vote pattern is good, by expectation-maximisation.

    Starts from the share of good votes. A rule's votes are taken as independent given the class, with
    probabilities of its own for good, bad and abstaining; one added vote of each kind keeps them above 0.
    """
    quality = {p: (1 + p.count("+")) / (2 + p.count("+") + p.count("-")) for p in counts}
    total = sum(counts.values())
    for _ in range(rounds):
        good = sum(n * quality[p] for p, n in counts.items())
        prior = {True: (good + 1) / (total + 2), False: (total - good + 1) / (total + 2)}
        weight = {True: quality, False: {p: 1 - q for p, q in quality.items()}}
        chance = {}
        for side in (True, False):
            mass = sum(n * weight[side][p] for p, n in counts.items())
            for rule in range(len(RULES)):
                for vote in "+0-":
                    own = sum(n * weight[side][p] for p, n in counts.items() if p[rule] == vote)
                    # what is added leans to good votes for good texts, so that the classes keep their names
                    lean = 2 if (vote == "+") == side and vote != "0" else 1
                    chance[side, rule, vote] = (own + lean) / (mass + 4)
        updated = {}
        for p in counts:
            score = {s: log(prior[s]) + sum(log(chance[s, r, v]) for r, v in enumerate(p)) for s in (True, False)}
            updated[p] = 1 / (1 + exp(max(-700.0, min(700.0, score[False] - score[True]))))
        change = max(abs(updated[p] - quality[p]) for p in counts)
        quality = updated
        if change < 1e-9:
            break
    return quality


def judged(docs: DataFrame) -> DataFrame:
    """The measures and the verdict of every document."""
    rows = written(voted(measured(docs)), "votes")
    # at most 3 ** len(RULES) rows
    counts = {r.votes: r["count"] for r in rows.groupBy("votes").count().orderBy("votes").collect()}
    table = posteriors(counts) if counts else {}
    known = ", ".join(f"'{p}', {q!r}D" for p, q in table.items()) or "'', 0D"
    return (
        rows.withColumn("base_failed", base_failed())
        .withColumn("posterior", F.expr(f"element_at(map({known}), votes)"))
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & (F.col("posterior") >= LEAST_POSTERIOR)).alias("kept"),
            "posterior",
            "votes",
        )
    )
