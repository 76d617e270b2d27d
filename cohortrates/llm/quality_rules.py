"""Weak supervision of text quality: rules vote or abstain, and what they are worth is estimated.

Each rule looks at one statistic of a document and votes good, bad or not at all. How often a rule is
right on good and on bad documents is unknown; expectation-maximisation estimates it from how rules
agree, and the posterior probability of being good replaces a filter that every rule must pass.

Only DataFrame functions are used. The texts are read once. Estimation works on the counts of vote
patterns, of which there are at most three to the power of the number of rules, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, settled, sheltered, text_of

SYMBOLS = "#*$%&|<>"

#: Documents with fewer words are refused whatever the rules say.
LEAST_WORDS = 50

#: As are those of whose words more than this percentage lies in repeated windows.
MOST_REPEATED = 50

ROUNDS = 12

#: What most texts consist of; it becomes one space, and the short rest is searched for the other characters.
PLAIN = r"[a-z \n]+"

#: Two or more punctuation marks in a row, or a bar that stands alone.
MARKS = r"[!-/:-@\[-`{-~]{2,}| \| "


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, bad where ``bad`` holds (SQL over the statistics), else abstains."""

    name: str
    good: str
    bad: str


#: Conditions are whole-number comparisons, so every engine decides them alike.
RULES = (
    Rule("length", "n_words >= 100", "n_words < 60"),
    Rule("symbols", "200 * n_symbols <= word_chars", "50 * n_symbols > word_chars"),
    Rule("repetition", "20 * n_repeat_words <= n_words", "5 * n_repeat_words > n_words"),
    Rule("lines", "n_dup_lines = 0", "4 * n_dup_lines > n_lines"),
    Rule("capitals", "10 * n_capitals <= word_chars", "4 * n_capitals > word_chars"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 9 * n_words", "word_chars > 14 * n_words OR word_chars < 2 * n_words"),
    Rule("marks", "50 * n_marks <= n_words", "20 * n_marks > n_words"),
)


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the array.

    Window hashes share a number with their position, so that one sort of numbers brings equal
    windows together without losing where they are. Windows close to a neighbour are then compared
    by their words, so the count is exact. The work grows as the length times its logarithm.
    """
    size = F.size(words)

    def windows(mask: Column) -> Column:
        high = F.bitwise_not(mask).bitwiseAND(F.lit(2**63 - 1))  # non-negative, so that gaps cannot overflow

        def packed(high: Column) -> Column:
            # the last two have no window of their own and are left out when windows are compared
            return F.transform(
                words,
                lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(high).bitwiseOR(i.cast("long")),
            )

        return F.sort_array(let(high, packed))

    def candidates(ordered: Column) -> Column:
        # equal hashes differ by their positions only; a few others pass too
        def follows(x: Column, i: Column) -> Column:
            return F.get(ordered, i + 1) - x <= size

        def either(found: Column) -> Column:
            rest = F.filter(ordered, lambda x, i: x - F.get(ordered, i - 1) <= size)
            return F.when(F.size(found) == 0, found).otherwise(F.array_union(found, rest))

        return let(F.filter(ordered, follows), either)

    def named(chosen: Column, mask: Column) -> Column:
        def window(x: Column) -> Column:
            i = x.bitwiseAND(mask).cast("int")
            return F.struct(F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1), F.lit(" "), F.get(words, i + 2)).alias("w"), i.alias("i"))

        return F.sort_array(F.filter(F.transform(chosen, window), lambda x: x["w"].isNotNull()))

    def equal(ordered: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            return (x["w"] == F.get(ordered, i + 1)["w"]) | (x["w"] == F.get(ordered, i - 1)["w"])

        kept = F.filter(ordered, lambda x, i: F.coalesce(same(x, i), F.lit(False)))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        parts = F.transform(starts, lambda s, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3))))
        return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)

    def counted(mask: Column) -> Column:
        def exact(chosen: Column) -> Column:
            return F.when(F.size(chosen) == 0, F.lit(0).cast("long")).otherwise(let(let(named(chosen, mask), equal), covered))

        return let(let(windows(mask), candidates), exact)

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(size.cast("long")))) - 1
    return F.when(size >= 4, let(mask, counted)).otherwise(F.lit(0).cast("long"))


def _count(text: Column, characters: str) -> Column:
    """How many of some ASCII characters a text has."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in characters), F.lit(0)).cast("long")


def text_statistics(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and the statistics that the rules use, one row per row of ``docs``; null texts are empty."""
    split = (
        docs.select(*[F.col(f"`{c}`") for c in keep], text_of(text).alias("_t"))
        .withColumn("_w", F.array_remove(F.split("_t", f"{SPACE}+"), ""))
        .withColumn("_l", F.split("_t", "\n"))
        .withColumn("_r", F.regexp_replace("_t", PLAIN, " "))
    )
    worded = F.filter("_l", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return split.select(
        *[F.col(f"`{c}`") for c in keep],
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        _count(F.col("_r"), SYMBOLS).alias("n_symbols"),
        let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.octet_length(F.regexp_replace("_r", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        (F.size(F.split("_r", MARKS)) - 1).cast("long").alias("n_marks"),
    )


def base_failed(least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED) -> Column:
    return F.expr(f"n_words < {least_words} OR 100 * n_repeat_words > {most_repeated} * n_words")


def with_votes(stats: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One column per rule: 1 for good, 0 for bad, -1 for no vote."""
    return stats.select("*", *[F.expr(f"CASE WHEN {r.bad} THEN 0 WHEN {r.good} THEN 1 ELSE -1 END").alias(f"vote_{r.name}") for r in rules])


@dataclass(frozen=True)
class Estimate:
    """The share of good documents, and how often each rule votes rightly on good and on bad ones."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]


def start(rules: Sequence[Rule] = RULES) -> Estimate:
    """Where estimation starts: most documents are good; a rule seldom sees a bad one, but is right when it does."""
    return Estimate(0.8, (0.99,) * len(rules), (0.3,) * len(rules))


def posterior(estimate: Estimate, rules: Sequence[Rule] = RULES) -> Column:
    """The probability that a document with these votes is good; without any vote, the prior."""

    def likelihood(prior: float, if_one: Sequence[float]) -> str:
        factors = [f"{prior!r}D"] + [
            f"(CASE vote_{r.name} WHEN 1 THEN {p!r}D WHEN 0 THEN {1 - p!r}D ELSE 1D END)" for r, p in zip(rules, if_one, strict=True)
        ]
        return " * ".join(factors)

    good = likelihood(estimate.prior, estimate.on_good)
    bad = likelihood(1 - estimate.prior, [1 - q for q in estimate.on_bad])
    return F.expr(f"({good}) / (({good}) + ({bad}))")


def fit(votes: DataFrame, rules: Sequence[Rule] = RULES, rounds: int = ROUNDS) -> Estimate:
    """Expectation-maximisation over the counts of vote patterns; one small aggregate per round.

    Give it the documents whose verdict the rules decide. One pseudo-count on either side keeps rates away from 0 and 1. Without rows the start is returned.
    """
    names = [f"vote_{r.name}" for r in rules]
    patterns = settled(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "vote-patterns")
    found = start(rules)
    for _ in range(rounds):
        expected = patterns.withColumn("g", F.col("n") * posterior(found, rules)).withColumn("b", F.col("n") - F.col("g"))
        sums = [F.sum("g").alias("good"), F.sum("b").alias("bad")]
        for i, name in enumerate(names):
            for side in ("g", "b"):
                for vote in (1, 0):
                    sums.append(F.expr(f"coalesce(sum({side}) FILTER (WHERE {name} = {vote}), 0D)").alias(f"{side}{vote}_{i}"))
        row = expected.agg(*sums).first()
        if row.good is None:
            return found
        found = Estimate(
            (row.good + 1) / (row.good + row.bad + 2),
            tuple((row[f"g1_{i}"] + 1) / (row[f"g1_{i}"] + row[f"g0_{i}"] + 2) for i in range(len(names))),
            tuple((row[f"b0_{i}"] + 1) / (row[f"b0_{i}"] + row[f"b1_{i}"] + 2) for i in range(len(names))),
        )
    return found


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, base_failed, probability and kept.

    Null and empty texts have no words and fail the base. Other columns of ``docs`` are not read, so
    their names cannot clash. Equal rows get equal verdicts, each its own row; an empty table gives none.
    """
    docs, _ = sheltered(docs, "doc_id", "text")
    stats = settled(with_votes(text_statistics(docs), rules), "text-statistics")
    failed = base_failed()
    estimate = fit(stats.where(~failed), rules, rounds)
    return (
        stats.withColumn("probability", posterior(estimate, rules))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold))
        .drop(*[f"vote_{r.name}" for r in rules])
    )


def oracle_sql(rules: Sequence[Rule] = RULES, rounds: int = ROUNDS, threshold: float = 0.5) -> str:
    """The same in DuckDB's SQL, with the rounds written out."""
    names = [f"vote_{r.name}" for r in rules]
    first = start(rules)

    def post(params: Mapping[str, str]) -> str:
        good = " * ".join([params["prior"]] + [f"(CASE {n} WHEN 1 THEN {params[f'a{i}']} WHEN 0 THEN 1 - {params[f'a{i}']} ELSE 1 END)" for i, n in enumerate(names)])
        bad = " * ".join([f"(1 - {params['prior']})"] + [f"(CASE {n} WHEN 1 THEN 1 - {params[f'q{i}']} WHEN 0 THEN {params[f'q{i}']} ELSE 1 END)" for i, n in enumerate(names)])
        return f"({good}) / (({good}) + ({bad}))"

    columns = ["prior"] + [f"{k}{i}" for i in range(len(names)) for k in ("a", "q")]
    begin = {"prior": first.prior} | {f"a{i}": first.on_good[i] for i in range(len(names))} | {f"q{i}": first.on_bad[i] for i in range(len(names))}
    parts = [f"p0 AS (SELECT {', '.join(f'{begin[c]!r}::DOUBLE AS {c}' for c in columns)})"]
    for k in range(rounds):
        new = ["(sum(g) + 1) / (sum(n) + 2) AS prior"]
        for i, n in enumerate(names):
            new.append(f"(coalesce(sum(g) FILTER (WHERE {n} = 1), 0) + 1) / (coalesce(sum(g) FILTER (WHERE {n} >= 0), 0) + 2) AS a{i}")
            new.append(f"(coalesce(sum(n - g) FILTER (WHERE {n} = 0), 0) + 1) / (coalesce(sum(n - g) FILTER (WHERE {n} >= 0), 0) + 2) AS q{i}")
        parts.append(
            f"p{k + 1} AS MATERIALIZED (SELECT {', '.join(new)} FROM (SELECT patterns.*, n * ({post({c: f'p.{c}' for c in columns})}) AS g FROM patterns, p{k} AS p))"
        )
    votes = ", ".join(f"CASE WHEN {r.bad} THEN 0 WHEN {r.good} THEN 1 ELSE -1 END AS vote_{r.name}" for r in rules)
    space = "[\\x20\\x09-\\x0D]"
    symbols = " + ".join(f"length(t) - length(replace(t, '{c}', ''))" for c in SYMBOLS)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, list_filter(string_split_regex(t, '{space}+'), lambda x: x <> '') AS w,
                 string_split(t, chr(10)) AS l FROM docs),
windows AS (SELECT row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS shown
            FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
twice AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, shown) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT row_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row_id),
stats AS (
  SELECT split.row_id, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         ({symbols})::BIGINT AS n_symbols,
         (len(list_filter(l, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
          - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
         length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals,
         (len(string_split_regex(regexp_replace(t, '{PLAIN}', ' ', 'g'), '{MARKS}')) - 1)::BIGINT AS n_marks
  FROM split LEFT JOIN repeats USING (row_id)),
voted AS MATERIALIZED (SELECT *, {votes} FROM stats),
patterns AS MATERIALIZED (SELECT {', '.join(names)}, count(*)::DOUBLE AS n FROM voted WHERE NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) GROUP BY ALL),
{', '.join(parts)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
       AND {post({c: f'p.{c}' for c in columns})} >= {threshold} AS kept
FROM voted, p{rounds} AS p
"""
