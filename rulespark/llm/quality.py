"""Quality rules, kept as a ledger of bits.

Every rule is judged once for every document. The ledger keeps the measurements and
one bit for each rule that a document fails; a policy is a mask over those bits. So
another policy, or what a rule alone removes, is bit arithmetic over the ledger, and
no text is read again.

All of it is native: measurements are array expressions within a row, so no document
is shuffled. Null and empty texts have no words and no lines. Ids are carried as they
are; null and repeated ids are rows like any others.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import SPACES, whole, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_unspaced")
#: Blocks of scripts that part no words by spaces, and of their marks: Thai and Lao, Tibetan,
#: Myanmar, Khmer, kana and Han with its marks, compatibility and full-width forms, and later planes of Han.
UNSPACED = (
    r"[\x{0E00}-\x{0EFF}\x{0F00}-\x{0FFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3000}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}"
    r"\x{F900}-\x{FAFF}\x{FF00}-\x{FFEF}\x{20000}-\x{3FFFF}]")


class Rule(NamedTuple):
    """A document fails where the SQL condition over the measurements holds."""

    name: str
    fails: str


#: The place of a rule is its bit: add new ones at the end.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("long_words", "word_chars > 25 * n_words AND 2 * n_unspaced < word_chars"),
    Rule("short_words", "word_chars < 2 * n_words"),
)


class Policy(NamedTuple):
    """A version, and the names of the rules that count."""

    version: str
    rules: tuple[str, ...]


BASE = Policy("base", ("few_words", "repeated_words"))
CURRENT = Policy("1", tuple(rule.name for rule in RULES))


def mask(policy, rules=RULES):
    """The policy's rules as bits."""
    places = {rule.name: place for place, rule in enumerate(rules)}
    return sum(1 << places[name] for name in set(policy.rules))


def measured(docs: DataFrame, text="text", carry=("doc_id",)) -> DataFrame:
    """The carried columns and the measurements of each document.

    Words in repeated windows are counted from the windows sorted with their places:
    equal neighbours are repeats, and consecutive places overlap by what lies between.
    Texts without a repeated window, found by a hash set, skip the sort. ``n_unspaced``,
    characters of scripts without spaces, are counted where what spaces part is longer than
    words are, as long lines of such a script are one word each; elsewhere it is zero.
    """
    kept = [F.col(name).alias(f"kept_{place}") for place, name in enumerate(carry)]
    rows = docs.select(*kept, whole(text).alias("body"), words(text).alias("words"))
    lines = F.filter(F.split("body", "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    rows = rows.select("*", F.size("words").alias("size"), lines.alias("lines"))
    window = F.transform(
        F.sequence(F.lit(1), F.col("size") - WINDOW + 1), lambda at: F.concat_ws(" ", F.slice("words", at, WINDOW)))
    rows = rows.withColumn("windows", F.when(F.col("size") >= WINDOW, window).otherwise(F.array().cast("array<string>")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda window, at: F.struct(window.alias("window"), at.alias("at"))))
    rows = rows.withColumn("placed", F.when(repeats, placed))

    def twice(item, at):
        before, after = F.get("placed", at - 1)["window"], F.get("placed", at + 1)["window"]
        return F.coalesce(before == item["window"], F.lit(False)) | F.coalesce(after == item["window"], F.lit(False))

    rows = rows.withColumn("places", F.sort_array(F.transform(F.filter("placed", twice), lambda item: item["at"])))
    covered = F.transform(
        "places", lambda place, at: F.least(F.lit(WINDOW), F.coalesce(F.get("places", at + 1) - place, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0), lambda sum_, add: sum_ + add)
    bare = F.length(F.translate("body", SPACES, ""))
    symbols = F.length("body") - F.length(F.translate("body", SYMBOLS, ""))
    unspaced = F.length("body") - F.length(F.regexp_replace("body", UNSPACED, ""))
    values = {
        "n_unspaced": F.when(bare > 25 * F.col("size"), unspaced).otherwise(F.lit(0)),
        "n_words": F.col("size"), "word_chars": bare, "n_symbols": symbols, "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")), "n_repeat_words": F.coalesce(total, F.lit(0)),
    }
    names = [F.col(f"kept_{place}").alias(name) for place, name in enumerate(carry)]
    return rows.select(*names, *(values[name].cast("long").alias(name) for name in MEASURES))


def failure_bits(rules=RULES) -> Column:
    """One long with the bits of the failed rules, over the measurements."""
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, text="text", carry=("doc_id",), rules=RULES) -> DataFrame:
    """The carried columns, the measurements, and ``failed``: a bit per failed rule."""
    return measured(docs, text, carry).withColumn("failed", failure_bits(rules))


def passes(policy, rules=RULES, failed="failed") -> Column:
    """Whether a row of the ledger fails none of the policy's rules."""
    return F.col(failed).bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def kept_documents(docs: DataFrame, policy=CURRENT, text="text", rules=RULES) -> DataFrame:
    """The documents that pass, with all their columns, whatever these are called.

    The number of a row takes part in the filter, always true, because a filter over it
    stays where it is: moved below the measurements, it would repeat each of them.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("body"))
    rows = ledger(rows, "body", ("row",), rules).withColumn("number", F.monotonically_increasing_id())
    return rows.where(passes(policy, rules) & (F.col("number") >= 0)).select("row.*")


def ablations(entries: DataFrame, policies=(BASE, CURRENT), rules=RULES) -> DataFrame:
    """Per policy and rule: how many fail it, fail it alone, and would pass without it.

    Equal failure bits are counted first, so that the shuffled rows are the distinct
    masks, at most two to the number of rules, and not the documents.
    """
    cases = [
        F.struct(F.lit(policy.version).alias("policy"), F.lit(rule.name).alias("rule"),
                 F.lit(mask(policy, rules)).cast("long").alias("mask"), F.lit(1 << place).cast("long").alias("bit"))
        for policy in policies for place, rule in enumerate(rules) if rule.name in policy.rules
    ]
    counts = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("docs"))
    each = counts.select("failed", "docs", F.explode(F.array(*cases)).alias("case")).select("failed", "docs", "case.*")
    counted = F.col("failed").bitwiseAND(F.col("mask"))

    def total(condition):
        return F.sum(F.when(condition, F.col("docs")).otherwise(F.lit(0)))

    return each.groupBy("policy", "rule").agg(
        F.sum("docs").alias("docs"), total(counted == 0).alias("passed"),
        total(counted.bitwiseAND(F.col("bit")) != 0).alias("failed_it"), total(counted == F.col("bit")).alias("failed_it_alone"),
        total(counted.bitwiseAND(F.bitwise_not("bit")) == 0).alias("passed_without_it"),
    )
