"""From the ledger to the decision whether runs pass."""

from datetime import timedelta

from pyspark.sql import functions as F

from ..model import ACTIVE, EXIT_FAIL, EXIT_PASS, PASSIVE, SUCCESS, YES
from .joins import KEY, lookup_join, of_ids
from .ledger import LATEST_COLUMNS, ledger_order
from .selection import approved_rules, mapped_ids

# Categories of a rule's latest row. Only WAITING needs an exception to pass, and NONE never does.
SUCCEEDED, TOLERATED, WAITING, NOT_MAPPED, NONE = "success", "passive", "waiting", "unmapped", "none"


def _category(mapped):
    return (
        F.when(F.col("rule_execution_status").eqNullSafe(SUCCESS), SUCCEEDED)
        .when(F.col("rule_status").eqNullSafe(PASSIVE), TOLERATED)
        .when(F.col("rule_status").eqNullSafe(ACTIVE), F.when(mapped, WAITING).otherwise(NOT_MAPPED))
        .otherwise(NONE)
    )


def categorize(latest, feed_map, ids=None):
    """Add ``category`` to each rule's latest row.

    Both inputs are already partitioned by rule, so the join moves nothing again.
    With the ``ids`` that ``latest`` was taken for, the feed map is reduced for them only.
    """
    mapped = mapped_ids(feed_map, ids).withColumn("_mapped", F.lit(True))
    joined = latest.join(mapped, KEY, "left")
    category = _category(F.coalesce("_mapped", F.lit(False)))
    return joined.select(*latest.columns, category.alias("category"))


def waiting_rules(categories):
    return categories.where(F.col("category") == WAITING)


def exception_check(waiting):
    """Which waiting rules have their exception on the latest row."""
    return waiting.withColumn("resolved", F.col("exception_applied").eqNullSafe(YES))


def exceptions_in_time(ledger, feed_map, start, timeout=timedelta(minutes=60), ids=None, accept_success=False):
    """The rules that wait at ``start``, and whether each was resolved by ``start + timeout``.

    The ledger at ``start`` is what is dated up to it, and what has no date. A rule is
    resolved if its latest row then carries the exception, or if one dated in
    ``(start, start + timeout]`` does. ``accept_success=True`` takes a success dated
    in that time as well. Both questions are aggregates over one pass of the ledger,
    combined before the shuffle; the ledger is never joined to itself.
    """
    time_type = dict(ledger.dtypes)["created_dt"]
    begin, end = (F.lit(moment.isoformat(" ")).cast(time_type) for moment in (start, start + timeout))
    created = F.col("created_dt")
    seen = created.isNull() | (created <= begin)
    later = (created > begin) & (created <= end)
    resolving = F.col("exception_applied").eqNullSafe(YES)
    if accept_success:
        resolving = resolving | F.col("rule_execution_status").eqNullSafe(SUCCESS)
    per_rule = ledger.where(seen | later).groupBy(KEY).agg(
        F.max(F.when(seen, ledger_order())).alias("_newest"), F.bool_or(later & resolving).alias("_later")
    )
    if ids is not None:
        per_rule = of_ids(per_rule, ids)
    per_rule = per_rule.where(F.col("_newest").isNotNull()).select(
        KEY, *[F.col(f"_newest.{name}").alias(name) for name in LATEST_COLUMNS], "_later"
    )
    waiting = waiting_rules(categorize(per_rule, feed_map, ids))
    at_start = F.col("exception_applied").eqNullSafe(YES)
    return waiting.select(KEY, (at_start | F.coalesce("_later", F.lit(False))).alias("resolved"))


def _passing(resolved):
    return F.col("category").isin(SUCCEEDED, TOLERATED, NOT_MAPPED) | ((F.col("category") == WAITING) & resolved)


def counts_as_passing():
    """Of a categorized latest row: does the rule pass as it is, without a wait?"""
    return _passing(F.col("exception_applied").eqNullSafe(YES))


def verdict(given, categories, resolved=None, group_by=()):
    """Does each group of given rules pass?

    A group passes if every rule in it does, or if none of them is in the ledger. A
    rule without a ledger row does not pass otherwise. ``resolved`` says how the
    waiting rules ended; by default their latest row does. Without ``group_by`` all
    given rules are one group.
    """
    if resolved is None:
        rules = exception_check(categories)
    else:
        rules = categories.join(resolved.select(KEY, "resolved"), KEY, "left")
    rules = rules.select(KEY, _passing(F.coalesce("resolved", F.lit(False))).alias("_passes"))
    given = given.select(*group_by, KEY).distinct()
    return (
        lookup_join(given, rules, "left")
        .groupBy(*group_by)
        .agg(
            F.count(F.lit(1)).alias("given"),
            F.count("_passes").alias("in_ledger"),
            F.count_if("_passes").alias("passing"),
        )
        .withColumn("passes", (F.col("in_ledger") == 0) | (F.col("passing") == F.col("given")))
    )


def exit_code(passes):
    """Exit code of a run that came to an end: a number for a boolean, else a column.

    A run that raises needs none; Python itself ends with 1 then.
    """
    if isinstance(passes, bool):
        return EXIT_PASS if passes else EXIT_FAIL
    return F.when(F.col(passes), EXIT_PASS).otherwise(EXIT_FAIL)


# The earlier way to decide: approvals first, and the whole history instead of the latest row.


def _history_by_rule(ledger, ids):
    """Per given rule, over its whole history: successes, and rows that are neither success nor excepted."""
    succeeded = F.col("rule_execution_status").eqNullSafe(SUCCESS)
    excepted = F.col("exception_applied").eqNullSafe(YES)
    return of_ids(ledger.groupBy(KEY).agg(
        F.count_if(succeeded).alias("_successes"), F.count_if(~succeeded & ~excepted).alias("_pending")
    ), ids)


def _grouped_history(given, ledger, group_by):
    given = given.select(*group_by, KEY).distinct()
    return lookup_join(given, _history_by_rule(ledger, given), "left").groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("given"),
        F.coalesce(F.sum("_successes"), F.lit(0)).alias("successes"),
        F.coalesce(F.sum("_pending"), F.lit(0)).alias("pending"),
    )


def all_succeeded(given, ledger, group_by=()):
    """Are there as many successes in the history as given rules?"""
    return _grouped_history(given, ledger, group_by).select(
        *group_by, "given", "successes", (F.col("successes") == F.col("given")).alias("passes")
    )


def exceptions_applied(given, ledger, group_by=()):
    """Is every row of the history a success or excepted?"""
    return _grouped_history(given, ledger, group_by).select(
        *group_by, "given", "pending", (F.col("pending") == 0).alias("passes")
    )


def verdict_from_approvals(given, approvals, ledger, group_by=()):
    """A group passes if none of its rules is approved, or the approved ones all
    succeeded, or all their exceptions are applied.

    The ledger is taken as it is; ``of_runs`` limits it to some runs beforehand.
    """
    approved = approved_rules(given, approvals)
    rules = approved.join(_history_by_rule(ledger, given), KEY, "left").withColumn("_approved", F.lit(True))
    given = given.select(*group_by, KEY).distinct()
    passes = (F.col("approved") == 0) | (F.col("successes") == F.col("approved")) | (F.col("pending") == 0)
    return (
        lookup_join(given, rules, "left")
        .groupBy(*group_by)
        .agg(
            F.count("_approved").alias("approved"),
            F.coalesce(F.sum("_successes"), F.lit(0)).alias("successes"),
            F.coalesce(F.sum("_pending"), F.lit(0)).alias("pending"),
        )
        .withColumn("passes", passes)
    )
