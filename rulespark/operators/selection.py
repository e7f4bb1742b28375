"""Which rules apply to a run."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import text_or_empty
from ..model import APPROVED, AUDIT_COLUMNS, RULE_COLUMNS, RULE_TEXT_COLUMNS, SELECTED_STATUSES, YES
from .joins import KEY, id_frame, lookup_join, of_ids


def _applicable(catalog, module, stage, packages):
    wanted = (
        (F.col("module") == module)
        & (F.col("stage") == stage)
        & F.col("package").isin(list(packages))
        & F.col("rule_status").isin(*SELECTED_STATUSES)
    )
    return catalog.where(wanted).select(*RULE_COLUMNS).distinct()


def _applies(feed_id):
    return F.col("feed_id").eqNullSafe(feed_id) & F.col("rule_applicable_status").eqNullSafe(YES)


def mapped_ids(feed_map, ids=None):
    """Rules, of the given ones if any are, with at least one applicable mapping to whatever feed."""
    mapped = feed_map.where(F.col("rule_applicable_status") == YES).select(KEY).distinct()
    return mapped if ids is None else of_ids(mapped, ids)


def select_rules(catalog, module, stage, package):
    """Active and passive rules of one module, stage and package, each once."""
    return _applicable(catalog, module, stage, [package])


def mapped_rules(catalog, feed_map, module, stage, package, feed_id):
    """The selected rules that are mapped to the feed."""
    mapped = feed_map.where(_applies(feed_id)).select(KEY).distinct()
    return lookup_join(select_rules(catalog, module, stage, package), mapped, "left_semi").select(*RULE_COLUMNS)


def unmapped_rules(catalog, feed_map, module, stage, package):
    """The selected rules without any mapping row, whatever its feed or flag."""
    rules = select_rules(catalog, module, stage, package)
    known = of_ids(feed_map.select(KEY).distinct(), rules)
    return lookup_join(rules, known, "left_anti").select(*RULE_COLUMNS)


def _for_feed(rules, feed_map, feed_id, unmapped):
    """Mapped and never-mapped rules in one pass over the feed map."""
    if unmapped not in ("keep", "drop"):
        raise ValueError("unmapped is 'keep' or 'drop'")
    hits = of_ids(feed_map.groupBy(KEY).agg(F.bool_or(_applies(feed_id)).alias("_hit")), rules)
    kept = F.coalesce("_hit", F.lit(unmapped == "keep"))
    return lookup_join(rules, hits, "left").where(kept).select(*RULE_COLUMNS)


def rules_for_feed(catalog, feed_map, module, stage, package, feed_id=None, unmapped="keep"):
    """Rules for a feed: those mapped to it, and those never mapped to anything.

    ``unmapped="drop"`` leaves the second kind out. Without a feed every selected
    rule applies.
    """
    return _rules(catalog, feed_map, module, stage, [package], feed_id, unmapped)


def _rules(catalog, feed_map, module, stage, packages, feed_id, unmapped):
    rules = _applicable(catalog, module, stage, packages)
    return _for_feed(rules, feed_map, feed_id, unmapped) if feed_id else rules


def rules_for_packages(catalog, feed_map, module, stage, packages, feed_id=None, unmapped="keep"):
    """Rules of several packages; a package named twice gives its rules twice.

    ``package_position`` is the package's place in the argument.
    """
    packages = list(packages)
    if not packages:
        return catalog.where(F.lit(False)).select(*RULE_COLUMNS, F.lit(0).alias("package_position"))
    rules = _rules(catalog, feed_map, module, stage, set(packages), feed_id, unmapped)
    places = {}
    for place, package in enumerate(packages):
        places.setdefault(package, []).append(F.lit(place))
    asked = F.create_map(*[part for package, at in places.items() for part in (F.lit(package), F.array(*at))])
    return rules.select(*RULE_COLUMNS, F.explode(asked[F.col("package")]).alias("package_position"))


REQUEST_COLUMNS = ("request_id", "module", "stage", "package", "feed_id")


def rules_for_requests(catalog, feed_map, requests, unmapped="keep"):
    """The rules of any number of requests at once, each as ``rules_for_feed`` gives them.

    A request is a row of (request_id, module, stage, package, feed_id); one of several
    packages has several rows. Catalog and feed map are read once: the feed map is reduced to
    one row per rule and feed, and to the rules that it names at all, before it meets the
    requests. A request without a feed, null or empty, takes every selected rule. The same
    request row twice counts once; a rule that no request asks for never leaves the catalog.
    """
    if unmapped not in ("keep", "drop"):
        raise ValueError("unmapped is 'keep' or 'drop'")
    places = ("module", "stage", "package")
    requests = requests.select("request_id", *places, F.nullif("feed_id", F.lit("")).alias("_feed")).distinct()
    rules = catalog.where(F.col("rule_status").isin(*SELECTED_STATUSES)).select(*RULE_COLUMNS).distinct()
    asked = rules.join(requests, list(places))
    mapped = feed_map.groupBy(KEY, F.col("feed_id").alias("_feed")).agg(
        F.bool_or(F.col("rule_applicable_status").eqNullSafe(YES)).alias("_hit"))
    known = lookup_join(asked, mapped.select(KEY).distinct().withColumn("_known", F.lit(True)), "left")
    hits = mapped.where("_hit AND _feed IS NOT NULL")
    anew = [F.concat(F.col(name), F.lit("")).alias(name) for name in (KEY, "_feed")]
    found = known.join(hits.select(*anew, "_hit"), [KEY, "_feed"], "left")
    kept = F.col("_feed").isNull() | F.coalesce("_hit", F.lit(False)) | (F.col("_known").isNull() & F.lit(unmapped == "keep"))
    return found.where(kept).select("request_id", *RULE_COLUMNS).distinct()


def rule_rows(rules):
    """Rules as text: audit columns as text, with an empty text for NULL."""
    others = [name for name in rules.columns if name not in RULE_COLUMNS]
    return rules.select(
        *RULE_TEXT_COLUMNS, *[text_or_empty(name).alias(name) for name in AUDIT_COLUMNS], *others
    )


def has_feed_mapping(ids, feed_map):
    """For each given rule: is there an applicable mapping to any feed?"""
    ids = id_frame(feed_map.sparkSession, ids)
    mapped = mapped_ids(feed_map, ids).withColumn("_mapped", F.lit(True))
    return ids.join(mapped, KEY, "left").select(KEY, F.coalesce("_mapped", F.lit(False)).alias("has_feed_mapping"))


def approved_rules(ids, approvals):
    """The given rules that are approved for this run, each once.

    ``approvals=None`` means that there is no approvals table; then all of them are.
    """
    if approvals is None:
        return id_frame(SparkSession.active(), ids)
    approved = approvals.where(F.col("approval_status") == APPROVED).select(KEY).distinct()
    return id_frame(approvals.sparkSession, ids).join(approved, KEY, "left_semi")
