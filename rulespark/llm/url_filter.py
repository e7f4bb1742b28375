"""URL filters by a sorted sweep over canonical keys.

A rule is a host and the start of a path. With the labels of its host reversed it is a
prefix of canonical keys, so it covers an interval of the sorted keys, and intervals
nest or are apart. A URL has one key for each host above its own that has rules; the
sweep sorts keys and rules together and carries the stack of rules that are open, the
innermost first. The first one in the stack that still covers a key is its rule.

Native throughout. A sweep is dealt by reversed host and split further by how many
keys that host has, so a host with a third of all URLs takes a third of the tasks; its
rules are repeated for each split. Equal URLs are judged once, and joins give their
smaller side its key anew, so that Spark can split a key with a third of the other side.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import ascii_lower

RULE_TYPES = "host string, path string, action string"


def host_and_path(url):
    """Host and path of a URL column; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _reversed(labels):
    return F.array_join(F.reverse(labels), ".")


def _anew(rows, *keys):
    """The rows with their keys derived again: not known to be partitioned by them any more.

    A side of a join that an aggregate has already dealt by the key gets no exchange of its
    own otherwise, and Spark splits an overfull partition only where both sides have one.
    """
    return rows.withColumns({key: F.concat(F.col(key), F.lit("")) for key in keys})


def _stacks(rules):
    """Each rule's canonical key with the rules that are open there, innermost first.

    Rules that enclose a rule are found by equality with the starts of its path. Of
    equal rules with different actions, block holds.
    """
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.max("action").alias("action"))
    starts = rules.select(
        "host", F.col("path").alias("inner"), F.explode(F.sequence(F.lit(0), F.length("path"))).alias("length"))
    starts = starts.select("host", "inner", F.substring("inner", F.lit(1), F.col("length")).alias("path"))
    outer = F.struct(F.length("path").alias("length"), "path", "action")
    stacks = starts.join(rules, ["host", "path"]).groupBy("host", "inner").agg(
        F.sort_array(F.collect_list(outer), asc=False).alias("stack"))
    host = _reversed(F.split("host", r"\."))
    return stacks.select(host.alias("anchor"), F.concat(host, F.lit("/"), F.col("inner")).alias("key"), "stack")


def judged(urls: DataFrame, rules: DataFrame, default="allow") -> DataFrame:
    """Each distinct ``host`` and ``path``, with the ``rule`` that fits and its ``verdict``.

    A rule (``host``, ``path``, ``action``) fits its host and all hosts below it where the
    path starts with the rule's. The longest rule wins; of equally long ones that with
    the longer host. ``rule`` is null and ``verdict`` the default where none fits.
    """
    session = urls.sparkSession
    urls = urls.select("host", "path").distinct()
    stacks = _stacks(rules)
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1)))),
        lambda count: _reversed(F.slice(labels, -count, count)))
    points = urls.select("host", "path", F.explode(above).alias("anchor"))
    anchors = stacks.select("anchor").distinct()
    points = points.join(_anew(anchors, "anchor"), "anchor")

    counts = points.groupBy("anchor").agg(F.count(F.lit(1)).alias("points"))
    parts = int(session.conf.get("spark.sql.shuffle.partitions"))
    share = (counts.agg(F.sum("points")).first()[0] or 0) / parts
    splits = counts.select("anchor", F.greatest(F.lit(1), F.ceil(F.col("points") / F.lit(max(share, 1.0)))).alias("splits"))
    points = points.join(_anew(splits, "anchor"), "anchor").select(
        "anchor", F.pmod(F.xxhash64("host", "path"), F.col("splits")).alias("split"),
        F.concat("anchor", F.lit("/"), F.col("path")).alias("key"), F.lit(1).alias("closed"),
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"), "host", "path")
    opened = stacks.join(splits, "anchor").select(
        "anchor", F.explode(F.sequence(F.lit(0).cast("long"), F.col("splits") - 1)).alias("split"), "key",
        F.lit(0).alias("closed"), "stack", F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"))

    sweep = Window.partitionBy("anchor", "split").orderBy("key", "closed").rowsBetween(Window.unboundedPreceding, 0)
    # dealt by the split too, which a partitioning by the anchor alone would satisfy
    swept = points.unionByName(opened).repartition(parts, "anchor", "split").withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("closed = 1")
    covers = F.filter("stack", lambda rule: F.startswith(F.col("path"), rule["path"]))
    swept = swept.select("host", "path", "anchor", F.get(covers, F.lit(0)).alias("rule")).where("rule IS NOT NULL")
    best = F.struct((F.length("anchor") + F.col("rule.length")).alias("length"), F.length("anchor").alias("host_length"),
                    F.concat(_reversed(F.split("anchor", r"\.")), F.col("rule.path")).alias("rule"),
                    F.col("rule.action").alias("action"))
    found = swept.groupBy("host", "path").agg(F.max(best).alias("best"))
    return urls.join(found, ["host", "path"], "left").select(
        "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, default="allow", carry=("page_id",), url="url") -> DataFrame:
    """The carried columns of each row, with host, path, rule and verdict of its URL."""
    host, path = host_and_path(url)
    kept = [F.col(name).alias(f"kept_{place}") for place, name in enumerate(carry)]
    rows = pages.select(*kept, host.alias("host"), path.alias("path"))
    names = [F.col(f"kept_{place}").alias(name) for place, name in enumerate(carry)]
    return rows.join(_anew(judged(rows, rules, default), "host", "path"), ["host", "path"]).select(*names, "host", "path", "rule", "verdict")
