"""Many SQL rules as one plan: their stamped rows in one statement and one write.

A table that several of the rules name is scanned once. It stands in front of the
statement as a common table that Spark may not copy into each of its uses, so Catalyst
gives it the columns and the filters that any of the rules needs, pushes those to the
scan, and lets the uses read one exchange. A rule's text stays as it is.
"""

import logging
import re

from pyspark.sql import functions as F

from ..model import RESULT_COLUMNS, RESULT_DATA_COLUMNS
from ..sources.commits import exists, remove
from .programs import named_tables, program_text, sql_arguments

logger = logging.getLogger(__name__)

RULE, RUN = "rule", "run"
#: Below the results' folder, beside the folders of rules that run by themselves.
TOGETHER = "one_plan"
#: Names that are a folder's name as they are.
_PLAIN = re.compile(r"[A-Za-z0-9_.-]+")


def can_share(rule):
    """SQL rules whose ids can name folders as they are; others run by themselves."""
    names = rule["rule_id"], rule["rule_run_id"]
    return (rule["program_type"] or "").lower() == "sql" and all(name and _PLAIN.fullmatch(name) and name not in (".", "..") for name in names)


def shared_path(base, rule_id, run_id):
    return f"{base.rstrip('/')}/{TOGETHER}/{RULE}={rule_id}/{RUN}={run_id}"


def _text_literal(value):
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _branch(rule, text):
    columns = [f"CAST({name} AS STRING) AS {name}" for name in RESULT_DATA_COLUMNS]
    ids = [f"{_text_literal(value)} AS {name}" for name, value in zip(RESULT_COLUMNS, (rule["rule_run_id"], rule["rule_id"]))]
    return f"SELECT {', '.join([*ids, *columns])} FROM (\n{text.rstrip().rstrip(';')}\n)"


class SharedRules:
    """Rules whose texts can stand in one statement, for one session and its tables."""

    def __init__(self, session, tables, as_of_date, share_from=2):
        self.session, self.tables, self.as_of_date, self.share_from = session, tables, as_of_date, share_from
        self.branches, self.named, self.rule_ids, self.views = {}, {}, {}, set()

    def add(self, rule):
        """Take a rule in if Spark can resolve its text as a query; say whether it could."""
        try:
            text, args = sql_arguments(program_text(self.session, rule["program_code"]), self.as_of_date)
            named = named_tables(self.session, rule, self.tables)
            for name in set(named) - self.views:
                self.tables[name].createOrReplaceTempView(name)
                self.views.add(name)
            branch = _branch(rule, text)
            self.session.sql(branch, args=args).schema  # noqa: B018
        except Exception as error:
            logger.info("rule %s runs by itself: %s", rule["rule_id"], error)
            return False
        run_id = rule["rule_run_id"]
        self.branches[run_id], self.named[run_id], self.rule_ids[run_id] = (branch, args), named, rule["rule_id"]
        return True

    def rows(self, run_ids):
        """The stamped rows of some of the rules, as one DataFrame.

        ``rand() >= 0`` holds for every row. It is what keeps Spark from copying the common
        table: only what is not sure to be the same twice is computed once.
        """
        run_ids = list(run_ids)
        uses = [name for run_id in run_ids for name in set(self.named[run_id])]
        shared = sorted({name for name in uses if uses.count(name) >= self.share_from})
        common = ", ".join(f"`{name}` AS (SELECT * FROM `{name}` WHERE rand() >= 0)" for name in shared)
        branches, arguments = zip(*(self.branches[run_id] for run_id in run_ids))
        args = {name: value for one in arguments for name, value in (one or {}).items()}
        return self.session.sql((f"WITH {common}\n" if shared else "") + "\nUNION ALL\n".join(branches), args=args or None)

    def write(self, run_ids, base):
        """Save rows of several rules in one write, a folder per rule and run.

        A repeated attempt replaces the folders of its own runs. Returns the runs that have rows.
        """
        paths = {run_id: shared_path(base, self.rule_ids[run_id], run_id) for run_id in run_ids}
        for path in paths.values():
            remove(self.session, path)  # an earlier attempt's rows, where this one may have none
        rows = self.rows(run_ids).withColumns({RULE: F.col(RESULT_COLUMNS[1]), RUN: F.col(RESULT_COLUMNS[0])})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RULE, RUN).parquet(f"{base.rstrip('/')}/{TOGETHER}")
        return {run_id for run_id, path in paths.items() if exists(self.session, path)}

    def write_each(self, run_ids, base):
        """As ``write``; where that fails, each half by itself, down to the rules that fail alone.

        Yields (run id, has rows, error) for every rule.
        """
        run_ids = list(run_ids)
        try:
            with_rows = self.write(run_ids, base)
        except Exception as error:
            if len(run_ids) == 1:
                yield run_ids[0], False, error
                return
            half = len(run_ids) // 2
            logger.warning("%d rules fail together, and are halved: %s", len(run_ids), error)
            yield from self.write_each(run_ids[:half], base)
            yield from self.write_each(run_ids[half:], base)
        else:
            for run_id in run_ids:
                yield run_id, run_id in with_rows, None
