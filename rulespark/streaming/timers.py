"""Waiting rules with a timer each: their exceptions by arbitrary stateful processing.

Each rule has one row of state, with the waits that are open. A wait ends with the first
exception in its time, or by its timer, an event-time timeout in the state store. Only the
ledger moves the clock; a rule that begins to wait later does not, and nothing is ever
dropped for being late: rows that matter carry no event time of their own.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..model import SUCCESS, YES
from ..operators.joins import KEY

DECIDED = f"{KEY} string, started_at timestamp, resolved boolean"
_STATE = "started array<bigint>, at_start array<boolean>, early array<bigint>"


def _micros(column):
    return F.unix_micros(F.col(column).cast("timestamp"))


def _rows(waiting, ledger, timeout, accept_success, ids):
    """What the state sees, with ``at`` null, and each dated ledger row once more as the clock."""
    resolving = F.col("exception_applied").eqNullSafe(YES)
    if accept_success:
        resolving = resolving | F.col("rule_execution_status").eqNullSafe(SUCCESS)
    resolving = resolving & F.col(KEY).isNotNull()
    kind = "struct<rule_id:string,started:bigint,at_start:boolean,excepted:bigint,at:timestamp>"
    none = F.lit(None)
    waits = waiting.where(F.col(KEY).isNotNull() & F.col("started_at").isNotNull() & ~F.coalesce("at_start", F.lit(False))).select(F.struct(F.col(KEY), _micros("started_at"), F.coalesce("at_start", F.lit(False)), none, none).cast(kind).alias("row"))
    ledger = ledger.where(F.col("created_dt").isNotNull())
    if ids is not None:
        begins = _micros("started_at") if "started_at" in ids.columns else F.lit(None).cast("bigint")
        ids = ids.groupBy(F.col(KEY).alias("waits")).agg(F.collect_set(begins).alias("begins"), F.count_if(begins.isNull()).alias("open"))
        ledger = ledger.join(ids, F.col(KEY) == F.col("waits"), "left")
        since = _micros("created_dt") - F.lit(timeout)
        in_time = F.exists("begins", lambda begin: (begin < _micros("created_dt")) & (begin >= since))
        resolving = resolving & F.col("waits").isNotNull() & ((F.col("open") > 0) | in_time)
    clock = F.struct(none, none, none, none, F.col("created_dt")).cast(kind)
    excepted = F.struct(F.col(KEY), none, none, _micros("created_dt"), none).cast(kind)
    found = ledger.select(F.explode(F.array_compact(F.array(clock, F.when(resolving, excepted)))).alias("row"))
    return waits.unionByName(found).select("row.*")


def _decide(timeout):
    def decide(key, batches, state):
        started, at_start, early = state.get if state.exists else ([], [], [])
        waits, exceptions = list(zip(started, at_start)), list(early)
        # plain lists: a rule has few rows, and pandas takes longer to look at a column than Python at a few values
        for rows in () if state.hasTimedOut else batches:
            for begin, excepted, moment in zip(rows["started"].tolist(), rows["at_start"].tolist(), rows["excepted"].tolist()):
                if begin is not None and begin == begin:
                    waits.append((int(begin), bool(excepted)))
                if moment is not None and moment == moment:
                    exceptions.append(int(moment))
        now = state.getCurrentWatermarkMs() * 1000
        exceptions = sorted(set(exceptions))
        ended, open_waits = [], []
        for begin, excepted in sorted(set(waits)):
            if excepted or any(begin < moment <= begin + timeout for moment in exceptions):
                ended.append((begin, True))
            elif begin + timeout <= now:
                ended.append((begin, False))
            else:
                open_waits.append((begin, excepted))
        # an exception may come in before the row that says its rule waits
        exceptions = [moment for moment in exceptions if moment + timeout > now]
        if open_waits or exceptions:
            state.update(([begin for begin, _ in open_waits], [excepted for _, excepted in open_waits], exceptions))
            until = min([begin for begin, _ in open_waits] + exceptions) + timeout
            state.setTimeoutTimestamp(max(until // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        if ended:
            moments = pd.DatetimeIndex(np.array([begin for begin, _ in ended], "datetime64[us]"), tz="UTC")
            yield pd.DataFrame({KEY: [key[0]] * len(ended), "started_at": moments, "resolved": [done for _, done in ended]})

    return decide


def exception_timers(waiting, ledger, timeout, delay="10 minutes", accept_success=False, ids=None):
    """A stream of each wait's end: rule_id, started_at, and whether it was resolved.

    ``waiting`` and ``ledger`` are streams, as for ``exception_matches``. A wait is resolved
    by an exception dated in ``(started_at, started_at + timeout]``, in whatever order rows
    come in, until the newest ledger row is ``delay`` past its deadline; then its timer ends
    it. ``delay`` is how long after the deadline's date a row may still come in. With ``ids``,
    a table of rules that may wait, others leave no trace in the state; if it has their waits'
    ``started_at``, all that a rule may have, nor do exceptions in the time of none of them.
    """
    micros = int(timeout.total_seconds() * 1_000_000)
    rows = _rows(waiting, ledger, micros, accept_success, ids).withWatermark("at", delay)
    # the clock's rows have done their work; only a condition on ``at`` itself stays above the watermark
    rows = rows.where(F.col("at").isNull())
    ends = rows.groupBy(KEY).applyInPandasWithState(
        _decide(micros), DECIDED, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    # a wait that is over as it begins needs neither state nor a call of Python
    over = waiting.where(F.col(KEY).isNotNull() & F.col("started_at").isNotNull() & F.col("at_start"))
    return ends.unionByName(over.select(KEY, F.col("started_at").cast("timestamp"), F.lit(True).alias("resolved")))
