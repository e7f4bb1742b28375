from .exceptions import exception_matches, read_resolved, wait_for_exceptions, waiting_at, write_matches
from .latest import compact_latest, latest_updates, read_latest, write_latest
from .rules import write_rule
from .timers import DECIDED, exception_timers
from .verdicts import read_verdicts, write_verdicts

__all__ = [
    "DECIDED", "compact_latest", "exception_matches", "exception_timers", "latest_updates", "read_latest", "read_resolved", "read_verdicts",
    "wait_for_exceptions", "waiting_at", "write_latest", "write_matches", "write_rule", "write_verdicts",
]
