"""Rule programs: SQL statements, Python functions or files, and registered kinds."""

import inspect
import re
from datetime import datetime

_DATE_MARK = "${as_of_date}"
_DATE_NAME = "as_of_date"

_handlers = {}
_functions = {}


def register_program_type(name, handler):
    """Run rules of type ``name`` with ``handler(session, rule, tables, as_of_date)``.

    ``rule`` is a dict, ``tables`` maps logical names to DataFrames, which are also
    temporary views of ``session``. The handler returns a DataFrame.
    """
    _handlers[name.lower()] = handler


def program_types():
    return sorted(_handlers)


def handler_for(name):
    try:
        return _handlers[name.lower()]
    except (KeyError, AttributeError):
        raise ValueError(f"unsupported program type: {name!r}") from None


def run_program(session, rule, tables, as_of_date):
    """The rows of one rule's program. The tables must belong to ``session``.

    The tables that the program names become views; others of ``tables`` are read only
    if a Python program asks for them.
    """
    check_date(as_of_date)
    handler = handler_for(rule["program_type"])
    for name in named_tables(session, rule, tables):
        tables[name].createOrReplaceTempView(name)
    return handler(session, rule, tables, as_of_date)


def named_tables(session, rule, tables):
    """The tables whose names are in the program's text; all, where there is no text to look into."""
    code = rule["program_code"]
    if rule["program_type"].lower() not in ("sql", "python"):
        return list(tables)
    try:
        text = inspect.getsource(_functions[code]) if code in _functions else program_text(session, code)
    except (OSError, TypeError):
        return list(tables)
    return [name for name in tables if name.lower() in text.lower()]


def check_date(as_of_date):
    """An as-of date is eight digits that make a date."""
    if not re.fullmatch(r"[0-9]{8}", as_of_date):
        raise ValueError(f"as-of date {as_of_date!r} is not YYYYMMDD")
    datetime.strptime(as_of_date, "%Y%m%d")


def program_text(session, path):
    """A program's text, from a path of this machine or of any file system Spark knows."""
    if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:/", path):
        with open(path, encoding="utf-8") as source:
            return source.read()
    return session.read.text(path, wholetext=True).first().value


def sql_arguments(text, as_of_date):
    """A statement with the date in for ``${as_of_date}``, and the arguments that it names."""
    check_date(as_of_date)
    text = text.replace(_DATE_MARK, as_of_date)
    if "${" in text:
        raise ValueError("the only ${...} a rule may use is ${as_of_date}")
    return text, {_DATE_NAME: as_of_date} if f":{_DATE_NAME}" in text else None


def run_sql_rule(session, text, as_of_date):
    """One SQL statement. The date goes in for ``${as_of_date}`` and as ``:as_of_date``."""
    text, args = sql_arguments(text, as_of_date)
    return session.sql(text, args=args)


def python_rule(name):
    """Register a function ``(spark, dataframes, as_of_date, rule_id) -> DataFrame``
    under the name that a rule's ``program_code`` gives."""

    def register(function):
        _functions[name] = function
        return function

    return register


def run_python_rule(session, code, dataframes, as_of_date, rule_id):
    """A registered function, or the text of a program that sets ``result_df``.

    It runs in the driver's process, as the user's other PySpark code does.
    """
    context = {"spark": session, "dataframes": dataframes, "as_of_date": as_of_date, "rule_id": rule_id}
    if code in _functions:
        return _functions[code](**context)
    exec(compile(code, f"<rule {rule_id}>", "exec"), context)
    if "result_df" not in context:
        raise ValueError("a Python rule must set result_df")
    return context["result_df"]


def _sql_handler(session, rule, tables, as_of_date):
    return run_sql_rule(session, program_text(session, rule["program_code"]), as_of_date)


def _python_handler(session, rule, tables, as_of_date):
    code = rule["program_code"]
    if code not in _functions:
        code = program_text(session, code)
    return run_python_rule(session, code, tables, as_of_date, rule["rule_id"])


register_program_type("sql", _sql_handler)
register_program_type("python", _python_handler)
