"""Column -> Column helpers for qualified names and small scalar rules.

All are compositions of Spark SQL built-ins (JVM side, code-generated).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, inside one expression.

    A column of its own would do the same, but each such step copies the whole row, a parsed plan with it."""
    return F.transform(F.array(value), body)[0]


def default_db(db) -> Column:
    """a missing database means ``default``."""
    return F.coalesce(_c(db), F.lit(K.DEFAULT_DB))


def table_qn(db, tbl, ns: str = K.NAMESPACE) -> Column:
    """``db.tbl@ns``, case kept."""
    return F.concat(default_db(db), F.lit("."), _c(tbl), F.lit("@" + ns))


def input_col_qn(db, tbl, col, ns: str = K.NAMESPACE) -> Column:
    """The whole ``db.tbl.col@ns`` string is lower-cased."""
    return F.lower(F.concat(default_db(db), F.lit("."), _c(tbl), F.lit("."), _c(col), F.lit("@" + ns)))


def output_col_qn(db, tbl, col, ns: str = K.NAMESPACE) -> Column:
    """Only the column part is lower-cased: ``db.tbl.lower(col)@ns``."""
    return F.concat(_c(db), F.lit("."), _c(tbl), F.lit("."), F.lower(_c(col)), F.lit("@" + ns))


def lineage_id(db, tbl, col, ns: str = K.NAMESPACE) -> Column:
    """Column-lineage id ``db.tbl@ns:lower(col)``."""
    return F.concat(_c(db), F.lit("."), _c(tbl), F.lit("@" + ns + ":"), F.lower(_c(col)))


def empty_to_default(x, default) -> Column:
    """null or empty string -> default.  No trim: a blank string is kept."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), default if isinstance(default, Column) else F.lit(default))


def has_both_parens(text) -> Column:
    """F8: text contains ``(`` and ``)``."""
    t = _c(text)
    return t.contains("(") & t.contains(")")


def trim_and_purge(arr) -> Column:
    """trim each item, drop empty ones; a null array becomes empty."""
    a = F.coalesce(_c(arr), F.array().cast("array<string>"))
    return F.filter(F.transform(a, lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def split_list(text, sep: str = ",") -> Column:
    """A configured list (``" a , ,b "``) -> cleaned array."""
    return trim_and_purge(F.split(_c(text), sep))


def user_preference(given, group_user, current=None) -> Column:
    """given -> group user -> current user of the session."""
    cur = current if current is not None else F.current_user()
    return F.coalesce(F.nullif(_c(given), F.lit("")), F.nullif(_c(group_user), F.lit("")), cur)


def strip_expr_ids(text) -> Column:
    """Drop run-specific expression ids (``name#13``, ``id#7L``) from plan text."""
    return F.regexp_replace(_c(text), r"#\d+L?", "")
