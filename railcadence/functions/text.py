"""Codes and names."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, functions as F

from railcadence import schema as S


def stop_id(ref: Column) -> Column:
    """Number in a stop reference such as ``STIF:StopArea:SP:43186:``."""
    return F.try_element_at(F.split(ref, ":"), F.lit(-2)).try_cast("int")


def mission_type(mission: Column) -> Column:
    return F.substring(mission, 1, S.MISSION_TYPE_LEN)


def direction(mission: Column, north_letters: Iterable[str] = S.NORTH_LETTERS) -> Column:
    first = F.substring(mission, 1, 1)
    return F.when(first.isin(*north_letters), F.lit(S.NORTH)).otherwise(F.lit(S.SOUTH))


def corrected_destination(
    code: Column, destination: Column, rules: dict[str, str] = S.DESTINATION_RULES
) -> Column:
    """Destination with the known feed errors put right, keyed on the first letter."""
    first = F.substring(code, 1, 1)
    out = None
    for letter, name in rules.items():
        out = F.when(first == letter, F.lit(name)) if out is None else out.when(first == letter, F.lit(name))
    return destination if out is None else out.otherwise(destination)


def _decomposed(col: Column) -> Column:
    """Unicode NFKD form; there is no built-in for it.

    The function is local so that it travels with the plan and executors need
    no copy of this package.
    """

    @F.pandas_udf("string")
    def nfkd(values: pd.Series) -> pd.Series:
        return values.str.normalize("NFKD") if values.notna().any() else values

    return nfkd(col)


def _bare(name: Column) -> Column:
    return F.regexp_replace(name, r"\([^\n]*?\)", "")


def _folded(bare: Column) -> Column:
    """Decomposed where needed: of plain ASCII text only a NULL goes to Python."""
    return F.coalesce(_decomposed(F.when(bare.rlike(r"[^\x00-\x7F]"), bare)), bare)


def _key(folded: Column) -> Column:
    key = F.regexp_replace(F.lower(folded), "[ -]", "_")
    key = F.regexp_replace(key, r"[^\p{L}\p{N}_]+", "")
    key = F.regexp_replace(key, "_+", "_")
    return F.btrim(key, F.lit("_"))


def normalize_key(name: Column) -> Column:
    """Name to a column-safe key: no bracketed part, no accents, lower case, ``_`` between words.

    Accents are separate marks after decomposition and go with everything else
    that is neither letter, digit nor ``_``.
    """
    return _key(_folded(_bare(name)))


def normalize_keys(names: Column) -> Column:
    """:func:`normalize_key` of every name of an array, as one text per row on the way to Python."""
    # line breaks leave no trace in a key, so they can part the names
    lines = F.array_join(F.transform(names, lambda n: F.replace(_bare(n), F.lit("\n"), F.lit(""))), "\n")
    return F.transform(F.split(_folded(lines), "\n", -1), _key)
