"""Catalogs whose strings compare as SQL Server's usual collation does: without case and trailing blanks.

``collated(cat)`` gives every string column the collation ``UTF8_LCASE_RTRIM``, so
equality, ``IN``, joins, grouping and distinct counts of all reports, and of SQL
that users bring along, follow it; the reports do not change.

Spark pushes no filter on a collated column.  For columns that reports compare with
constants the catalog keeps the plain column beside the collated one, and
``preselect`` tests its first letters in either case: that loses nothing, reaches
the scan, and the collated comparison decides.
"""

from __future__ import annotations

import functools
import itertools
import operator
from dataclasses import fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careledger.sources.catalog import Catalog

COLLATION = "UTF8_LCASE_RTRIM"
PLAIN = "{}__plain"
LETTERS = 2             # letters of a constant that the scan tests: 2 ** LETTERS spellings
# table -> columns that reports compare with constants
COMPARED = {
    "episodes": ["epi_status", "epi_AdmitType"],
    "episode_care_types": ["cect_primary"],
    "visits": ["cev_setsocdateflag"],
}


def _collate(df: DataFrame, collation: str, keep_plain: list[str] | None = None) -> DataFrame:
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    plain = [F.col(c).alias(PLAIN.format(c)) for c in keep_plain or [] if c in strings]
    return df.select(*[F.collate(c, collation).alias(c) if c in strings else F.col(c) for c in df.columns], *plain)


class CollatedCatalog(Catalog):
    """A catalog with one collation for all its strings, also those of the inline code maps."""

    @property
    def dc_class(self) -> DataFrame:
        return _collate(super().dc_class, COLLATION)

    @property
    def lupa_codes(self) -> DataFrame:
        return _collate(super().lupa_codes, COLLATION)


def collated(cat: Catalog) -> Catalog:
    """The catalog with case-blind strings; the branch dimension and code tables included."""
    return CollatedCatalog(**{f.name: getattr(cat, f.name) if f.name == "spark" else
                              _collate(getattr(cat, f.name), COLLATION, COMPARED.get(f.name)) for f in fields(cat)})


def _spellings(value: str) -> list[str]:
    """The beginnings, in either case, of what equals ``value``; the Kelvin sign is a small k in this collation."""
    either = [sorted({c.lower(), c.upper()} | ({"K"} if c in "kK" else set())) for c in value[:LETTERS]]
    return ["".join(p) for p in itertools.product(*either)]


def preselect(df: DataFrame, **wanted: str | tuple[str, ...]) -> DataFrame:
    """Rows that can equal the wanted values, by the plain columns of a collated catalog; all rows of another."""
    for column, values in wanted.items():
        plain = PLAIN.format(column)
        if plain in df.columns:
            begins = {s for v in ([values] if isinstance(values, str) else values) for s in _spellings(v)}
            df = df.filter(functools.reduce(operator.or_, (F.col(plain).startswith(s) for s in sorted(begins))))
    return df


def one_spelling(c: Column | str) -> Column:
    """An aggregate that names a group of equal strings: the spelling that is least by its code points."""
    return F.min(F.collate(c, "UTF8_BINARY"))
