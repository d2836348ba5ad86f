"""Declared target schemas and their mapping."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.read import column_or_null, find_column


class MissingColumns(ValueError):
    """A feed does not have the columns its contract names."""


def check_columns(df: DataFrame, required: Iterable[str], label: str = "feed") -> DataFrame:
    """The frame itself, or ``MissingColumns``; looks at metadata only."""
    missing = [c for c in required if find_column(df, c) is None]
    if missing:
        raise MissingColumns(f"{label}: missing {missing}, has {sorted(df.columns)}")
    return df


@dataclass(frozen=True)
class Spec:
    """Target columns of a feed in output order.

    ``columns`` maps each target to its type.  A target takes its constant if it
    has one, else the source column of ``mapping`` (or of the same name), else
    NULL.  ``optional`` targets are left out when their source is absent, and
    ``exclude`` never come out.
    """

    columns: Mapping[str, str]
    mapping: Mapping[str, str] = field(default_factory=dict)
    constants: Mapping[str, str] = field(default_factory=dict)
    exclude: frozenset[str] = frozenset()
    optional: Mapping[str, str] = field(default_factory=dict)


def conform(df: DataFrame, spec: Spec, extra: Sequence[Column] = ()) -> DataFrame:
    """Map a frame to a target schema in one projection.

    Casts never raise: a value that does not fit its type is NULL.  Source
    names are matched without regard to case.
    """
    out = []
    for target, dtype in spec.columns.items():
        if target in spec.exclude:
            continue
        if target in spec.constants:
            value = F.lit(spec.constants[target]).try_cast(dtype)
        else:
            value = column_or_null(df, spec.mapping.get(target, target), dtype)
        out.append(value.alias(target))
    for target, dtype in spec.optional.items():
        source = spec.mapping.get(target, target)
        if find_column(df, source) is not None:
            out.append(column_or_null(df, source, dtype).alias(target))
    return df.select(*out, *extra)


def select_parsed(df: DataFrame, columns: Sequence[Column | str], parsed: Mapping[str, Column]) -> DataFrame:
    """Select ``columns`` and add ``parsed`` ones that are evaluated once per row.

    A later filter on an ordinary computed column moves below its projection and
    computes it a second time; filters do not move below a generator.  Worth it
    for costly parsing of text that is filtered on right away.
    """
    values = F.struct(*[value.alias(name) for name, value in parsed.items()])
    return df.select(*columns, F.inline(F.array(values)))


def clean_name(name: str) -> str:
    """ASCII letters and digits in lower case; whatever else stands between them is one underscore."""
    return "_".join(re.findall(r"[A-Za-z0-9]+", str(name))).lower()


def attribute_columns(df: DataFrame, names: Sequence[str], taken: Iterable[str]) -> list[Column]:
    """Attribute columns under their clean names.

    A name already in ``taken`` or used by an earlier attribute is skipped.
    """
    used = set(taken)
    out = []
    for name in names:
        clean = clean_name(name)
        if clean not in used and find_column(df, name) is not None:
            used.add(clean)
            out.append(F.col(f"`{name}`").alias(clean))
    return out
