"""Replacement of ``{{Name}}`` template markers.

Known markers are replaced in one pass: the text is split at every known marker,
each name is turned into its value, and the parts are joined again. Values never
hold braces or a piece that could complete another marker (checked below), so one
pass gives what replacing marker after marker would give.

Random values come from a hash of seed, row, column, marker and position. They do
not depend on row order or partitioning, and a retried task draws the same ones.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, functions as F

from turnmill import config
from turnmill.functions.text import collapse_spaces, strip, tighten_punctuation


def marker_pattern(names) -> str:
    """Regex for the given markers, the name as its only group."""
    return r"\{\{(" + "|".join(re.escape(n).replace(r"\ ", " ") for n in names) + r")\}\}"


def draw(*key: Column | str) -> Column:
    """A repeatable non-negative number from the parts of ``key``."""
    parts = [k.cast("string") if isinstance(k, Column) else F.lit(k) for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def _check(values, names) -> None:
    for value in values:
        if not value or "{" in value or "}" in value or any(value in n for n in names):
            raise ValueError(f"marker value {value!r} could form another marker")


def replace_markers(
    text: Column,
    row_id: Column,
    column: str,
    seed: int = 42,
    static: dict | None = None,
    numbers: dict | None = None,
    pools: dict | None = None,
) -> Column:
    """Replace every occurrence of the given markers, case-sensitively. Without any the
    text stays; a marker whose pool is empty becomes the neutral phrase."""
    static, numbers, pools = static or {}, numbers or {}, pools or {}
    names = [*static, *numbers, *pools]
    if not names:
        return text
    _check([*static.values(), *(p for p, _, _ in numbers.values() if p),
            *(v for pool in pools.values() for v in pool)], names)
    pattern = marker_pattern(names)

    # One constant map from name to how its value is made; a value is either picked
    # from choices or a number behind a prefix.
    specs = {name: {"choices": [value]} for name, value in static.items()}
    specs |= {name: {"choices": list(pool) or [config.LEFTOVER_TEXT]} for name, pool in pools.items()}
    specs |= {
        name: {"prefix": prefix, "low": low, "span": high - low + 1}
        for name, (prefix, low, high) in numbers.items()
    }
    spec_map = F.from_json(
        F.lit(json.dumps(specs)),
        "map<string, struct<choices: array<string>, prefix: string, low: long, span: long>>",
    )

    def value(name: Column, position: Column) -> Column:
        n = draw(str(seed), row_id, column, name, position)
        spec = F.element_at(spec_map, name)
        pool = spec["choices"]
        return F.coalesce(
            F.element_at(pool, (n % F.size(pool) + 1).cast("int")),
            F.concat(spec["prefix"], (spec["low"] + n % spec["span"]).cast("string")),
        )

    # An empty name in front pairs the text before the first marker with no value.
    parts = F.arrays_zip(
        F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(pattern), 1)),
        F.split(text, pattern, -1),
    )
    pieces = F.transform(
        parts,
        lambda part, i: F.when(i == 0, part["1"]).otherwise(
            F.concat(F.coalesce(value(part["0"], i), F.lit("")), F.coalesce(part["1"], F.lit("")))
        ),
    )
    return F.when(F.contains(text, F.lit("{{")), F.array_join(pieces, "")).otherwise(text)


def replace_leftover(text: Column) -> Column:
    """Replace any marker that is still there by a neutral phrase."""
    return F.regexp_replace(text, config.LEFTOVER_PATTERN, config.LEFTOVER_TEXT)


def tidy(text: Column) -> Column:
    """Repair spacing that replacements leave behind."""
    return strip(tighten_punctuation(collapse_spaces(text)))


def clean_text(
    text: Column, row_id: Column, column: str, params: config.CurateParams | None = None
) -> Column:
    """Strip, replace known markers, replace leftover markers, repair spacing."""
    p = params or config.CurateParams()
    known = replace_markers(
        strip(text), row_id, column, p.seed, p.static_markers, p.number_markers, p.pool_markers
    )
    return tidy(replace_leftover(known))
