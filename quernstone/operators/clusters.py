"""Greedy clustering of titles into units, where the order matters and units grow."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def greedy(items: DataFrame, group: str, ident: str, words: str, threshold: float = 0.18) -> DataFrame:
    """(group, id, unit): each item, in order of its id, joins the unit of highest similarity of at least ``threshold``, else opens one.

    A unit's words are those of all its members, so the result depends on the order and no
    parallel merge gives the same.  Groups are independent; one task folds one group.  Inside
    a group an inverted index finds the units that share a word, so an item isn't compared with all.
    Give groups that are bounded by meaning (a course, a subject); this operator isn't for whole corpora.
    """

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(ident, kind="stable")
        units: list[set] = []
        index: dict[str, set[int]] = {}
        out = []
        for tokens in rows[words]:
            mine = set(tokens if tokens is not None else ())
            near = {u for w in mine for u in index.get(w, ())}
            scored = sorted((-(len(mine & units[u]) / len(mine | units[u])), u) for u in near)
            if scored and -scored[0][0] >= threshold:
                unit = scored[0][1]
                units[unit] |= mine
            else:
                unit = len(units)
                units.append(set(mine))
            for w in mine:
                index.setdefault(w, set()).add(unit)
            out.append(unit + 1)
        return pd.DataFrame({group: rows[group].to_numpy(), ident: rows[ident].to_numpy(), "unit": out})

    types = dict(items.dtypes)
    return items.select(group, ident, words).groupBy(group).applyInPandas(fold, f"{group} {types[group]}, {ident} {types[ident]}, unit int")
