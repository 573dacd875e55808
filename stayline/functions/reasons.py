"""From a row of signed contributions to its strongest reasons.

The ranking is a short lambda and the names are looked up afterwards: spelling the array out
element by element makes one generated method too large for the JVM to compile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three wordings, with their words for a positive and any other contribution.
SCORING = ("%s (%s, SHAP=%+.3f)", "high risk", "low risk")
RETENTION = ("%s → %s churn risk (SHAP=%+.3f)", "elevated", "lower")
SIGNAL = ("%s is %s risk signal (SHAP=%+.4f)", "HIGH", "LOW")


def name_of(names: Sequence[str], at: str) -> str:
    """SQL for the name at position ``at``."""
    return "array(" + ", ".join(f"'{name}'" for name in names) + f")[{at}]"


def rank_contributions(contributions: str, top: int) -> Column:
    """The ``top`` values as structs (key, at, value), largest magnitude first.

    ``at`` is the feature's position; ties keep feature order.
    """
    return F.expr(
        f"slice(sort_array(transform({contributions},"
        f" (v, i) -> struct(-abs(v) AS key, i AS at, v AS value))), 1, {top})"
    )


def describe(
    ranked: str, names: Sequence[str], count: int, wording: tuple[str, str, str] = SCORING
) -> list[Column]:
    """One sentence for each of the first ``count`` ranked values; a zero is no reason to leave."""
    template, positive, other = wording
    return [
        F.expr(
            f"format_string('{template}', {name_of(names, f'{ranked}[{n}].at')},"
            f" if({ranked}[{n}].value > 0, '{positive}', '{other}'), {ranked}[{n}].value)"
        )
        for n in range(count)
    ]


def contribution_json(contributions: str, names: Sequence[str], digits: int = 4) -> Column:
    scale = f"{10**digits}D"
    items = ", ".join(
        f"'{name}', rint({contributions}[{at}] * {scale}) / {scale}" for at, name in enumerate(names)
    )
    return F.expr(f"to_json(named_struct({items}))")
