"""Column checks that run before any job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

# The column names accepted for each role of a result table.
ALIASES: Mapping[str, Sequence[str]] = {
    "itemset": ("itemsets", "itemset", "Itemset"),
    "count": ("count", "Count", "frequency", "qty", "quantity"),
    "quantity": ("count", "Count", "frequency", "qty", "quantity", "Quantity"),
    "support": ("support", "Support"),
    "confidence": ("confidence", "Confidence"),
    "antecedent": ("antecedent", "antecedents", "X"),
    "consequent": ("consequent", "consequents", "Y"),
}

# The complete rule summary looks for the short names of the sides before the plural ones.
SUMMARY_ALIASES: Mapping[str, Sequence[str]] = {
    **ALIASES,
    "antecedent": ("antecedent", "X", "antecedents"),
    "consequent": ("consequent", "Y", "consequents"),
}


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged if it has all ``columns``."""
    absent = {*columns}.difference(df.columns)
    if absent:
        raise ValueError(f"the input lacks {', '.join(sorted(absent))}; it has {', '.join(df.columns)}")
    return df


def resolve_roles(
    df: DataFrame, roles: Iterable[str], accepted: Mapping[str, Sequence[str]] = ALIASES
) -> dict[str, str]:
    """The column that plays each role: of those ``df`` has, the one its role lists first.

    All roles are looked up before anything is raised, so one message names every role that has no column.
    """
    found = {role: [c for c in accepted[role] if c in df.columns][:1] for role in roles}
    open_roles = [f"{role} ({' / '.join(accepted[role])})" for role, names in found.items() if not names]
    if open_roles:
        raise ValueError(f"no column for {'; '.join(open_roles)}")
    return {role: names[0] for role, names in found.items()}
