"""Text and flag normalisation."""

from pyspark.sql import Column, functions as F

from quartermill.specs.fixed_values import FEDERAL, JURISDICTION_WIDTH, TRUE_WORDS


def yes_no(condition: str, yes: str = "Y", no: str = "N") -> str:
    """SQL text of a two-valued code; NULL counts as false."""
    return f"CASE WHEN {condition} THEN '{yes}' ELSE '{no}' END"


def normalize_category(category: Column) -> Column:
    """Stable upper-case key of a category; blank and NULL become UNKNOWN."""
    words = F.replace(F.upper(F.trim(category)), F.lit("&"), F.lit(" AND "))
    key = F.btrim(F.regexp_replace(words, "[^A-Z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.when(key != "", key), F.lit("UNKNOWN"))


def impact_flag(value: Column) -> Column:
    """Boolean-like text to boolean; NULL and anything else is false."""
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def jurisdiction(state_code: str, local_code: str) -> str:
    """SQL text: federal, state, or state plus the last four of the local code."""
    return (
        f"CASE WHEN {state_code} IS NULL THEN '{FEDERAL}' WHEN {local_code} IS NULL THEN {state_code} "
        f"ELSE concat({state_code}, right({local_code}, 4)) END"
    )


def jurisdiction_key(value: str) -> str:
    return f"rpad(coalesce({value}, ''), {JURISDICTION_WIDTH}, ' ')"


def jurisdiction_order(value: str) -> str:
    return f"CASE WHEN {value} = '{FEDERAL}' THEN 0 ELSE 1 END"


def jurisdiction_class(value: str) -> str:
    """Which worker fields ride on a jurisdiction: F, S (two letters) or L."""
    return (
        f"CASE WHEN {value} = '{FEDERAL}' THEN 'F' "
        f"WHEN length(trim({jurisdiction_key(value)})) <= 2 THEN 'S' ELSE 'L' END"
    )
