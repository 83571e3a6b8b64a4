"""Column preparation: declared columns, types, derived features, indicators, quality flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import schema as S
from emberline.functions.columns import epoch_seconds, typed
from emberline.operators.audit import ANOMALY_RULES


def ensure_columns(df: DataFrame, expected: dict[str, T.DataType]) -> DataFrame:
    """Add missing columns as typed NULLs and cast the present ones; other columns are kept."""
    return df.withColumns({
        name: typed(name, kind) if name in df.columns else F.lit(None).cast(kind)
        for name, kind in expected.items()})


_TARGETS = {"Int32": "int", "Int64": "bigint", "Float32": "float", "boolean": "boolean", "string": "string"}


def convert_types(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """Cast columns to the named types; ``datetime`` takes epoch seconds. Bad values become NULL."""
    changes = {}
    for name, target in targets.items():
        if target == "datetime":
            changes[name] = F.timestamp_seconds(F.col(name).try_cast("bigint"))
        else:
            changes[name] = F.col(name).try_cast(_TARGETS[target])
    return df.withColumns(changes)


LOG_SOURCES = [*S.COUNT_COLUMNS, "review_length"]


def add_derived(df: DataFrame) -> DataFrame:
    """Event timestamps, text length, and ``log_*`` = log1p of the counts and the text length.

    NULL stays NULL. Timestamps do not depend on the session zone.
    """
    lengths = df.withColumn("review_length", F.length("review"))
    return lengths.withColumns({
        **{f"{c}_ts": F.timestamp_seconds(epoch_seconds(df, c)) for c in S.EPOCH_COLUMNS},
        **{f"log_{c}": F.log1p(F.col(c).cast("double")) for c in LOG_SOURCES}})


def add_indicators(df: DataFrame) -> DataFrame:
    sources = {"has_comments": "comment_count", "has_votes_up": "votes_up", "has_funny_votes": "votes_funny",
               "has_recent_playtime": "author_playtime_last_two_weeks", "has_weighted_vote_score": S.SCORE_COLUMN}
    return df.withColumns({new: F.col(old) > 0 for new, old in sources.items()})


def add_quality_flags(df: DataFrame) -> DataFrame:
    """The anomaly rules as columns, so that rows are marked rather than removed."""
    return df.withColumns({r.name: F.expr(r.predicate) for r in ANOMALY_RULES
                           if r.name != "votes_funny_exact_uint32_max"})


def build_features(cleaned: DataFrame) -> DataFrame:
    """Derived columns and indicators on cleaned reviews."""
    return add_indicators(add_derived(cleaned))
