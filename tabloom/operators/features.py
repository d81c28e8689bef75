"""Config-driven feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, types as T

from tabloom.functions.calendar import timestamp_features
from tabloom.functions.ports import port_features
from tabloom.operators.clean import col, existing, require_columns


@dataclass(frozen=True)
class FeatureConfig:
    target_col: str
    row_id_col: str = "row_id"
    drop_cols: tuple[str, ...] = ()
    timestamp_cols: tuple[str, ...] = ()
    port_cols: tuple[str, ...] = ()

    def with_target(self, target_col: str, *, drop_old: bool = True) -> FeatureConfig:
        """The same features for another target; the old target is dropped by default so that it cannot leak."""
        extra = (self.target_col,) if drop_old else ()
        return replace(self, target_col=target_col, drop_cols=tuple(sorted({*self.drop_cols, *extra})))


def feature_table(df: DataFrame, config: FeatureConfig, *, keep: Sequence[str] = (), drop_original_times: bool = True) -> DataFrame:
    """Surviving and derived columns in one projection. keep adds columns (ids, split, label) in front."""
    times, ports = existing(df, config.timestamp_cols), existing(df, config.port_cols)
    gone = {*config.drop_cols, config.target_col, config.row_id_col, *(times if drop_original_times else ()), *keep}
    kept = [col(c) for c in keep]
    survivors = [col(c) for c in df.columns if c not in gone]
    typed = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    derived = [f for c in times for f in timestamp_features(c, typed=c in typed)] + [f for c in ports for f in port_features(c)]
    out = df.select(*kept, *survivors, *derived)
    # The drop list holds for derived columns as well.
    return out.drop(*(c for c in out.columns[len(kept) + len(survivors) :] if c in config.drop_cols))


def features_and_label(df: DataFrame, config: FeatureConfig, *, keep: Sequence[str] = ()) -> DataFrame:
    require_columns(df, [config.target_col])
    return feature_table(df, config, keep=[*keep, config.target_col])
