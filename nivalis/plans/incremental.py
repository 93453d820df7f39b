"""What is to be done for each tile-day: files that have come against what has been done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS = ("ingest", "weight", "inversion", "corrected_snow", "spatial")
# The steps that a mode runs again although nothing has changed.
MODES = {0: (), 1: ("weight", "inversion", "corrected_snow", "spatial"), 11: ("weight",), 19: ("ingest", "weight"), 20: ("corrected_snow",), 80: ("spatial",), 99: STEPS}


def incremental_plan(days: DataFrame, files: DataFrame, status: DataFrame, mode: int = 0) -> DataFrame:
    """Per expected tile-day an action and whether each step (do_<step>) is to run.

    `files` has at most one file per tile-day (see latest_file). New or changed ones (by name or
    edit time, unless they are the file discarded as corrupt) are ingested with all steps, with
    mode 19 with weights only. Without a file the day is set to nodata, once. Unchanged ones run
    the steps their status lacks or the mode asks for, or are skipped.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    on = ["tile", "obs_date"]
    own = days.join(files.select(*on, "file_name", "edit_ts"), on, "left").join(status, on, "left")
    has_file = F.col("file_name").isNotNull() & ~(F.col("file_name").eqNullSafe(F.col("discarded_file_name")) & F.col("edit_ts").eqNullSafe(F.col("discarded_edit_ts")))
    changed = has_file & ~(F.col("file_name").eqNullSafe(F.col("input_file_name")) & F.col("edit_ts").eqNullSafe(F.col("input_edit_ts")))
    done = {s: F.coalesce(F.col(f"status_of_{s}") == 1, F.lit(False)) for s in STEPS}
    everything = done["ingest"] & done["weight"] & done["inversion"] & done["corrected_snow"] & done["spatial"]
    known = F.col("input_file_name").isNotNull()
    own = own.withColumns({"_new": changed | (has_file & F.lit(mode == 99)), "_none": ~has_file & ~known & (~everything | F.lit(mode == 99))})
    partial = mode in (11, 19, 20, 80)
    new_steps = ("ingest", "weight") if mode == 19 else STEPS
    flags = {}
    for s in STEPS:
        again = F.lit(s in MODES[mode] and not (s == "ingest" and mode != 99)) if mode != 19 else F.lit(s in MODES[19])
        lacking = ~done[s] if s != "ingest" and not partial else F.lit(False)
        rest = (has_file | known) & (again | lacking)
        flags[f"do_{s}"] = F.when(F.col("_none"), False).when(F.col("_new"), s in new_steps).otherwise(F.coalesce(rest, F.lit(False)))
    own = own.withColumns(flags)
    anything = F.col("do_ingest") | F.col("do_weight") | F.col("do_inversion") | F.col("do_corrected_snow") | F.col("do_spatial")
    action = F.when(F.col("_none"), "set_nodata").when(F.col("do_ingest"), "ingest").when(anything, "recompute").otherwise("skip")
    return own.select(*on, "file_name", action.alias("action"), *flags)
