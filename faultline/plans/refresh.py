"""Marts that grow by batches: counts are kept as additive state, and a refresh reads only what a batch changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import DEFAULTS, Settings
from faultline.operators.counts import clearance_rows, in_years, sum_counts
from faultline.operators.dedup import rank_versions
from faultline.plans.marts import firm_event_rows, firm_recall_rows, marts_from
from faultline.sources.tables import write_table

# Events, recalls and clearances by these names; any of them may be missing.
Facts = Mapping[str, DataFrame]


def fact_counts(facts: Facts, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Rows to be summed, of the facts that are there: by firm, product and year, and clearances by product and year."""
    years = settings.year_min, settings.year_max
    rows = {}
    if "events" in facts:
        rows["events"] = firm_event_rows(facts["events"], settings)
    if "recalls" in facts:
        rows["recalls"] = firm_recall_rows(facts["recalls"], settings)
    if "clearances" in facts:
        rows["clearances"] = clearance_rows(in_years(facts["clearances"], "decision_year", *years), ["product_code"])
    return rows


def write_batch(batch: str, folder: str, added: Facts, withdrawn: Facts | None = None, settings: Settings = DEFAULTS) -> None:
    """Store what a batch changes in the counts: those of ``added`` rows, less those of rows counted before that no longer hold.

    A batch has a folder of its own that is overwritten, so one that is repeated counts once.
    """
    less = fact_counts(withdrawn or {}, settings)
    for name, rows in fact_counts(added, settings).items():
        if name in less:
            measures = [c for c, kind in less[name].dtypes if kind == "bigint"]
            rows = rows.unionByName(less[name].withColumns({c: -F.col(c) for c in measures}))
        write_table(sum_counts(rows), f"{folder}/state/{name}/batch={batch}")


def marts_from_state(spark: SparkSession, folder: str, dim: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """The three marts from the stored counts of all batches. Groups that batches have emptied again leave no row."""
    kept = {}
    for name in ("events", "recalls", "clearances"):
        counts = sum_counts(spark.read.parquet(f"{folder}/state/{name}").drop("batch"))
        measures = [c for c, kind in counts.dtypes if kind == "bigint"]
        kept[name] = counts.where(" OR ".join(f"{c} <> 0" for c in measures))
    return marts_from([kept["events"], kept["recalls"]], kept["clearances"], dim, settings)


def reranked(before: DataFrame, new: DataFrame, tie_break: Sequence[str] = (), key: str = "mdr_report_key") -> tuple[DataFrame, DataFrame]:
    """(added, withdrawn) events when ``new`` unranked rows join the ranked rows ``before``.

    Only reports that the new rows belong to change: their earlier rows are withdrawn and come back ranked anew.
    """
    touched = before.join(new.select(key).distinct(), key, "left_semi").select(*before.columns)
    plain = [c for c in before.columns if c not in ("followup_rank", "is_latest_version")]
    added = rank_versions(touched.select(*plain).unionByName(new.select(*plain)), key=key, tie_break=tie_break)
    return added, touched
