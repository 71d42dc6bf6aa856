"""All 14 table builds in dependency order, each written once.

``person``, ``stays_pmsi`` and ``prestations`` feed several later builds; they
are written first and read back, so later builds start from stored files (no
recomputation, short lineage, nothing lost with an executor).  The six hospital
builds join the stays on their id, the three city-care builds the distinct claim
lines on their key: those two are stored bucketed by it, so that each build shuffles
its own lines alone.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.joins import HOT_ROWS
from carelake.plans.condition import build_condition_dcir, build_condition_pmsi
from carelake.plans.device import build_device_dcir, build_device_pmsi
from carelake.plans.drug import build_drug_dcir, build_drug_pmsi
from carelake.plans.measurement import build_measurement_dcir, build_measurement_pmsi
from carelake.plans.medical_units import build_medical_units
from carelake.plans.person import build_causes_of_death, build_person
from carelake.plans.prestations import build_prestations, claim_hub
from carelake.plans.procedure import build_procedure
from carelake.plans.stays import build_stays
from carelake.sinks import drop_hub, replace_partitions, write_hub, write_table
from carelake.sources.readers import read_table
from carelake.sources.tables import Sources

# step -> (hub it reads, builder)
STEPS: dict[str, tuple[str | None, Callable[..., DataFrame]]] = {
    "person": (None, build_person),
    "causes_of_death": ("person", build_causes_of_death),
    "prestations": (None, build_prestations),
    "stays_pmsi": ("person", build_stays),
    "procedure_pmsi": ("stays_pmsi", build_procedure),
    "condition_dcir": ("person", build_condition_dcir),
    "condition_pmsi": ("stays_pmsi", build_condition_pmsi),
    "measurement_pmsi": ("stays_pmsi", build_measurement_pmsi),
    "medical_units": ("stays_pmsi", build_medical_units),
    "drug_dcir": ("prestations", build_drug_dcir),
    "drug_pmsi": ("stays_pmsi", build_drug_pmsi),
    "device_dcir": ("prestations", build_device_dcir),
    "device_pmsi": ("stays_pmsi", build_device_pmsi),
    "measurement_dcir": ("prestations", build_measurement_dcir),
}


# builds that join many lines to a stored hub: keys with very many lines are joined apart
LINE_BUILDS = [s for s, (hub, _) in STEPS.items() if hub in ("stays_pmsi", "prestations")]
# those that combine a key's lines before they join them (``operators.joins.join_combined``)
COMBINED_BUILDS = ["procedure_pmsi", "condition_pmsi", "drug_pmsi", "device_pmsi", "measurement_dcir"]
# hospital outputs, with the column that names their stay
HOSPITAL = {"stays_pmsi": "stay_id"} | {s: "visit_id" for s, (hub, _) in STEPS.items() if hub == "stays_pmsi"}


def build_table(step: str, src: Sources, hubs: dict[str, DataFrame], hot_rows: int | None = None) -> DataFrame:
    """Plan of one table (lazy); ``hubs`` holds the hub tables it may need.  With
    ``hot_rows`` one small job first looks for keys with so many lines."""
    hub, fn = STEPS[step]
    more = {"hot_rows": hot_rows} if step in LINE_BUILDS else {}
    return fn(src) if hub is None else fn(src, hubs[hub], **more)


def levels() -> list[list[str]]:
    """Steps grouped by dependency depth: each level only reads hubs of earlier ones."""
    depth: dict[str, int] = {}
    for step, (hub, _) in STEPS.items():
        depth[step] = 0 if hub is None else depth[hub] + 1
    return [[s for s in STEPS if depth[s] == d] for d in range(max(depth.values()) + 1)]


def hub_path(step: str, out_dir: str, years: Iterable[str] | None = None) -> str:
    """Where a hub is laid out by its key; runs for other years have their own."""
    if step == "prestations":
        return f"{out_dir}/_hubs/claims"
    return "-".join([f"{out_dir}/_hubs/stays", *(years or ())])


def stored_hub(table: DataFrame, step: str, out_dir: str, years: Iterable[str] | None = None) -> DataFrame:
    """A written hub as the later builds read it: stays and claim lines laid out by the
    key they are joined on, other tables as they are.  Of ``years`` only, the stays' other
    ``YEAR`` folders are not read."""
    if step == "stays_pmsi":
        if "YEAR" in table.columns:
            table = (table.filter(F.col("YEAR").isin(*years)) if years else table).drop("YEAR")
        return write_hub(table, hub_path(step, out_dir, years), "stay_id")
    if step == "prestations":
        return write_hub(claim_hub(table), hub_path(step, out_dir), "dcir_key")
    return table


def year_of_stay(visit: str) -> Column:
    """The two-digit year in a hospital visit key."""
    return F.split_part(F.col(visit), F.lit("_"), F.lit(2))


def build_all(spark: SparkSession, src: Sources, out_dir: str,
              steps: Iterable[str] | None = None, max_concurrent_builds: int = 1,
              hot_rows: int | None = HOT_ROWS, by_year: bool = False, years: Iterable[str] | None = None,
              seconds: dict[str, float] | None = None) -> DataFrame:
    """Build and write the tables; returns the build summary (table, rows written).

    Builds of one dependency level are independent; with ``max_concurrent_builds``
    above 1 they are submitted as concurrent jobs of the same application, which
    keeps executors busy through each job's last tasks.  Stays and claims with
    ``hot_rows`` lines or more are joined apart (``operators.joins.join_hub``).

    With ``by_year`` the hospital outputs are stored in one ``YEAR`` folder per year (a
    column more).  ``years`` (two digits, implies ``by_year``) builds the hospital tables
    of those years alone and replaces their folders, whatever other years the outputs
    hold; other tables do not depend on the years and are written whole.

    ``seconds`` is filled with the time of each step and of each hub's layout.
    """
    out_dir = out_dir.rstrip("/")
    wanted = set(STEPS) if steps is None else set(steps)
    if unknown := sorted(wanted - set(STEPS)):
        raise ValueError(f"unknown steps: {', '.join(unknown)}; known: {', '.join(STEPS)}")
    if years is not None:
        years = sorted({str(y) for y in years})
        src = src.for_years(years)
    hubs: dict[str, DataFrame] = {}
    counts: dict[str, int] = {}

    def timed(name: str, since: float) -> None:
        if seconds is not None:
            seconds[name] = time.perf_counter() - since

    def run(step: str) -> None:
        since = time.perf_counter()
        df, path = build_table(step, src, hubs, hot_rows), f"{out_dir}/{step}"
        if step in HOSPITAL and (by_year or years is not None):
            df = df.withColumn("YEAR", year_of_stay(HOSPITAL[step]))
            counts[step] = write_table(df, path, ["YEAR"]) if years is None else replace_partitions(df, path, "YEAR", years)
        else:
            counts[step] = write_table(df, path)
        timed(step, since)

    try:
        for level in levels():
            todo = [s for s in level if s in wanted]
            for step in todo:
                hub = STEPS[step][0]
                if hub is not None and hub not in hubs:
                    since = time.perf_counter()
                    hubs[hub] = stored_hub(read_table(spark, f"{out_dir}/{hub}"), hub, out_dir, years)
                    timed(f"{hub} hub", since)
            if max_concurrent_builds > 1 and len(todo) > 1:
                with ThreadPoolExecutor(max_workers=max_concurrent_builds) as pool:
                    for f in [pool.submit(run, s) for s in todo]:
                        f.result()
            else:
                for step in todo:
                    run(step)
    finally:
        for hub in hubs:
            if hub != "person":
                drop_hub(spark, hub_path(hub, out_dir, years if hub == "stays_pmsi" else None))
    rows = [(s, counts[s]) for s in STEPS if s in counts]
    return spark.createDataFrame(rows, "table string, rows long")
