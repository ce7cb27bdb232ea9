"""Time the catalogue's headline queries; prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the cores, BENCH_QUERIES ("all" or a
comma list) the queries. Results go to the no-op sink, so every column of every
row is computed. The star is published first and timed as ``publish_star``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from casebook.plans import catalog, star  # noqa: E402
from casebook.session import build_session  # noqa: E402

HEADLINE = """
rename_project cast_with_guard drop_zero_dates quarantine_rows dedupe_keep_first impute_partial_counts
impute_by_bucket impute_capped_sample cap_iqr detect_iqr_inlier_bounds lump_rare repair_hierarchy
flag_pair_mismatch profile_numeric crosstab normalize_text clean_summary flag_text_year classify_motive
label_batch city_centroids geo_consistency fuzzy_gazetteer fuzzy_city impute_coords_cascade cluster_names
fuzzy_dedupe reconcile_incidents reconcile_locations dim_time dim_location fact_load_star star_flat
resolve_location_fallback dim_late_arriving fk_violations incremental_load top_countries pct_total_countries
region_attack_intensity top_cities_known region_year_trend kpi_header target_distribution dual_trend
geo_distribution heatmap_pct_casualties group_impact_region set_in_out kills_by_year weapon_share kpi_unpivot
most_used_member drill_location_rollup region_attack_cube cascading_filters
""".split()


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    functions = catalog.queries()
    picked = os.environ.get("BENCH_QUERIES", "")
    names = list(functions) if picked == "all" else picked.split(",") if picked else HEADLINE
    seconds = {}
    start = time.time()
    star.star(spark, sf_dir)
    seconds["publish_star"] = round(time.time() - start, 3)
    for name in names:
        start = time.time()
        run(functions[name](spark, sf_dir))
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
