"""The physical plans the operators are meant to get."""

import re

import pytest
from pyspark.sql import functions as F

from dockline import session
from dockline.operators import enrich, filters, kpi, nearest
from dockline.operators.parse import transform
from dockline.plans import catalog, views
from dockline.sources import snapshot

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_indicators_in_one_scan(spark):
    text = executed(kpi.kpis(catalog.stations(spark, SF_DIR)))
    assert text.count("customer.parquet") == 1
    assert len(re.findall(r"Exchange SinglePartition", text)) == 1


def test_unused_indicators_and_columns_are_pruned(spark):
    text = executed(catalog.q_kpi_counts(spark, SF_DIR))
    assert "c_acctbal" not in text and "c_mktsegment" not in text
    assert "count_if" not in executed(catalog.q_kpi_totals(spark, SF_DIR))


def test_small_lookup_is_broadcast_and_a_large_one_is_not(spark, conf):
    df = catalog.q_enrich_names(spark, SF_DIR)
    assert "BroadcastHashJoin" in executed(df) and "LeftOuter, BuildRight" in executed(df)
    expected = sorted(map(tuple, df.collect()), key=repr)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = catalog.q_enrich_names(spark, SF_DIR)
    assert "BroadcastHashJoin" not in executed(shuffled)
    assert sorted(map(tuple, shuffled.collect()), key=repr) == expected


def test_hot_station_is_split(spark, conf):
    """A third of the rows on one code: AQE cuts that partition of the left join."""
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }.items():
        conf(key, value)
    rows = spark.range(0, 600_000, 1, 16).selectExpr(
        "if(id % 3 = 0, '7', cast(id as string)) stationcode", "md5(cast(id as string)) payload")
    lookup = spark.range(2000).selectExpr("cast(id as string) stationcode", "'n' name_custom")
    joined = enrich.enrich_names(rows, lookup)
    named = joined.groupBy().agg(F.count("*"), F.count("name_custom"), F.max("payload"))
    total, found, _ = named.collect()[0]
    assert (total, found) == (600_000, 200_000 + sum(1 for i in range(2000) if i % 3 and i != 7) + 1)
    assert "skew=true" in executed(named)


def test_core_stays_in_the_jvm(spark):
    for name in ("sum_by_area", "station_tooltip", "distance_m", "kpi_text", "make_envelope", "stations_table"):
        assert "Python" not in executed(catalog.QUERIES[name](spark, SF_DIR)), name


def test_queries_parse_real_json(spark):
    for name in ("sum_by_area", "parse_station", "explode_results", "make_envelope"):
        df = catalog.QUERIES[name](spark, SF_DIR)
        assert "from_json" in df._jdf.queryExecution().optimizedPlan().toString(), name


def test_parse_declares_only_what_it_selects(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    assert "station_opening_hours" not in executed(transform(messages))


def test_filter_on_stations_goes_below_the_lookup_join(spark):
    rows = enrich.enrich_names(catalog.derived(spark, SF_DIR), catalog.code_lookup(spark, SF_DIR))
    text = filters.map_filter(rows, "empty")._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join LeftOuter, (stationcode")
    assert "Filter" not in text[:join] and "Filter" in text[join:]


def test_newest_snapshot_reaches_the_scan(spark):
    events = views.table(spark, SF_DIR, "events")
    text = plan(snapshot.latest_snapshot(events, "ts"))
    filters_line = [line for line in text.splitlines() if "DataFilters" in line or "PushedFilters" in line]
    assert any("ts" in line for line in filters_line), text


def test_search_walks_a_tree_without_all_pairs(spark):
    stations, points = catalog.stations(spark, SF_DIR), catalog.points(spark, SF_DIR)
    text = executed(nearest.nearest_station(points, stations, leaf_size=4))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["is_full", "parse_json", "format_clock"])
def test_row_wise_queries_do_not_shuffle(spark, name):
    text = executed(catalog.QUERIES[name](spark, SF_DIR))
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text


def test_scratch_of_other_applications_stays(spark):
    own = session.scratch_dir(spark, "own")
    other = own.replace(spark.sparkContext.applicationId, "app-of-another-job")
    for path in (own, other):
        spark.range(3).write.parquet(path)
    session.drop_scratch(spark)
    assert spark.read.parquet(other).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(own)
