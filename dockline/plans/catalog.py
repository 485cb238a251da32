"""One query per operator, over the test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockline import schemas
from dockline.functions import station, text
from dockline.operators import enrich, envelope, filters, geocode, kpi, nearest, parse
from dockline.plans import board, ingest, views
from dockline.session import scratch_dir
from dockline.sources import lookup, poll, snapshot, topic
from dockline.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Point of the single-point search: the centre of the map (fixed value).
CENTRE = (48.8566, 2.3522)


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


# -- inputs -----------------------------------------------------------------


def stations(spark: SparkSession, sf: str) -> DataFrame:
    tables = {t: views.table(spark, sf, t) for t in ("customer", "nation")}
    return views.view(spark, views.STATIONS, **tables)


def derived(spark: SparkSession, sf: str) -> DataFrame:
    return parse.derive(stations(spark, sf), F.lit("2024-01-01 00:00:00").cast("timestamp"))


def reports(spark: SparkSession, sf: str) -> DataFrame:
    return views.view(spark, views.REPORTS, events=views.table(spark, sf, "events"))


def points(spark: SparkSession, sf: str) -> DataFrame:
    return views.view(spark, views.POINTS, supplier=views.table(spark, sf, "supplier"))


def code_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return views.view(spark, views.CODE_LOOKUP, customer=views.table(spark, sf, "customer"))


def all_codes(spark: SparkSession, sf: str) -> DataFrame:
    return views.view(spark, views.ALL_CODES, customer=views.table(spark, sf, "customer"))


def as_delivered(messages: DataFrame) -> DataFrame:
    """The messages with binary values, as a topic delivers them."""
    return messages.withColumn("value", F.col("value").cast("binary"))


def station_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of one page each, as the feed sends them."""
    rows = stations(spark, sf)
    total = views.table(spark, sf, "customer").agg(F.count("*")).scalar()
    return as_delivered(envelope.make_envelopes(rows, envelope.page_of(F.col("stationcode")), total))


def keyed(pages: DataFrame, polled_at: int) -> DataFrame:
    """Pages with the keys that the poll job writes."""
    key = F.concat(F.lit(f"{polled_at}:"), (F.col("page") * envelope.PAGE_SIZE).cast("string"))
    return pages.select(key.alias("key"), "value")


def report_rows(events: DataFrame) -> DataFrame:
    rows = views.view(events.sparkSession, views.REPORTS, events=events)
    return rows.withColumns({
        "numbikesavailable": F.col("ebike") + F.col("mechanical"),
        "duedate": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "arrondissement": F.col("event_type"),
    })


def report_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Stream of status reports, one message each."""
    return as_delivered(envelope.single_envelopes(report_rows(views.table_stream(spark, sf, "events"))))


def event_log(events: DataFrame) -> DataFrame:
    """The events as rows of a topic log, one topic per event type."""
    return topic.log_columns(events.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.concat(F.lit("shop."), "event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ))


# -- scans, sources, sinks --------------------------------------------------

FEED = ("stationcode", "numbikesavailable", "numdocksavailable", "ebike", "is_renting", "lat", "lon")


@query
def q_poll_source(spark, sf):
    saved = scratch_dir(spark, "polled")
    topic.message_text(station_pages(spark, sf)).write.text(saved)
    polled = poll.messages(poll.poll(spark, path=saved))
    return parse.transform(polled).select(*FEED)


@query
def q_poll_errors(spark, sf):
    customers = views.table(spark, sf, "customer")
    total = customers.agg(F.count("*")).scalar()
    limit = envelope.PAGE_SIZE
    folder = scratch_dir(spark, "pages")
    page = envelope.page_of(F.col("stationcode"), limit)
    pages = envelope.make_envelopes(stations(spark, sf), page, total)
    # Pages 3, 10, 17, ... are missing, as if their requests failed.
    (
        pages.where(F.col("page") % 7 != 3)
        .select((F.col("page") * limit).alias("offset"), "value")
        .write.partitionBy("offset").text(folder)
    )
    polled = poll.poll(spark, url=folder + "/offset={offset}", limit=limit, pages_per_task=4)
    return polled.select("page_offset", F.col("_error").isNotNull().alias("failed"))


@query
def q_poll_retry(spark, sf):
    """The first of two polls, of which two pages fail at first and come with the second."""
    out = scratch_dir(spark, "poll-retry")
    total = views.table(spark, sf, "customer").agg(F.count("*")).scalar()
    limit = envelope.PAGE_SIZE
    pages = envelope.make_envelopes(stations(spark, sf), envelope.page_of(F.col("stationcode"), limit), total)
    for part in ("page not in (1, 4)", "page in (1, 4)"):
        offset = (F.col("page") * limit).alias("offset")
        pages.where(part).select(offset, "value").write.mode("append").partitionBy("offset").text(f"{out}/pages")
        polled = poll.poll(spark, stream=True, url=out + "/pages/offset={offset}", limit=limit, pages_per_task=4, state=f"{out}/missing")
        send = functools.partial(topic.write_log, path=f"{out}/topic", topic="stations")
        jobs.drain(ingest.split_polled(polled, send, f"{out}/errors", f"{out}/checkpoint"))
    log = parse.poll_identity(topic.read_log(spark, f"{out}/topic"))
    return parse.transform(log.where(F.col("polled_at") == log.agg(F.min("polled_at")).scalar())).select(*FEED)


@query
def q_make_envelope(spark, sf):
    parsed = parse.parse_json(station_pages(spark, sf), keep=["page"])
    return parsed.select(
        "page", F.col("data.total_count").alias("total_count"),
        F.size("data.results").alias("stations"),
        F.aggregate("data.results", F.lit(0).cast("long"), lambda a, s: a + s.ebike).alias("ebikes"),
    )


@query
def q_topic_write(spark, sf):
    path = scratch_dir(spark, "topic")
    topic.write_log(station_pages(spark, sf), path, "stations")
    return parse.transform(topic.read_log(spark, path, "stations")).select(*FEED)


@query
def q_topic_read(spark, sf):
    out = scratch_dir(spark, "topic-read")
    event_log(views.table(spark, sf, "events")).write.parquet(f"{out}/log")
    rows = topic.message_text(topic.stream_log(spark, f"{out}/log"), "topic", "partition", "offset")
    jobs.drain(
        rows.writeStream.format("parquet").option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
    )
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")


REPORT = ("stationcode", "numbikesavailable", "numdocksavailable", "ebike", "duedate", "is_full", "type_dominant")


@query
def q_stream_to_json(spark, sf):
    out = scratch_dir(spark, "stream-json")
    jobs.drain(ingest.messages_to_json(
        report_messages(spark, sf), f"{out}/rows", f"{out}/checkpoint", by_date=True
    ))
    return snapshot.read_snapshots(spark, f"{out}/rows").select(*REPORT)


@query
def q_lookup_scan(spark, sf):
    """Objects over many lines, two of them broken: all others come back, the broken ones are reported."""
    path = scratch_dir(spark, "lookup")
    objects = lookup.lookup_objects(all_codes(spark, sf), objects=8)
    pretty = F.regexp_replace(F.regexp_replace("value", '","', '",\n  "'), r"^\{|\}$", "")
    objects = objects.select(F.concat(F.lit("{\n  "), pretty, F.lit("\n}")).alias("value"))
    broken = ('{\n  "x1": "lost",\n  "x2": lost\n}', '{\n  "x3": "not closed",')
    faulty = spark.createDataFrame([(b,) for b in broken], "value string")
    objects.unionByName(faulty).coalesce(2).write.text(path)
    reported = lookup.lookup_errors(spark, path, multiline=True).select(
        F.lit("error").alias("stationcode"), F.trim("text").alias("name_custom"))
    return lookup.read_lookup(spark, path, multiline=True).unionByName(reported)


@query
def q_snapshot_scan(spark, sf):
    path = scratch_dir(spark, "snapshot")
    snapshot.write_snapshots(derived(spark, sf), path)
    return snapshot.read_snapshots(spark, path).select(
        *schemas.STATION_FLAT.names, "is_full", "type_dominant", "name_custom"
    )


@query
def q_latest_snapshot(spark, sf):
    rows = snapshot.latest_snapshot(reports(spark, sf), "poll_ts")
    return rows.select("event_id", "stationcode", "ebike", "mechanical", "numdocksavailable")


@query
def q_latest_per_station(spark, sf):
    rows = snapshot.latest_snapshot(reports(spark, sf), "poll_ts", ["event_id"])
    return rows.select("event_id", "stationcode", "ebike", "mechanical", "numdocksavailable")


@query
def q_latest_file(spark, sf):
    """The newest of three files."""
    path = scratch_dir(spark, "files")
    rows = derived(spark, sf)
    for ebikes in (-2, -1, 0):
        snapshot.write_snapshots(rows.withColumn("ebike", F.col("ebike") + ebikes).coalesce(1), path)
    return snapshot.latest_file(snapshot.read_snapshots(spark, path)).select(*FEED)


@query
def q_empty_input(spark, sf):
    """Indicators of nothing: a folder that is missing, one that is empty, and one where a stream has only committed nothing."""
    out = scratch_dir(spark, "no-input")
    topic.write_log(station_pages(spark, sf).where("false"), f"{out}/topic", "stations")
    log = topic.stream_log(spark, f"{out}/topic")
    jobs.drain(ingest.messages_to_json(log, f"{out}/committed", f"{out}/checkpoint"))
    snapshot.write_snapshots(derived(spark, sf).where("capacity < 0"), f"{out}/empty")
    return functools.reduce(DataFrame.unionByName, (
        kpi.kpis(snapshot.read_newest(spark, f"{out}/{name}")) for name in ("missing", "empty", "committed")))


@query
def q_lookup_write(spark, sf):
    path = scratch_dir(spark, "lookup")
    lookup.write_lookup(all_codes(spark, sf), path, objects=16)
    return lookup.read_lookup(spark, path)


@query
def q_lookup_literal(spark, sf):
    # One label per market segment, one segment without.
    labels = {"BUILDING": "Centre", "MACHINERY": "Nord", "FURNITURE": "Sud", "HOUSEHOLD": "Est"}
    literal = lookup.literal_lookup(
        spark, labels, T.StructType([T.StructField("name", T.StringType()), T.StructField("department", T.StringType())])
    )
    customers = views.table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("name"))
    return enrich.enrich_department(customers, literal)


@query
def q_file_to_topic(spark, sf):
    out = scratch_dir(spark, "file-to-topic")
    views.table(spark, sf, "events").select(
        F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props")
    ).write.text(f"{out}/lines")
    jobs.drain(topic.stream_to_log(
        topic.text_lines(spark, f"{out}/lines"), f"{out}/log", f"{out}/checkpoint", "lines"
    ))
    return topic.message_text(topic.read_log(spark, f"{out}/log", "lines"), "topic")


@query
def q_topic_to_file(spark, sf):
    out = scratch_dir(spark, "topic-to-file")
    log = event_log(views.table_stream(spark, sf, "events"))
    jobs.drain(topic.stream_to_text(log, f"{out}/lines", f"{out}/checkpoint"))
    return spark.read.text(f"{out}/lines")


@query
def q_topic_mirror(spark, sf):
    out = scratch_dir(spark, "mirror")
    log = event_log(views.table_stream(spark, sf, "events"))
    copied = topic.mirror(log, "A", "B", r"shop\.(click|view|error)")
    jobs.drain(topic.stream_to_log(copied, f"{out}/log", f"{out}/checkpoint"))
    return topic.message_text(topic.read_log(spark, f"{out}/log"), "topic", "partition", "offset")


@query
def q_topic_offsets(spark, sf):
    return topic.topic_offsets(event_log(views.table(spark, sf, "events")))


@query
def q_topic_gaps(spark, sf):
    """Offsets missing in a log whose older half is gone, and what a reader lost who had read a tenth of it."""
    out = scratch_dir(spark, "topic-gaps")
    events = views.table(spark, sf, "events")
    count = events.agg(F.count("*")).scalar()
    for part, rows in (("old", F.col("event_id") < count / 2), ("new", F.col("event_id") >= count / 2)):
        event_log(events.where(rows)).write.parquet(f"{out}/{part}")
    read_to = topic.topic_offsets(topic.read_log(spark, f"{out}/old").where(F.col("offset") < count / 10))
    return topic.topic_gaps(topic.read_log(spark, f"{out}/new"), read_to, block=500)


@query
def q_snapshot_end_to_end(spark, sf):
    """The newest complete poll, through topic and JSON files.

    The poll of time 2000 spans two micro-batches, of which each also holds
    pages of another poll; it lists one station twice and one page of it comes
    twice. The last poll lacks pages.
    """
    out = scratch_dir(spark, "polls")
    rows = stations(spark, sf)
    rows = rows.unionByName(rows.where("stationcode = '7'"))
    total = views.table(spark, sf, "customer").agg(F.count("*") + 1).scalar()
    page = envelope.page_of(F.col("stationcode"))
    current = envelope.make_envelopes(rows, page, total)
    other = envelope.make_envelopes(rows.withColumn("ebike", F.col("ebike") - 1000), page, total)

    batches = (
        keyed(other, 1000).unionByName(keyed(current.where("page % 2 = 0"), 2000)),
        keyed(current.where("page % 2 = 1 OR page = 0"), 2000).unionByName(keyed(other.where("page % 3 = 0"), 3000)),
    )
    for batch in batches:
        topic.write_log(batch, f"{out}/topic", "stations")
        log = parse.poll_identity(topic.stream_log(spark, f"{out}/topic"))
        jobs.drain(ingest.messages_to_json(log, f"{out}/rows", f"{out}/checkpoint", by_date=True, keep=parse.POLL))
    return snapshot.read_newest(spark, f"{out}/rows").select(*FEED)


# -- projections and scalar expressions -------------------------------------


@query
def q_parse_json(spark, sf):
    props = T.StructType([T.StructField("k", T.IntegerType())])
    events = views.table(spark, sf, "events").withColumnRenamed("props", "value_")
    messages = events.select("event_id", F.col("value_").cast("binary").alias("value"))
    return parse.parse_json(messages, props, keep=["event_id"]).select("event_id", F.col("data.k").alias("k"))


@query
def q_parse_station(spark, sf):
    parsed = parse.parse_json(station_pages(spark, sf))
    return parse.parse_station(parse.explode_results(parsed))


@query
def q_explode_results(spark, sf):
    exploded = parse.explode_results(parse.parse_json(station_pages(spark, sf), keep=["page"]), ["page"])
    return exploded.groupBy("page").agg(F.count("*").alias("stations"))


@query
def q_is_full(spark, sf):
    return stations(spark, sf).select("stationcode", station.is_full().alias("is_full"))


@query
def q_type_dominant(spark, sf):
    return stations(spark, sf).select("stationcode", station.type_dominant().alias("type_dominant"))


@query
def q_fill_area(spark, sf):
    return filters.fill_area(stations(spark, sf)).select("stationcode", "arrondissement")


@query
def q_station_color(spark, sf):
    rows = board.map_rows(stations(spark, sf))
    return rows.select("stationcode", *[F.col("color")[i].alias(c) for i, c in enumerate("rgba")])


@query
def q_station_tooltip(spark, sf):
    return board.map_rows(stations(spark, sf)).select("stationcode", "tooltip")


def found(spark, sf):
    return nearest.nearest_station(points(spark, sf), stations(spark, sf))


@query
def q_directions_url(spark, sf):
    url = text.directions_url(
        F.lit(CENTRE[0]), F.lit(CENTRE[1]), F.col("lat"), F.col("lon")
    )
    return stations(spark, sf).select("stationcode", url.alias("url"))


@query
def q_nearest_label(spark, sf):
    return board.search_result(found(spark, sf)).select("user_id", "message")


@query
def q_kpi_text(spark, sf):
    return kpi.kpi_text(kpi.kpis(stations(spark, sf)))


@query
def q_format_clock(spark, sf):
    return views.table(spark, sf, "events").select("event_id", text.clock_text(F.col("ts")).alias("clock"))


@query
def q_project_existing(spark, sf):
    return filters.project_existing(stations(spark, sf).drop("numbikesavailable"))


@query
def q_distance_m(spark, sf):
    rows = nearest.with_distance(stations(spark, sf), *CENTRE)
    return rows.select("stationcode", F.round("distance_m", 1).alias("distance_m"))


@query
def q_route_geometry(spark, sf):
    route = board.search_result(found(spark, sf)).select("user_id", "route")
    ends = {"from_lon": (0, 0), "from_lat": (0, 1), "to_lon": (1, 0), "to_lat": (1, 1)}
    return route.select("user_id", *[F.col("route")[i][j].alias(c) for c, (i, j) in ends.items()])


@query
def q_labelled_points(spark, sf):
    return board.labelled_points(found(spark, sf), "user_id")


# -- filters and lists ------------------------------------------------------


@query
def q_full_stations(spark, sf):
    return filters.full_stations(derived(spark, sf)).select("stationcode", "name", "is_full")


@query
def q_empty_stations(spark, sf):
    return filters.empty_stations(stations(spark, sf)).select("stationcode", "name", "numbikesavailable")


@query
def q_active_stations(spark, sf):
    return filters.active_stations(stations(spark, sf)).select("stationcode", "is_installed", "is_renting")


@query
def q_map_filter_all(spark, sf):
    return board.map_rows(stations(spark, sf), "all").select("stationcode", "lat", "lon", "tooltip")


@query
def q_map_filter_full(spark, sf):
    return board.map_rows(stations(spark, sf), "full").select("stationcode", "lat", "lon", "tooltip")


@query
def q_map_filter_empty(spark, sf):
    return board.map_rows(stations(spark, sf), "empty").select("stationcode", "lat", "lon", "tooltip")


@query
def q_list_full(spark, sf):
    return filters.list_full(filters.fill_area(derived(spark, sf)))


@query
def q_list_empty(spark, sf):
    return filters.list_empty(filters.fill_area(derived(spark, sf)))


# -- joins ------------------------------------------------------------------


@query
def q_enrich_names(spark, sf):
    rows = enrich.enrich_names(stations(spark, sf), code_lookup(spark, sf))
    return rows.select("stationcode", "name", "name_custom")


@query
def q_lookup_to_rows(spark, sf):
    objects = lookup.lookup_objects(all_codes(spark, sf), objects=16)
    return enrich.lookup_to_rows(objects)


@query
def q_enrich_department(spark, sf):
    departments = views.view(spark, views.DEPARTMENT_LOOKUP, customer=views.table(spark, sf, "customer"))
    rows = enrich.enrich_department(stations(spark, sf), departments)
    return rows.select("stationcode", "name", "department")


@query
def q_geocode_join(spark, sf):
    searches = points(spark, sf).select("user_id", "address")
    gazetteer = views.view(spark, views.GAZETTEER, supplier=views.table(spark, sf, "supplier"))
    return geocode.geocode(searches, gazetteer)


@query
def q_nearest_station(spark, sf):
    rows = found(spark, sf)
    return rows.select("user_id", "stationcode", F.round("distance_m", 1).alias("distance_m"))


@query
def q_nearest_far(spark, sf):
    far = views.view(spark, views.FAR_POINTS, supplier=views.table(spark, sf, "supplier"))
    rows = nearest.nearest_station(far, stations(spark, sf))
    return rows.select("user_id", "stationcode", F.round("distance_m", 1).alias("distance_m"))


@query
def q_nearest_to_point(spark, sf):
    rows = nearest.nearest_to_point(stations(spark, sf), *CENTRE)
    return rows.select("stationcode", "name", F.round("distance_m", 1).alias("distance_m"))


# -- aggregates -------------------------------------------------------------


@query
def q_sum_by_area(spark, sf):
    return kpi.sum_by_area(parse.transform(station_pages(spark, sf)))


@query
def q_kpi_counts(spark, sf):
    return kpi.kpis(stations(spark, sf)).select("nb_stations", "nb_full", "nb_empty")


@query
def q_kpi_rates(spark, sf):
    return kpi.kpis(stations(spark, sf)).select("full_rate", "empty_rate")


@query
def q_kpi_active(spark, sf):
    return kpi.kpis(stations(spark, sf)).select("nb_active", "nb_inactive")


@query
def q_kpi_totals(spark, sf):
    return kpi.kpis(stations(spark, sf)).select(
        "total_ebike", "total_mechanical", "total_docks", "total_bikes"
    )


@query
def q_kpi_percent(spark, sf):
    return kpi.kpis(stations(spark, sf)).select("pct_full", "pct_empty")


@query
def q_bike_split(spark, sf):
    return kpi.bike_split(kpi.kpis(stations(spark, sf)))


@query
def q_stations_table(spark, sf):
    return filters.stations_table(filters.fill_area(stations(spark, sf)))


# -- streams ----------------------------------------------------------------


@query
def q_stream_enrich(spark, sf):
    out = scratch_dir(spark, "stream-enrich")
    jobs.drain(ingest.messages_to_json(
        report_messages(spark, sf), f"{out}/rows", f"{out}/checkpoint", code_lookup(spark, sf)
    ))
    return snapshot.read_snapshots(spark, f"{out}/rows").select("stationcode", "duedate", "name_custom")


@query
def q_stream_restart(spark, sf):
    """The same job twice from one checkpoint, with more input in between."""
    out = scratch_dir(spark, "stream-restart")
    pages = station_pages(spark, sf)
    for part in (0, 1):
        topic.write_log(pages.where(F.col("page") % 2 == part), f"{out}/log", "stations")
        log = topic.stream_log(spark, f"{out}/log", "stations")
        jobs.drain(ingest.messages_to_json(log, f"{out}/rows", f"{out}/checkpoint"))
    return snapshot.read_snapshots(spark, f"{out}/rows").select(*FEED)


@query
def q_stream_kpis(spark, sf):
    out = scratch_dir(spark, "stream-kpis")
    rows = parse.transform(report_messages(spark, sf))
    jobs.drain(jobs.write_kpis(rows, f"{out}/result", f"{out}/checkpoint"))
    by_area = spark.read.parquet(f"{out}/result/area")
    total = kpi.combine(spark.read.parquet(f"{out}/result/kpi").drop("batch_id"))
    measures = ["nb_stations", "nb_full", "nb_empty", "total_ebike", "total_docks"]
    by_area = by_area.groupBy("arrondissement").agg(*[F.sum(c).alias(c) for c in measures])
    return by_area.unionByName(total.select(F.lit("*").alias("arrondissement"), *measures))


@query
def q_stream_poll_kpis(spark, sf):
    """Indicators of whole polls.

    The first poll comes in two batches, and some of its pages twice; the
    third only shows that time has passed; of the fourth, long over, a page
    comes late.
    """
    out = scratch_dir(spark, "stream-poll-kpis")
    rows = stations(spark, sf)
    total = views.table(spark, sf, "customer").agg(F.count("*")).scalar()
    page = envelope.page_of(F.col("stationcode"))
    current = envelope.make_envelopes(rows, page, total)
    other = envelope.make_envelopes(rows.withColumn("ebike", F.col("ebike") + 1000), page, total)
    first, second, third = 1_700_000_000_000, 1_700_000_010_000, 1_700_000_600_000
    batches = (
        keyed(current.where("page % 2 = 0"), first),
        keyed(current.where("page % 2 = 1 OR page % 3 = 0"), first).unionByName(keyed(other, second)),
        keyed(other.where("page = 0"), third).unionByName(keyed(other.where("page = 0"), 1000)),
    )
    for batch in batches:
        topic.write_log(batch, f"{out}/topic", "stations")
        log = topic.stream_log(spark, f"{out}/topic", "stations")
        jobs.drain(jobs.write_poll_areas(log, f"{out}/areas", f"{out}/checkpoint"))
    areas = jobs.read_poll_areas(spark, f"{out}/areas")
    measures = ["nb_stations", "nb_full", "nb_empty", "total_ebike", "total_docks"]
    whole = jobs.poll_indicators(areas).select(
        "polled_at", F.when(F.col("complete"), F.lit("*")).otherwise(F.lit("incomplete")).alias("arrondissement"), *measures)
    return areas.select("polled_at", "arrondissement", *measures).unionByName(whole)
