"""The queries of the catalog as DuckDB SQL over the raw test tables."""

from __future__ import annotations

from dockline.plans import views

# Fixed values, written out here so that a wrong one in the library is noticed.
EQUATOR_M, FLATTENING = 6378137.0, 1 / 298.257223563
CENTRE = (48.8566, 2.3522)
PAGE_SIZE = 100
RED, BLUE, ORANGE, GREEN = (255, 0, 0, 160), (0, 100, 255, 160), (255, 140, 0, 160), (0, 255, 127, 160)
USER_LABEL, NEAREST_LABEL = "Vous êtes ici", "Station la plus proche"

WITH = "with " + ",\n".join(
    f"{name} as ({views.duckdb(sql)})"
    for name, sql in (
        ("st0", views.STATIONS), ("reports", views.REPORTS), ("us", views.POINTS), ("far", views.FAR_POINTS),
        ("code_lookup", views.CODE_LOOKUP), ("dept_lookup", views.DEPARTMENT_LOOKUP),
        ("gazetteer", views.GAZETTEER),
    )
) + """,
st as (select *, numdocksavailable = 0 is_full, numbikesavailable = 0 is_empty,
         coalesce(is_installed = 'OUI' and is_renting = 'OUI', false) is_active,
         case when ebike > mechanical then 'electrique' when ebike < mechanical then 'mecanique'
              else 'egal' end type_dominant,
         coalesce(arrondissement, 'Inconnu') area from st0)
"""


def distance(lat1: str, lon1: str, lat2: str, lon2: str, source: str, keep: str) -> str:
    """Andoyer-Lambert distance over the rows of `source`, keeping some columns."""
    f = repr(FLATTENING)
    return f"""(
      select *, case when h = 0 then 0e0 else {EQUATOR_M!r}e0 * (sigma - {f}e0 / 2 * (
          (sigma - 2 * sqrt(h * (1 - h))) * pow(sin(p) * cos(q), 2) / (1 - h)
        + (sigma + 2 * sqrt(h * (1 - h))) * pow(cos(p) * sin(q), 2) / h)) end distance_m
      from (select *, 2 * asin(sqrt(h)) sigma from (
        select *, pow(sin(q), 2) + cos(u1) * cos(u2) * pow(sin(dlon / 2), 2) h from (
          select *, (u1 + u2) / 2 p, (u2 - u1) / 2 q from (
            select {keep}, radians({lon2}) - radians({lon1}) dlon,
              atan((1 - {f}e0) * tan(radians({lat1}))) u1,
              atan((1 - {f}e0) * tan(radians({lat2}))) u2
            from {source})))))"""


def nearest(points: str) -> str:
    return WITH + f""", pairs as (select * from {distance(
        "ulat", "ulon", "lat", "lon", f"{points}, st",
        "user_id, ulat, ulon, lat, lon, stationcode, st.name")}),
    found as (select * from (select *, row_number() over (
        partition by user_id order by distance_m, stationcode) rn from pairs) where rn = 1)
    """


NEAREST = nearest("us")

FEED = "select stationcode, numbikesavailable, numdocksavailable, ebike, is_renting, lat, lon from st"

TOOLTIP = """concat('<b>', name, '</b><br/>Vélos dispo : ', numbikesavailable,
  '<br/>Bornes libres : ', numdocksavailable, '<br/>Arrondissement : ', area) tooltip"""

MAP = f"select stationcode, lat, lon, {TOOLTIP} from st"

KPI = """(select count(*) nb_stations, count(*) filter (is_full) nb_full,
  count(*) filter (is_empty) nb_empty, count(*) filter (is_active) nb_active,
  coalesce(sum(ebike), 0)::bigint total_ebike, coalesce(sum(mechanical), 0)::bigint total_mechanical,
  coalesce(sum(numdocksavailable), 0)::bigint total_docks,
  coalesce(sum(numbikesavailable), 0)::bigint total_bikes from {source})"""

RATES = """case when nb_stations > 0 then nb_full / nb_stations::double else 0e0 end full_rate,
  case when nb_stations > 0 then nb_empty / nb_stations::double else 0e0 end empty_rate"""

PERCENT = """case when nb_stations > 0 then 100e0 * (nb_full / nb_stations::double) else 0e0 end pct_full,
  case when nb_stations > 0 then 100e0 * (nb_empty / nb_stations::double) else 0e0 end pct_empty"""

TOTALS = "total_ebike, total_mechanical, total_docks, total_bikes"


def kpi(columns: str, source: str = "st") -> str:
    return WITH + f"select {columns} from {KPI.format(source=source)}"


def _color() -> str:
    rules = (
        ("numdocksavailable = 0", RED), ("numbikesavailable = 0", BLUE),
        ("numdocksavailable <= 3", ORANGE), ("true", GREEN),
    )
    channels = (
        "case " + " ".join(f"when {rule} then {rgba[i]}" for rule, rgba in rules) + f" end::int {c}"
        for i, c in enumerate("rgba")
    )
    return WITH + f"select stationcode, {', '.join(channels)} from st"


REPORT = """(select *, (ebike + mechanical)::int numbikesavailable,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') duedate from reports)"""

LITERAL = {"BUILDING": "Centre", "MACHINERY": "Nord", "FURNITURE": "Sud", "HOUSEHOLD": "Est"}

_AREA = """count(*) nb_stations, count(*) filter (numdocksavailable = 0) nb_full,
  count(*) filter (ebike + mechanical = 0) nb_empty, sum(ebike)::bigint total_ebike,
  sum(numdocksavailable)::bigint total_docks"""

ALL_CODES = "select cast(c_custkey as varchar) stationcode, upper(c_name) name_custom from customer"

ORACLE: dict[str, str] = {
    "poll_source": WITH + FEED,
    "snapshot_end_to_end": WITH + FEED,
    "poll_errors": """select page * 100 page_offset, page % 7 = 3 failed from (
        select distinct c_custkey // 100 page from customer)""",
    "poll_retry": WITH + FEED,
    "make_envelope": WITH + f"""select page, (select count(*) from st)::bigint total_count,
        count(*)::int stations, sum(ebike)::bigint ebikes
        from (select *, stationcode::bigint // {PAGE_SIZE} page from st) group by page""",
    "topic_write": WITH + FEED,
    "topic_read": """select concat('shop.', event_type) topic, (user_id % 4)::int "partition",
        event_id "offset", props "value" from events""",
    "stream_to_json": WITH + f"""select stationcode, numbikesavailable, numdocksavailable, ebike, duedate,
        numdocksavailable = 0 is_full, case when ebike > mechanical then 'electrique'
        when ebike < mechanical then 'mecanique' else 'egal' end type_dominant from {REPORT}""",
    "lookup_scan": ALL_CODES + """ union all select 'error', '"x2": lost' union all select 'error', ''""",
    "latest_file": WITH + FEED,
    "snapshot_scan": WITH + """select stationcode, name, numbikesavailable, numdocksavailable, capacity,
        mechanical, ebike, is_installed, is_renting, is_returning, duedate, lat, lon, arrondissement,
        code_insee_commune, is_full, type_dominant, null::varchar name_custom from st""",
    "latest_snapshot": WITH + """select event_id, stationcode, ebike, mechanical, numdocksavailable
        from reports where poll_ts = (select max(poll_ts) from reports)""",
    "latest_per_station": WITH + """select event_id, stationcode, ebike, mechanical, numdocksavailable
        from (select *, row_number() over (partition by stationcode order by event_id desc) rn
              from reports where poll_ts = (select max(poll_ts) from reports)) where rn = 1""",
    "empty_input": kpi(
        f"nb_stations, nb_full, nb_empty, nb_active, {TOTALS}, nb_stations - nb_active nb_inactive, "
        f"{RATES}, {PERCENT}", "(select * from st where capacity < 0)") + ", range(3)",
    "lookup_write": ALL_CODES,
    "lookup_literal": "select c_custkey, c_mktsegment as name, case c_mktsegment "
        + " ".join(f"when '{k}' then '{v}'" for k, v in LITERAL.items())
        + " else 'Unknown' end department from customer",
    "file_to_topic": """select 'lines' topic, concat_ws('|', event_id, event_type, props) "value"
        from events""",
    "topic_to_file": 'select props "value" from events',
    "topic_mirror": """select concat('A.shop.', event_type) topic, (user_id % 4)::int "partition",
        event_id "offset", props "value" from events where event_type in ('click', 'view', 'error')""",
    "topic_offsets": """select concat('shop.', event_type) topic, (user_id % 4)::int "partition",
        min(event_id) first_offset, max(event_id) + 1 next_offset from events group by 1, 2""",
    "topic_gaps": """with log as (select concat('shop.', event_type) topic, (user_id % 4)::int "partition",
          event_id "offset", event_id >= (select count(*) from events) / 2e0 kept,
          event_id < (select count(*) from events) / 10e0 was_read from events),
        steps as (select topic, "partition", "offset", lead("offset") over (
            partition by topic, "partition" order by "offset") following from log where kept
          union all select topic, "partition", max("offset") filter (was_read), min("offset") filter (kept)
          from log group by 1, 2)
        select topic, "partition", "offset" + 1 from_offset, following - 1 to_offset from steps
        where following > "offset" + 1""",
    "parse_json": "select event_id, cast(json_extract(props, '$.k') as integer) k from events",
    "parse_station": WITH + """select stationcode, name, numbikesavailable, numdocksavailable, capacity,
        mechanical, ebike, is_installed, is_renting, is_returning, duedate, lat, lon, arrondissement,
        code_insee_commune from st""",
    "explode_results": f"""select c_custkey // {PAGE_SIZE} page, count(*) stations
        from customer group by 1""",
    "is_full": WITH + "select stationcode, is_full from st",
    "type_dominant": WITH + "select stationcode, type_dominant from st",
    "fill_area": WITH + "select stationcode, area arrondissement from st",
    "station_color": _color(),
    "station_tooltip": WITH + f"select stationcode, {TOOLTIP} from st",
    "directions_url": WITH + f"""select stationcode, concat('https://www.google.com/maps/dir/',
        '{CENTRE[0]},{CENTRE[1]}/', lat, ',', lon) url from st""",
    "nearest_label": NEAREST + """select user_id, concat('Station la plus proche : ', name, ' à ',
        trunc(distance_m)::bigint, ' m') message from found""",
    "kpi_text": WITH + f"""select format('{{:.1f}}%', pct_full) full_text,
        format('{{:.1f}}%', pct_empty) empty_text
        from (select {PERCENT} from {KPI.format(source="st")})""",
    "format_clock": "select event_id, strftime(ts, '%d/%m/%Y %H:%M:%S') clock from events",
    "project_existing": WITH + "select stationcode, name, numdocksavailable, arrondissement from st",
    "distance_m": WITH + f"""select stationcode, round(distance_m, 1) distance_m from {distance(
        f"{CENTRE[0]}e0", f"{CENTRE[1]}e0", "lat", "lon", "st", "stationcode")}""",
    "route_geometry": NEAREST + """select user_id, ulon from_lon, ulat from_lat, lon to_lon, lat to_lat
        from found""",
    "labelled_points": NEAREST + f"""select user_id, ulat lat, ulon lon, '{USER_LABEL}' as label
        from found union all select user_id, lat, lon, '{NEAREST_LABEL}' from found""",
    "full_stations": WITH + "select stationcode, name, is_full from st where is_full",
    "empty_stations": WITH + "select stationcode, name, numbikesavailable from st where is_empty",
    "active_stations": WITH + "select stationcode, is_installed, is_renting from st where is_active",
    "map_filter_all": WITH + MAP,
    "map_filter_full": WITH + MAP + " where is_full",
    "map_filter_empty": WITH + MAP + " where is_empty",
    "list_full": WITH + """select stationcode, name, numbikesavailable, area arrondissement
        from st where is_full""",
    "list_empty": WITH + """select stationcode, name, numdocksavailable, area arrondissement
        from st where is_empty""",
    "enrich_names": WITH + """select stationcode, name, name_custom from st
        left join code_lookup using (stationcode)""",
    "lookup_to_rows": ALL_CODES,
    "enrich_department": WITH + """select stationcode, name, coalesce(department, 'Unknown') department
        from st left join dept_lookup using (name)""",
    "geocode_join": WITH + """select user_id, us.address, lat ulat, lon ulon from us
        join gazetteer g on lower(trim(us.address)) = lower(trim(g.address))""",
    "nearest_station": NEAREST + """select user_id, stationcode, round(distance_m, 1) distance_m
        from found""",
    "nearest_far": nearest("far") + "select user_id, stationcode, round(distance_m, 1) distance_m from found",
    "nearest_to_point": WITH + f"""select stationcode, name, round(distance_m, 1) distance_m
        from {distance(f"{CENTRE[0]}e0", f"{CENTRE[1]}e0", "lat", "lon", "st", "stationcode, name")} d
        order by d.distance_m, stationcode limit 1""",
    "sum_by_area": WITH + """select arrondissement, sum(numbikesavailable)::bigint sum_bikes,
        sum(mechanical)::bigint sum_mechanical, sum(ebike)::bigint sum_ebike from st group by 1""",
    "kpi_counts": kpi("nb_stations, nb_full, nb_empty"),
    "kpi_rates": kpi(RATES),
    "kpi_active": kpi("nb_active, nb_stations - nb_active nb_inactive"),
    "kpi_totals": kpi(TOTALS),
    "kpi_percent": kpi(PERCENT),
    "bike_split": WITH + """select bike_type, bikes, case when sum(bikes) over () > 0
        then bikes / sum(bikes) over ()::double else 0e0 end share from (
        select 'electrique' bike_type, coalesce(sum(ebike), 0)::bigint bikes from st union all
        select 'mecanique', coalesce(sum(mechanical), 0)::bigint from st)""",
    "stations_table": WITH + """select stationcode, name, numbikesavailable, numdocksavailable,
        area arrondissement from st order by area, stationcode""",
    "stream_enrich": WITH + f"""select stationcode, duedate, name_custom from {REPORT}
        left join code_lookup using (stationcode)""",
    "stream_restart": WITH + FEED,
    "stream_poll_kpis": WITH + " union all ".join(
        f"""select {1_700_000_000_000 + 10_000 * n}::bigint polled_at, {area} arrondissement,
        count(*) nb_stations, count(*) filter (is_full) nb_full, count(*) filter (is_empty) nb_empty,
        sum(ebike + {1000 * n})::bigint total_ebike, sum(numdocksavailable)::bigint total_docks from st {group}"""
        for n in (0, 1) for area, group in (("arrondissement", "group by arrondissement"), ("'*'", ""))),
    "stream_kpis": WITH + f"""select event_type arrondissement, {_AREA} from reports group by 1
        union all select '*', {_AREA} from reports""",
}
