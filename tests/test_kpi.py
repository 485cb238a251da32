from dockline.operators import filters, kpi


def test_indicators(stations):
    row = kpi.kpis(stations).first()
    assert (row.nb_stations, row.nb_full, row.nb_empty) == (8, 2, 2)
    assert (row.nb_active, row.nb_inactive) == (3, 5)
    assert (row.full_rate, row.empty_rate) == (0.25, 0.25)
    assert (row.pct_full, row.pct_empty) == (25.0, 25.0)
    assert (row.total_ebike, row.total_mechanical, row.total_docks, row.total_bikes) == (10, 11, 20, 19)


def test_empty_frame(stations):
    row = kpi.kpis(stations.limit(0)).first()
    assert set(row.asDict().values()) == {0}
    assert kpi.kpi_text(kpi.kpis(stations.limit(0))).first() == ("0.0%", "0.0%")
    assert [r.share for r in kpi.bike_split(kpi.kpis(stations.limit(0))).collect()] == [0.0, 0.0]


def test_all_null_sums_are_zero(stations):
    row = kpi.kpis(stations.where("stationcode = '8'")).first()
    assert (row.nb_stations, row.total_bikes, row.total_docks) == (1, 0, 0)


def test_area_sums(stations):
    rows = {r.arrondissement: tuple(r)[1:] for r in kpi.sum_by_area(stations).collect()}
    assert rows == {"A": (7, 3, 4), "B": (5, 5, 2), None: (7, 3, 4), "C": (None, None, None)}


def test_grouped_measures_add_up(stations):
    whole = kpi.kpis(stations).first()
    grouped = kpi.indicators(kpi.combine(kpi.counters(stations, "arrondissement"))).first()
    assert whole == grouped


def test_bike_split(stations):
    rows = {r.bike_type: (r.bikes, r.share) for r in kpi.bike_split(kpi.kpis(stations)).collect()}
    assert rows == {"electrique": (10, 10 / 21), "mecanique": (11, 11 / 21)}


def test_filters(stations):
    def codes(df):
        return {r.stationcode for r in df.collect()}

    assert codes(filters.map_filter(stations)) == set("12345678")
    assert codes(filters.map_filter(stations, "full")) == {"1", "2"}
    assert codes(filters.map_filter(stations, "empty")) == {"1", "3"}
    assert codes(filters.active_stations(stations)) == {"1", "2", "7"}
    table = filters.stations_table(filters.fill_area(stations)).collect()
    assert [r.arrondissement for r in table] == ["A", "A", "B", "B", "B", "C", "Inconnu", "Inconnu"]


def test_project_existing(stations):
    assert filters.project_existing(stations.drop("name")).columns == [
        "stationcode", "numbikesavailable", "numdocksavailable", "arrondissement"
    ]
