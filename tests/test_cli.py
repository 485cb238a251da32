import json

import pytest

from dockline import __main__
from dockline.__main__ import main


def test_board_job(spark, tmp_path):
    rows = [
        {"stationcode": str(i), "name": f"s{i}", "numbikesavailable": i, "numdocksavailable": 2 - i,
         "is_full": i == 2, "lat": 48.0 + i, "lon": 2.0, "timestamp": f"2024-01-01T00:00:0{min(i, 1)}Z"}
        for i in range(3)
    ]
    (tmp_path / "rows").mkdir()
    (tmp_path / "rows" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    main(["board", "--rows", str(tmp_path / "rows"), "--out", str(tmp_path / "out"), "--user", "49.9", "2"])
    kpis = spark.read.parquet(str(tmp_path / "out" / "kpis")).first()
    assert (kpis.nb_stations, kpis.nb_full, kpis.total_bikes) == (2, 1, 3)
    assert spark.read.parquet(str(tmp_path / "out" / "nearest")).first().stationcode == "2"


def test_lookup_job(spark, tmp_path):
    (tmp_path / "names.json").write_text('{\n "1": "one"\n}')
    main(["lookup", "--path", str(tmp_path / "names.json"), "--out", str(tmp_path / "out"), "--multiline"])
    assert spark.read.parquet(str(tmp_path / "out")).collect() == [("1", "one")]


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        main(["ingest", "--topic", "t"])


def test_read_options():
    args = __main__.parser().parse_args("ingest --servers a --topic t --out o --checkpoint c --starting-offsets earliest --max-offsets-per-trigger 9".split())
    assert __main__.read_options(args) == {"starting_offsets": "earliest", "min_partitions": None, "max_offsets_per_trigger": 9}
