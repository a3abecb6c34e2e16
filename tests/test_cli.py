from __future__ import annotations

import pytest

from helpers import body, records
from lakestream.__main__ import main
from lakestream.plans.lake import Lake, curated_readings
from lakestream.schemas import COMMITTED
from lakestream.sinks.batch import append_to_file_log, write_curated


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    log, root = str(tmp_path_factory.mktemp("log")), str(tmp_path_factory.mktemp("root"))
    rows = [("temperature", body("temperature", 30.0 + i, f"2024-01-0{1 + i}T10:00:00")) for i in range(8)]
    append_to_file_log(records(spark, rows).drop("timestampType"), log)
    main(["lake", "--path", log, "--topic", "t", "--lake", f"{root}/lake", "--once"])
    return log, root


def test_statistics_commands(spark, places, capsys):
    log, root = places
    main(["etl", "--path", log, "--topic", "t", "--out", f"{root}/etl", "--raw", "--once"])
    assert spark.read.parquet(f"{root}/etl/readings").count() == 8
    assert spark.read.parquet(f"{root}/etl/windows").count() == 7
    main(["etl-batch", "--path", log, "--topic", "t", "--out", f"{root}/batch"])
    assert "temperature" in capsys.readouterr().out


def test_lake_commands(places, capsys):
    log, root = places
    lake = ["--lake", f"{root}/lake"]
    main(["gold", *lake])
    main(["query", *lake])
    out = capsys.readouterr().out
    assert "anomaly_pct" in out and "hour_of_day" in out and "PartitionFilters" in out
    main(["explore", *lake])
    assert "sensor_type=temperature" in capsys.readouterr().out
    main(["compact", *lake, "--dry-run"])
    main(["compact", *lake])
    assert "no closed batch" in capsys.readouterr().out


def test_compacting_a_streamed_lake(spark, places, tmp_path, capsys):
    log, lake = str(tmp_path / "log"), ["--lake", str(tmp_path / "lake")]
    for first in (0, 4, 8):
        rows = [("humidity", body("humidity", 30.0 + i)) for i in range(4)]
        append_to_file_log(records(spark, rows, first=first).drop("timestampType"), log)
        main(["lake", "--path", log, "--topic", "t", *lake, "--once", "--no-raw"])
    main(["compact", *lake])
    assert "batches 0 to 1, rows unchanged" in capsys.readouterr().out
    main(["compact", *lake, "--expire"])
    out = capsys.readouterr().out
    assert "no closed batch" in out and "2 folders removed" in out
    main(["gold", *lake])
    assert "|12 " in capsys.readouterr().out.replace("| ", "|").replace(" 12", "12")


def test_compacting_a_part_of_a_written_zone(spark, tmp_path, capsys):
    made = Lake(str(tmp_path / "lake"))
    rows = [body("humidity", 1.0), body("temperature", 2.0)]
    write_curated(curated_readings(records(spark, rows)), made.curated)
    main(["compact", "--lake", made.root, "--where", "sensor_type = 'humidity'"])
    assert "1 rows, unchanged" in capsys.readouterr().out


def test_log_commands(spark, places, tmp_path, capsys):
    log, root = places
    of = ["--path", log, "--topic", "t"]
    main(["alerts", *of, "--rows", "0"])
    assert "ALERT: HIGH TEMPERATURE 37.00 C" in capsys.readouterr().out
    main(["batch-stats", *of, "--chunk", "4", "--save", str(tmp_path / "saved")])
    assert "written to" in capsys.readouterr().out
    assert sorted(r["count"] for r in spark.read.json(str(tmp_path / "saved/chunks")).collect()) == [4, 4]
    main(["lag", *of, "--committed", '{"t": {"0": 3}}'])
    out = capsys.readouterr().out
    assert "behind" in out and "BEHIND" in out
    done = str(tmp_path / "done")
    spark.createDataFrame([("t", 0, 8)], COMMITTED).write.parquet(done)
    main(["lag", *of, "--table", done])
    assert "HEALTHY" in capsys.readouterr().out
    main(["lag", *of, "--checkpoint", str(tmp_path / "none")])
    assert "BEHIND" in capsys.readouterr().out
    main(["audit", *of])
    assert "Gaps" in capsys.readouterr().out
    main(["etl", *of, "--out", f"{root}/etl2", "--once"])
    main(["read-output", "--out", f"{root}/etl2"])
    assert "anomalies" in capsys.readouterr().out


def test_serving_commands(places, capsys):
    log, root = places
    main(["stats", "temperature", "--lake", f"{root}/lake", "--days", "3", "--as-of", "2024-01-08"])
    out = capsys.readouterr().out
    assert "2024-01-05" in out and "2024-01-04" not in out
    main(["latest", "temperature", "-n", "2", "--path", log, "--topic", "t"])
    out = capsys.readouterr().out
    assert "2024-01-08T10:00:00+00:00" in out and "2024-01-06" not in out
    main(["sensors", "--lake", f"{root}/lake"])
    assert "temperature" in capsys.readouterr().out


def test_bad_arguments(places):
    _, root = places
    with pytest.raises(ValueError, match="days"):
        main(["stats", "temperature", "--lake", f"{root}/lake", "--days", "91"])
    with pytest.raises(ValueError, match="radar"):
        main(["stats", "radar", "--lake", f"{root}/lake"])
