"""The command line, from CSV files to stored metrics, in one run per command."""

import datetime as dt
import random

import pytest
from test_streams import drop

from gustline import __main__ as cli
from gustline.sources.tables import read_table


@pytest.fixture
def run(spark, monkeypatch):
    """Run a command in the test session, which it must not stop."""

    class Kept:
        def __getattr__(self, name):
            return getattr(spark, name)

        def stop(self):
            pass

    seen = []

    def session(name, zone, master=None):
        seen.append(zone)
        return Kept()

    monkeypatch.setattr(cli, "build_session", session)

    def call(*args):
        cli.main(["--time-zone", "UTC", *map(str, args)])
        assert seen[-1] == "UTC"

    return call


def test_whole_way(spark, run, tmp_path, capsys):
    chance = random.Random(3)
    start = dt.datetime(2018, 1, 1)
    rows = []
    for i in range(6 * 24 * 25):
        speed = chance.uniform(0, 20)
        time = start + dt.timedelta(minutes=10 * i)
        rows.append((time.strftime("%d %m %Y %H:%M"), 60 * speed + chance.gauss(0, 5), speed, speed * 70, 90))
    drop(tmp_path / "landing", "a.csv", rows)
    at = {name: tmp_path / name for name in ("landing", "topic", "table", "sent", "stored", "hourly", "daily", "out")}

    run("publish", "--landing", at["landing"], "--topic", at["topic"], "--checkpoint", at["sent"])
    run(
        *("ingest", "--topic", at["topic"], "--checkpoint", at["stored"], "--table", at["table"]),
        *("--partition-by", "signal_date", "--timeout", 300),
    )
    assert f"[(0, {len(rows)})]" in capsys.readouterr().out
    run("tap", "--topic", at["topic"], "--rows", 2)
    run("analyse", "--table", at["table"], "--hourly", at["hourly"], "--daily", at["daily"])
    assert read_table(spark, str(at["hourly"])).count() == 24 * 25
    daily = read_table(spark, str(at["daily"])).collect()
    assert {row.distinct_signal_count for row in daily} == {144}
    run("train", "--hourly", at["hourly"], "--day", "2018-01-19", "--out", at["out"])
    metrics = {row.model: row for row in read_table(spark, str(at["out"] / "metrics")).collect()}
    assert metrics["linear"].r2 > 0.9
    assert read_table(spark, str(at["out"] / "day")).count() == 24
    for part in ("histogram", "density", "joint_counts"):
        for model in ("linear", "tree"):
            assert read_table(spark, str(at["out"] / part / model)).count() > 0
    run("show", "--table", at["hourly"], "--rows", 3)
    shown = capsys.readouterr().out
    assert "generation_status" in shown


def test_bad_input_on_the_whole_way(spark, run, tmp_path, capsys):
    chance = random.Random(4)
    rows = []
    for hour in range(24 * 8):
        time = dt.datetime(2018, 1, 1) + dt.timedelta(hours=hour)
        speed = "n/a" if hour == 30 else chance.uniform(0, 20)  # one hour never has a wind speed
        rows.append((time.strftime("%d %m %Y %H:%M"), chance.uniform(0, 900), speed, 7, 90))
    drop(tmp_path / "landing", "a.csv", rows)
    at = {name: tmp_path / name for name in ("landing", "topic", "table", "sent", "stored", "hourly", "daily", "out")}
    run("publish", "--landing", at["landing"], "--topic", at["topic"], "--checkpoint", at["sent"])
    (at["topic"] / "bad.txt").write_text("{broken\n")
    run("ingest", "--topic", at["topic"], "--checkpoint", at["stored"], "--table", at["table"])
    assert f"total {len(rows) + 1}" in capsys.readouterr().out
    run("analyse", "--table", at["table"], "--hourly", at["hourly"], "--daily", at["daily"])
    with pytest.raises(Exception, match="null|NULL|Encountered"):
        run("train", "--hourly", at["hourly"], "--day", "2018-01-02", "--out", at["out"])
    run("train", "--hourly", at["hourly"], "--day", "2018-01-02", "--out", at["out"], "--handle-invalid", "skip")
    assert "left out 2" in capsys.readouterr().out
    assert read_table(spark, str(at["out"] / "day")).count() == 23
    run("analyse", "--table", at["table"], "--hourly", at["hourly"], "--daily", at["daily"], "--only-valid")
    assert read_table(spark, str(at["hourly"])).filter("signal_date is null").count() == 0


def test_copies_quarantine_archive_and_exact_split(spark, run, tmp_path, capsys):
    start, at = dt.datetime(2018, 1, 1), {n: tmp_path / n for n in ("landing", "read", "topic", "table", "copies", "bad", "sent", "stored", "hourly", "daily", "out")}
    rows = [((start + dt.timedelta(hours=h)).strftime("%d %m %Y %H:%M"), h % 700, h % 19, 7, 90 + h % 3) for h in range(24 * 6)]
    drop(tmp_path / "landing", "a.csv", rows)
    run("publish", "--landing", at["landing"], "--topic", at["topic"], "--checkpoint", at["sent"], "--archive", at["read"], "--age", "1 day")
    (at["topic"] / "bad.txt").write_text("{broken\n\n[1]\n")
    run("ingest", "--topic", at["topic"], "--checkpoint", at["stored"], "--table", at["table"], "--copy", at["copies"], "--quarantine", at["bad"])
    assert f"total {len(rows)}" in capsys.readouterr().out
    assert sorted(r.problem for r in read_table(spark, str(at["bad"])).collect()) == ["blank", "not JSON", "not an object"]
    assert read_table(spark, str(at["copies"]), "text").count() == len(rows) + 3
    run("analyse", "--table", at["table"], "--hourly", at["hourly"], "--daily", at["daily"])
    run("train", "--hourly", at["hourly"], "--day", "2018-01-02", "--out", at["out"], "--exact-split")
    assert {r["rows"] for r in read_table(spark, str(at["out"] / "metrics")).collect()} == {29}


def test_time_zone_is_required():
    with pytest.raises(SystemExit):
        cli.main(["show", "--table", "x"])
