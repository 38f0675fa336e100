"""The command line, end to end, on feed files."""

import os

import pytest

from kerbside.__main__ import main
from kerbside.functions.convert import to_text
from kerbside.operators.quality import MissingData
from kerbside.plans import warehouse as wh
from kerbside.plans.questions import QUESTIONS
from kerbside.schemas import FEEDS
from kerbside.sources import feeds
from kerbside.sources.files import write_csv

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    """A warehouse built from feed files by the commands; a few pings only, as each day becomes a folder."""
    from kerbside.session import working_folder
    folder = working_folder(spark, "commands")
    for name in FEEDS:
        df = feeds.READERS[name](spark, sf_dir).drop("event_date")
        if name == "driver_location_events":
            df = df.filter("event_timestamp < '1998-03-01'")
        write_csv(to_text(df), f"{folder}/input/{name}.csv")
    paths = ["--input-dir", f"{folder}/input"], ["--warehouse-dir", f"{folder}/warehouse"]
    main(["layers", *paths[0], *paths[1]])
    main(["keyed", *paths[1]])
    return folder


def test_questions_over_the_warehouse(spark, built, capsys):
    assert sorted(wh.register_warehouse(spark, f"{built}/warehouse")) == sorted(
        ["rides", "driver_locations", "payments", "cancellations", *wh.GOLD_VIEWS])
    for name in ("top_revenue_city", "top_methods", "available_city"):
        main(["sql", "--warehouse-dir", f"{built}/warehouse", name])
        assert spark.sql(QUESTIONS[name]).count() >= 1
    main(["sql", "--warehouse-dir", f"{built}/warehouse", "SELECT count(*) AS n_rides FROM rides"])
    assert "n_rides" in capsys.readouterr().out


def test_layers_agree(spark, built):
    rides = spark.read.parquet(f"{built}/warehouse/silver/ride_events")
    metrics = spark.read.parquet(f"{built}/warehouse/gold/daily_ride_metrics")
    assert rides.select("ride_id").distinct().count() == rides.count()
    assert metrics.agg({"total_rides": "sum"}).first()[0] == rides.count()


def test_keyed_tables(spark, built):
    rides = wh.keyed_table(spark, f"{built}/warehouse", "ride_events")
    assert [r["operation"] for r in rides.history().collect()] == ["MERGE", "WRITE"]
    assert rides.read().filter("ride_status = 'in_progress'").count() == 0
    pings = wh.keyed_table(spark, f"{built}/warehouse", "driver_location_events")
    assert pings.read().count() < pings.read(0).count()


def test_one_layer_at_a_time(spark, built):
    counts = wh.run_layers(spark, f"{built}/input", f"{built}/warehouse", "gold").collect()
    assert {r["layer"] for r in counts} == {"gold"} and len(counts) == 5
    with pytest.raises(ValueError):
        wh.run_layers(spark, f"{built}/input", f"{built}/warehouse", "copper")


def test_topics(spark, built, capsys):
    main(["send", "--input-dir", f"{built}/input", "--topic-dir", f"{built}/topics", "--limit", "40"])
    main(["tail", "--topic-dir", f"{built}/topics", "--limit", "2"])
    out = capsys.readouterr().out
    assert all(name in out for name in FEEDS) and "40" in out
    main(["stream", "--topic-dir", f"{built}/topics", "--topics", "ride_events", "--warehouse-dir", f"{built}/stream",
          "--once", "--delay", "10 minutes"])
    assert spark.read.parquet(f"{built}/stream/streaming/ride_windows").count() > 0


def test_missing_inputs_are_named(spark, built):
    with pytest.raises(MissingData, match="ride_events: missing"):
        main(["layers", "--input-dir", f"{built}/nowhere", "--warehouse-dir", f"{built}/none"])


def test_entry_without_the_training_data_operators():
    """The other queries are served where the folder, or a module that its operators need, is missing."""
    import subprocess
    import sys
    for missing in ("kerbside.llm", "corpus_pipeline", "ahocorasick", "tiktoken"):
        code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(f"No module named {{name}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
names = set(entry.queries())
assert "silver_rides" in names and not [n for n in names if n.startswith("op") or n == "pipeline"], names
"""
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT)
        assert done.returncode == 0, done.stderr
    code = code.replace("tiktoken", "kerbside.plans.oracle")
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, cwd=ROOT).returncode != 0
