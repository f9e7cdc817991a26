import json

import pytest
from helpers import rows
from test_feeds import CRASH, PERSON

from incident_mart.__main__ import main


def land(folder, page, records):
    path = folder / f"page_no={page}"
    path.mkdir(parents=True)
    (path / "a.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(folder)


def test_refresh_then_models_then_stream(spark, tmp_path):
    crashes = land(tmp_path / "crashes", 0, [CRASH])
    persons = land(tmp_path / "persons", 0, [PERSON, {**PERSON, "person_id": "O0", "age": "16"}])
    root = str(tmp_path / "mart")
    feeds = ["--root", root, "--pages", f"crashes={crashes}", "--pages", f"persons={persons}"]
    assert main(["refresh", *feeds, "--load-id", "one"], spark) == {"crashes": 1, "persons": 2}
    fact = f"{root}/models/fact_traffic_accidents"
    assert spark.read.parquet(fact).count() == 1

    land(tmp_path / "persons", 1, [{**PERSON, "person_id": "O9", "person_type": "BICYCLE"}])
    main(["stream", *feeds, "--checkpoint", str(tmp_path / "check")], spark)
    assert spark.read.parquet(fact).count() == 1
    main(["models", "--root", root, "--select", "fact_traffic_accidents"], spark)
    assert rows(spark.read.parquet(fact), "person_type") == [("BICYCLE",), ("DRIVER",)]


def test_a_refresh_in_buckets_keeps_the_fact(spark, tmp_path):
    root = str(tmp_path / "mart")
    crashes = land(tmp_path / "crashes", 0, [CRASH])
    persons = land(tmp_path / "persons", 0, [PERSON, {**PERSON, "person_id": "O9", "person_type": "BICYCLE"}])
    feeds = ["--root", root, "--pages", f"crashes={crashes}", "--pages", f"persons={persons}"]
    main(["refresh", *feeds, "--load-id", "one", "--buckets", "2", "--database", "job_buckets"], spark)
    fact = rows(spark.read.parquet(f"{root}/models/fact_traffic_accidents"))
    assert len(fact) == 2 and spark.table("job_buckets.persons_by_crash").count() == 2
    assert spark.table("job_buckets.fact_traffic_accidents").count() == 2
    main(["models", "--root", root], spark)
    assert rows(spark.read.parquet(f"{root}/models/fact_traffic_accidents")) == fact
    with pytest.raises(SystemExit):
        main(["models", "--root", root, "--buckets", "2"], spark)


def test_unknown_feed_is_refused(spark, capsys):
    with pytest.raises(SystemExit):
        main(["refresh", "--root", "x", "--pages", "boats=y", "--load-id", "one"], spark)
    assert "FEED" in capsys.readouterr().err
