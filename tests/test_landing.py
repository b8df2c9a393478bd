import json

import pytest

from haulmetrics.sources import json_pages, landing
from haulmetrics.schema import EVENT_COLUMNS


def page(number, total, size=2, mark=""):
    rows = [{c: f"{c}-{i}{mark}" for c in EVENT_COLUMNS}
            for i in range((number - 1) * size, min(total, number * size))] if number else []
    return {"page": number, "page_size": size, "total_rows": total, "results": rows}


def put(folder, name, *pages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(p) for p in pages))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_three_runs_equal_one(spark, tmp_path):
    inbox, store = tmp_path / "inbox", str(tmp_path / "store")
    put(inbox, "a.json", page(3, 9), page(1, 9), page(1, 9))
    found = landing.land_pages(spark, str(inbox), store)
    assert found == {"read": 3, "repeated": 1, "taken": 2}
    with pytest.raises(ValueError, match="4 of 9 events, 2 of 5 pages"):
        landing.landed_events(spark, store)
    assert rows(landing.missing_pages(landing.ledger(spark, store))) == [(2, 2), (4, 5)]
    put(inbox, "b.json", page(5, 9), page(3, 9))
    assert landing.land_pages(spark, str(inbox), store)["taken"] == 1
    assert landing.land_pages(spark, str(inbox), store) == {"read": 0, "repeated": 0, "taken": 0}
    put(inbox, "c.json", page(2, 9), page(4, 9), page(2, 9))
    landing.land_pages(spark, str(inbox), store, files_per_batch=1)

    once = str(tmp_path / "once")
    landing.land_pages(spark, str(inbox), once)
    assert rows(landing.landed_events(spark, store)) == rows(landing.landed_events(spark, once))
    assert landing.landed_events(spark, store).count() == 9
    state = landing.progress(landing.ledger(spark, store)).first()
    assert tuple(state) == (9, 9, 5, 5, True)
    assert landing.missing_pages(landing.ledger(spark, store)).count() == 0


def test_first_copy_of_a_page_stays(spark, tmp_path):
    inbox, store = tmp_path / "inbox", str(tmp_path / "store")
    put(inbox, "a.json", page(1, 2))
    landing.land_pages(spark, str(inbox), store)
    put(inbox, "b.json", page(1, 2, mark="-changed"))
    assert landing.land_pages(spark, str(inbox), store)["repeated"] == 1
    assert not any("changed" in value for row in landing.landed_events(spark, store).collect()
                   for value in row)


def test_pages_without_number_or_rows(spark, tmp_path):
    inbox, store = tmp_path / "inbox", str(tmp_path / "store")
    put(inbox, "a.json", page(None, 0), page(None, 0), {"page": 1, "page_size": 2, "total_rows": 0})
    landing.land_pages(spark, str(inbox), store)
    assert sorted((str(r.page), r.n_rows) for r in landing.ledger(spark, store).collect()) == [
        ("1", 0), ("None", 0)]
    assert landing.landed_events(spark, store).count() == 0


def test_equals_the_batch_reader(spark, tmp_path):
    events = spark.range(1203).selectExpr(*[f"concat('{c}', id) AS {c}" for c in EVENT_COLUMNS])
    inbox = str(tmp_path / "inbox")
    json_pages.to_pages(events).write.json(inbox)
    landing.land_pages(spark, inbox, str(tmp_path / "store"))
    assert (rows(landing.landed_events(spark, str(tmp_path / "store")))
            == rows(json_pages.extract_events(spark, inbox)))


def test_nothing_landed(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.landed_events(spark, str(tmp_path / "none"))
