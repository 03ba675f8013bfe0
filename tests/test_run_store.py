"""A run that is ended half-way is resumed, published last and leaves nothing behind."""

import json
import os

import pytest

from payments import Payments
from tallyweave import run_operations, write_reports
from tallyweave.operators.audit import table_fingerprint
from tallyweave.operators.run_store import Files, RunStore, run_key
from tallyweave.plans import reports
from tallyweave.plans.operations import REPORTS

AS_OF = "2026-02-10"


def feeds_of(spark, *more):
    made = Payments().add("a").add("late", bank=[{"settled_at": "2026-01-20T00:00:00"}])
    for name in more:
        made = made.add(name)
    return made.feeds(spark)


def writer(monkeypatch, stop_after=None):
    """Counts written reports; after some of them, the run is ended."""
    names, write = [], reports.write_csv

    def counted(table, path, mode="errorifexists"):
        if stop_after is not None and len(names) == stop_after:
            raise KeyboardInterrupt
        write(table, path, mode)
        names.append(path.rsplit("/", 1)[-1])

    monkeypatch.setattr(reports, "write_csv", counted)
    return names


def test_an_ended_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    feeds, folder = feeds_of(spark), f"{tmp_path}/run"
    whole = write_reports(run_operations(**feeds, as_of=AS_OF), f"{tmp_path}/whole", sources=feeds)
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        writer(patch, stop_after=5)
        write_reports(run_operations(**feeds, as_of=AS_OF), folder, sources=feeds)
    assert not os.path.exists(f"{folder}/manifest.json")
    with monkeypatch.context() as patch:
        names = writer(patch)
        resumed = write_reports(run_operations(**feeds, as_of=AS_OF), folder, sources=feeds)
    assert [n for n in names if n[:-4] in REPORTS] == [f"{name}.csv" for name in REPORTS[5:]]
    assert resumed == whole
    assert not os.path.exists(f"{folder}/_run") and sorted(os.listdir(folder)) == sorted(os.listdir(f"{tmp_path}/whole"))
    (document,) = spark.read.text(f"{folder}/manifest.json").collect()
    assert json.loads(document.value)["outputs"] == whole["outputs"]
    for name, table in run_operations(**feeds, as_of=AS_OF).tables.items():
        (row,) = table_fingerprint(table, name).collect()
        assert resumed["outputs"][name] == {"rows": row.rows, "content_hash": row.content_hash}


@pytest.mark.parametrize("same_sources", [False, None])
def test_other_or_unknown_inputs_start_afresh(spark, tmp_path, monkeypatch, same_sources):
    feeds, other, folder = feeds_of(spark), feeds_of(spark, "b"), f"{tmp_path}/run"
    sources = None if same_sources is None else feeds
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        writer(patch, stop_after=3)
        write_reports(run_operations(**feeds, as_of=AS_OF), folder, sources=sources)
    with monkeypatch.context() as patch:
        names = writer(patch)
        again = run_operations(**other, as_of=AS_OF)
        found = write_reports(again, folder, sources=None if same_sources is None else other)
    assert set(f"{name}.csv" for name in REPORTS) <= set(names)
    assert found["outputs"]["reconciliation_facts"]["rows"] == 3
    assert not os.path.exists(f"{folder}/_run")


def test_a_published_run_is_not_overwritten_by_accident(spark, tmp_path):
    feeds = feeds_of(spark)
    result = run_operations(**feeds, as_of=AS_OF)
    first = write_reports(result, f"{tmp_path}/run", sources=feeds)
    with pytest.raises(FileExistsError):
        write_reports(result, f"{tmp_path}/run", sources=feeds)
    assert write_reports(result, f"{tmp_path}/run", sources=feeds, overwrite=True) == first


def test_released_runs_leave_no_files(spark, tmp_path):
    result = run_operations(**feeds_of(spark), as_of=AS_OF, folder=str(tmp_path))
    assert os.listdir(tmp_path)
    result.release()
    assert not Files(spark).exists(result.scratch) and not os.listdir(tmp_path)


def test_records_count_for_their_run_only(spark, tmp_path):
    one, two = (RunStore(spark, str(tmp_path), run_key({"as_of": day})) for day in "12")
    assert one.committed() == {}
    one.commit("summary", {"rows": 1, "content_hash": "7"})
    assert one.committed() == {"summary": {"rows": 1, "content_hash": "7"}}
    assert two.committed() == {} and one.committed() == {}
