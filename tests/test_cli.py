import json

import pytest

from ratingloom.__main__ import parser, run
from tests.test_jobs import write_csv


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """Runs one job on a trained store; ``requests`` is the text of a request file."""
    folder = tmp_path_factory.mktemp("cli")
    store = str(folder / "store")
    items, ratings = write_csv(folder)
    count = iter(range(100))

    def start(name, *options, requests=None, out=True):
        options = [*options, "--store", store, "--preset", "B"]
        target = str(folder / f"out{next(count)}")
        if requests is not None:
            path = folder / f"requests{next(count)}.csv"
            path.write_text(requests)
            options += ["--requests", str(path)]
        if out:
            options += ["--out", target]
        answer = run(spark, parser().parse_args([name, *options])).collect()
        return answer, target

    start("train", "--items", items, "--ratings", ratings, out=False)
    return start


def test_requests_are_answered_and_bad_ones_written_out(job, spark):
    answers, out = job("predict", requests="user_id,item_id\n1,4\nx,4\n99,4\n")
    assert sorted((r.user_id, r.status) for r in answers) == [(1, "ok"), (99, "unknown_user")]
    refused = [json.loads(r[0]) for r in spark.read.text(f"{out}/rejects").collect()]
    assert refused == [{"request": {"user_id": "x", "item_id": "4"}, "reason": "bad_user_id"}]


def test_lists(job):
    answers, _ = job("recommend", "--n", "3", requests="user_id\n1\n1\n2\n77\n")
    assert sorted((r.user_id, r["rank"]) for r in answers) == [
        (u, k) for u in (1, 2) for k in (1, 2, 3)
    ]
    everyone, _ = job("recommend", "--exclude-seen")
    assert {r.user_id for r in everyone} <= set(range(15))
    with pytest.raises(SystemExit):
        parser().parse_args(["recommend", "--store", "s", "--out", "o", "--n", "0"])


def test_users_and_items(job):
    text = "request_id,user_id\n1,4\n2,\n3,50\n"
    known, _ = job("known-users", requests=text)
    assert {r.request_id: r.known for r in known} == {1: True, 2: False, 3: False}
    made, _ = job("create-users", "--mode", "range", requests=text)
    assert {r.request_id: r.user_id for r in made} == {1: 4, 2: 15, 3: 50}
    found, _ = job("items", requests="item_id\n4\n400\n")
    assert {r.item_id: r.status for r in found} == {4: "ok", 400: "not_found"}
    rated, _ = job("user-ratings", requests="user_id\n1\n")
    assert {r.user_id for r in rated} == {1}
    repeated, out = job("known-users", requests="request_id,user_id\n1,4\n1,5\n2,4\n")
    assert {r.request_id for r in repeated} == {2}
    with pytest.raises(Exception, match="CSV header"):
        job("predict", requests="item_id,user_id\n4,1\n")
    drawn, _ = job("sample", "--n", "4", "--pool", "all")
    assert len(drawn) == 4


def test_ratings_come_in_by_file_and_form(job, tmp_path):
    folder = tmp_path / "files" / "user_id=40"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("1,5\n2,4\nbad\n")
    log, _ = job("upload", "--files", str(folder.parent), "--source", "u1", out=False)
    assert (log[0].version, log[0].n_rejected) == (2, 1)
    refused, _ = job("rejects")
    assert [(r.line, r.reason) for r in refused] == [("bad", "bad_item")]
    fields = [{"name": "t", "value": "Film"}, {"name": "i", "value": "5"},
              {"name": "r", "value": "2"}]
    forms = tmp_path / "forms.json"
    forms.write_text(json.dumps({"request_id": 1, "user_id": None, "fields": fields}))
    answer, _ = job("submit", "--forms", str(forms), "--source", "f1")
    assert [tuple(r) for r in answer] == [(1, 51, True, 1)]
    waiting = tmp_path / "inbox" / "user_id=42"
    waiting.mkdir(parents=True)
    (waiting / "b.csv").write_text("3,5\n")
    log, _ = job("ingest", "--files", str(waiting.parent), "--checkpoint", str(tmp_path / "cp"),
                 out=False)
    assert max(r.batch for r in log) == 4
    refit, _ = job("refit", out=False)
    assert (refit[0].version, refit[0].max_user_id, refit[0].max_iter) == (4, 51, 5)
