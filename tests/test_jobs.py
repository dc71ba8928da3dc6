from __future__ import annotations

import datetime as dt
import json

import pytest

from tidemark.plans import jobs
from tidemark.plans.policies import policy_extract
from tidemark.sources import publish
from tidemark.sources.listings import LISTINGS, read_listing


def land(folder, *pages):
    folder.mkdir(parents=True)
    for i, page in enumerate(pages):
        (folder / f"{i}.json").write_text(json.dumps(page))
    return str(folder)


@pytest.mark.parametrize("keys", [[], ["dataset_id", "id"]])
def test_reconcile(spark, rows, tmp_path, keys):
    policy = lambda i, name, users, *values: {
        "id": i, "type": "user", "name": name, "users": users, "virtualUsers": [], "groups": [],
        "filters": [{"column": "c", "values": [v], "operator": "EQUALS", "not": False} for v in values],
    }
    kept = policy(1, "keep", [5], "u") | {"virtualUsers": ["v"], "groups": [3]}
    land(tmp_path / "in/dataset_id=007", [kept, policy(2, "drop", [5], "u")], [policy(3, "All Rows", [1])])
    land(tmp_path / "in/dataset_id=b", [policy(4, "change", [5, 6], "u")])
    publish.publish_replace(read_listing(spark, str(tmp_path / "in"), "policies"), str(tmp_path / "pub"), keys)
    desired = [("007", "keep", "c", 5, "u"), ("007", "new", "c", 8, "w"), ("b", "change", "c", 5, "u"), ("b", "change", "c", 5, "v")]
    names = ["Dataset ID", "Policy Name", "Policy Column", "User ID", "Policy Value"]
    spark.createDataFrame(desired, names).write.parquet(str(tmp_path / "desired"))

    run = lambda **kw: jobs.reconcile_policies(spark, str(tmp_path / "desired"), str(tmp_path / "pub"), **kw)
    want = [("add", "007", "new"), ("delete", "007", "drop"), ("update", "b", "change")]
    for apply in (False, True):
        assert rows(run(apply=apply), "action", "dataset_id", "policy_name") == want
    assert rows(run()) == []
    after = publish.read_published(spark, str(tmp_path / "pub"))
    assert rows(policy_extract(after), "dataset_id", "policy_name", "policy_column", "user_id", "policy_value") == sorted(
        (a, b, c, str(d), e) for a, b, c, d, e in desired
    )
    assert after.where("name = 'All Rows'").count() == 1
    assert rows(after.where("name = 'keep'"), "type", "virtualUsers", "groups") == [("user", ["v"], [3])]
    assert rows(after.where("name = 'new'"), "id", "type", "virtualUsers", "groups") == [(5, "user", [], [])]


def test_project_jobs(spark, rows, tmp_path):
    projects = land(tmp_path / "p", [{"id": 1, "name": "one", "members": [7], "createdBy": 9}], [{"id": 2, "name": "two", "members": []}])
    lists = land(tmp_path / "l/projectId=1", [{"id": 11, "name": "todo", "type": "TODO", "index": 0}])
    tasks = land(tmp_path / "t", [{"id": 5, "projectId": 1, "projectListId": 11, "taskName": "x", "contributors": [7, 8]}])
    out = jobs.all_tasks(spark, projects, str(tmp_path / "l"), tasks)
    assert rows(out, "projectId", "listName", "taskName") == [(1, "todo", "x"), (2, None, None)]
    out = jobs.all_contributors(spark, projects, tasks)
    assert rows(out, "projectId", "projectMember", "taskContributor") == [(1, 7, 7), (1, None, 8), (2, None, None)]


def test_listings(spark, rows, tmp_path):
    users = land(tmp_path / "u", [{"id": 1, "email": "e", "createdAt": "2024-01-05T10:00:00Z", "updatedAt": "2024-01-05T10:00:00.5Z"}])
    ten = dt.datetime(2024, 1, 5, 10)
    assert rows(read_listing(spark, users, "users"), "createdAt", "updatedAt") == [(ten, ten.replace(microsecond=500000))]
    sets = land(tmp_path / "d", [{"id": "a", "name": "n", "owner": {"id": 3, "name": "o"}}])
    flat = read_listing(spark, sets, "datasets", flat=True)
    assert rows(flat, "id", "owner_id", "owner_name") == [("a", 3, "o")]
    for kind in LISTINGS:
        assert read_listing(spark, land(tmp_path / f"k_{kind}", []), kind).count() == 0
