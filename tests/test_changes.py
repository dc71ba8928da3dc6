from __future__ import annotations

import random

import pytest

from tidemark.operators import changes
from tidemark.plans import projects


def fold(base, batch):
    """Changes applied one after the other."""
    state = {k: list(v) for k, *v in base}
    for key, _, op, *fields in sorted(batch, key=lambda c: c[1]):
        if op == "delete":
            state.pop(key, None)
        elif op == "create":
            state[key] = list(fields)
        elif key in state:
            state[key] = [old if new is None else new for old, new in zip(state[key], fields)]
    return sorted(((k, *v) for k, v in state.items()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_apply_changes_in_sequence(spark, rows, seed):
    rng = random.Random(seed)
    base = [(k, f"b{k}", k) for k in range(12)]
    batch = [
        (rng.randint(0, 18), seq, rng.choice(["update", "update", "update", "create", "delete"]),
         rng.choice([None, f"n{seq}"]), rng.choice([None, 100 + seq]))
        for seq in range(60)
    ]
    got = changes.apply_changes(
        spark.createDataFrame(base, "k int, name string, v int"),
        spark.createDataFrame(batch, "k int, seq int, op string, name string, v int"), "k",
    )
    assert rows(got, "k", "name", "v") == fold(base, batch)


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, None), (1, None, "c"), (None, 1, "d"), (None, 2, "e")], "k int, o int, v string")
    assert rows(changes.latest_per_key(df, ["k"], ["o"])) == [(1, 3, None), (None, 2, "e")]
    plan = changes.latest_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_memberships(spark, rows):
    members = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "group_id int, user_id int")
    more = spark.createDataFrame([(1, 11), (1, 12), (1, 12), (3, 10)], "group_id int, user_id int")
    assert rows(changes.add_members(members, more)) == [(1, 10), (1, 11), (1, 12), (2, 10), (3, 10)]
    assert rows(changes.remove_members(members, more)) == [(1, 10), (2, 10)]
    groups = spark.createDataFrame([(1, "a"), (2, "b")], "group_id int, name string")
    left, left_members = changes.delete_groups(groups, members, groups.where("group_id = 1").select("group_id"))
    assert (rows(left), rows(left_members)) == ([(2, "b")], [(2, 10)])


def test_create_groups(spark, rows):
    members = spark.createDataFrame([(1, 10)], "group_id int, user_id int")
    groups = spark.createDataFrame([(1, "a", True)], "group_id int, name string, active boolean")
    new = spark.createDataFrame([(2, "b", True, [10, 11]), (3, "c", False, [-1]), (4, "d", True, [])], "group_id int, name string, active boolean, users array<int>")
    all_groups, all_members = changes.create_groups(groups, members, new)
    assert [r[0] for r in rows(all_groups)] == [1, 2, 3, 4]
    assert rows(all_members) == [(1, 10), (2, 10), (2, 11)]


def test_group_members(spark, rows):
    groups = spark.createDataFrame([(1, [10, 11]), (2, [])], "group_id int, users array<int>")
    assert rows(changes.group_members(groups)) == rows(changes.group_members(groups, 1)) == [(1, 10), (1, 11)]


PROJECT = "id int, name string, description string, members array<int>, createdBy int, createdDate string, public boolean, dueDate string"
LIST = "id int, name string, type string, index int, projectId int"
TASK = ("id int, projectId int, projectListId int, taskName string, description string, createdDate string, dueDate string, "
        "priority int, createdBy int, ownedBy int, contributors array<int>, attachmentCount int, tags array<string>, archived boolean")


@pytest.fixture
def board(spark):
    project = lambda i, members: (i, f"p{i}", None, members, 90 + i, None, True, None)
    task = lambda i, p, l, who: (i, p, l, f"t{i}", None, None, None, 1, 1, 50, who, 0, [], i == 2)
    return (
        spark.createDataFrame([project(1, [7, 8]), project(2, []), project(3, None)], PROJECT),
        spark.createDataFrame([(11, "l", "x", 0, 1), (12, "m", "x", 1, 1), (21, "n", "x", 0, 2)], LIST),
        spark.createDataFrame([task(1, 1, 11, [7, 9]), task(2, 1, 11, []), task(3, 2, 99, None), task(4, 8, 81, [7])], TASK),
    )


def test_project_task_rollup(board, rows):
    out = projects.project_task_rollup(*board)
    assert rows(out, "projectId", "listId", "taskId") == sorted(
        [(1, 11, 1), (1, 11, 2), (1, 12, None), (2, 21, None), (3, None, None)], key=repr
    )
    assert {"projectName", "listType", "taskArchived", "taskContributors", "projectMembers"} <= set(out.columns)


def test_project_contributors(board, rows):
    out = projects.project_contributors(board[0], board[2])
    assert out.columns == projects.CONTRIBUTOR_COLUMNS
    assert rows(out, "projectId", "projectOwnedBy", "projectMember", "taskId", "taskContributor") == sorted(
        [(1, 91, 7, 1, 7), (1, 91, None, 1, 9), (1, 91, 8, None, None), (2, 92, None, None, None),
         (3, 93, None, None, None), (8, None, None, 4, 7)], key=repr
    )
