"""Project roll-ups: tasks by list and project, and who contributes where."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.nested import explode_inner, explode_outer
from tidemark.operators.relational import join_full, join_left, rename_columns

# Listing field names and their names in a roll-up.
PROJECT_NAMES = {
    "id": "projectId", "name": "projectName", "description": "projectDescription",
    "members": "projectMembers", "createdBy": "projectCreatedBy", "createdDate": "projectCreatedDate",
    "public": "projectPublic", "dueDate": "projectDueDate",
}
LIST_NAMES = {"id": "listId", "name": "listName", "type": "listType", "index": "listIndex"}
TASK_NAMES = {
    "id": "taskId", "projectListId": "listId", "description": "taskDescription",
    "createdDate": "taskCreatedDate", "dueDate": "taskDueDate", "priority": "taskPriority",
    "createdBy": "taskCreatedBy", "ownedBy": "taskOwnedBy", "contributors": "taskContributors",
    "attachmentCount": "taskAttachmentCount", "tags": "taskTags", "archived": "taskArchived",
}
CONTRIBUTOR_COLUMNS = [
    "projectId", "projectName", "projectOwnedBy", "projectMember",
    "listId", "taskId", "taskName", "taskOwnedBy", "taskContributor",
]


def project_task_rollup(projects: DataFrame, lists: DataFrame, tasks: DataFrame) -> DataFrame:
    """Projects with their lists and the lists' tasks.

    Projects without lists and lists without tasks stay; a task on no list of
    its project does not show. One project or list may hold most of the rows.
    """
    named = join_left(
        rename_columns(projects, PROJECT_NAMES), rename_columns(lists, LIST_NAMES), ["projectId"], many=True
    )
    return join_left(named, rename_columns(tasks, TASK_NAMES), ["projectId", "listId"], many=True)


def project_contributors(projects: DataFrame, tasks: DataFrame) -> DataFrame:
    """Members of projects next to contributors of the projects' tasks.

    One row per member and task contributed to; members without a task and
    contributors who are no members have the other side empty.
    """
    owned = projects.select(
        F.col("id").alias("projectId"), F.col("createdBy").alias("projectOwnedBy"),
        F.col("name").alias("projectName"), "members",
    )
    members = explode_outer(owned, "members", "user").withColumn("projectMember", F.col("user"))
    work = tasks.select(
        "projectId", F.col("projectListId").alias("listId"), F.col("id").alias("taskId"),
        "taskName", F.col("ownedBy").alias("taskOwnedBy"), "contributors",
    )
    contributors = explode_inner(work, "contributors", "user").withColumn("taskContributor", F.col("user"))
    contributors = join_left(contributors, owned.drop("members").distinct(), ["projectId"])
    shared = ["projectId", "projectOwnedBy", "projectName", "user"]
    return join_full(contributors, members, shared).select(*CONTRIBUTOR_COLUMNS)
