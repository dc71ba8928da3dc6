"""Whole runs: read the inputs, plan, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.policies import desired_from_dataset, policy_apply, policy_plan
from tidemark.plans.projects import project_contributors, project_task_rollup
from tidemark.session import scratch_dir
from tidemark.sources.listings import read_listing
from tidemark.sources.publish import publish_replace, read_published, read_state


def reconcile_policies(
    spark: SparkSession, desired_path: str, policies_path: str, apply: bool = True
) -> DataFrame:
    """Bring published policies in line with a desired-policy dataset.

    The dataset (parquet) has the columns ``Dataset ID``, ``Policy Name``,
    ``Policy Column``, ``User ID`` and ``Policy Value``. Gives the plan; with
    ``apply`` the policies are published anew with the plan carried out, and
    readers see either all of its changes or none. A writer that publishes in
    between makes the run fail rather than be overwritten.
    """
    state = read_state(spark, policies_path)
    records = read_published(spark, policies_path, state)
    desired = desired_from_dataset(spark.read.parquet(desired_path))
    written = scratch_dir(spark, "plan")
    policy_plan(records, desired).write.parquet(written)
    plan = spark.read.parquet(written)
    if apply and not plan.isEmpty():
        applied = policy_apply(records, plan)
        publish_replace(applied, policies_path, state.keys, state.buckets, expected_revision=state.revision)
    return plan


def all_tasks(spark: SparkSession, projects: str, lists: str, tasks: str) -> DataFrame:
    """Every project with its lists and tasks, from landed listings."""
    return project_task_rollup(
        read_listing(spark, projects, "projects"), read_listing(spark, lists, "lists"), read_listing(spark, tasks, "tasks")
    )


def all_contributors(spark: SparkSession, projects: str, tasks: str) -> DataFrame:
    """Every project's members and task contributors, from landed listings."""
    return project_contributors(read_listing(spark, projects, "projects"), read_listing(spark, tasks, "tasks"))
