"""Landed listings: the record types a workspace exports, page by page.

A folder may be partitioned (``dataset_id=.../``, ``projectId=.../``) where the
record itself does not say whose it is; the name then is a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.servicetypes import parse_user_time
from tidemark.operators.nested import flatten_records
from tidemark.sources.datasets import scan_json_pages

# Fields of each listing's records.
LISTINGS = {
    "policies": (
        "dataset_id string, id bigint, type string, name string, "
        "filters array<struct<column: string, values: array<string>, operator: string, not: boolean>>, "
        "users array<bigint>, virtualUsers array<string>, groups array<bigint>"
    ),
    "projects": (
        "id bigint, name string, description string, members array<bigint>, createdBy bigint, "
        "createdDate string, public boolean, dueDate string"
    ),
    "lists": "id bigint, name string, type string, index int, projectId bigint",
    "tasks": (
        "id bigint, projectId bigint, projectListId bigint, taskName string, description string, createdDate string, "
        "dueDate string, priority int, createdBy bigint, ownedBy bigint, contributors array<bigint>, "
        "attachmentCount int, tags array<string>, archived boolean"
    ),
    "activity": (
        "time bigint, userName string, userId bigint, userType string, actionType string, objectName string, "
        "objectId string, objectType string, eventText string"
    ),
    "users": "id bigint, email string, name string, role string, createdAt string, updatedAt string",
    "groups": "id bigint, name string, active boolean, creatorId bigint, memberCount bigint, userIds array<bigint>",
    "datasets": (
        "id string, name string, description string, rows bigint, columns int, createdAt string, updatedAt string, "
        "owner struct<id: bigint, name: string>, pdpEnabled boolean"
    ),
    "pages": "id bigint, name string, parentId bigint, ownerId bigint, locked boolean, children array<struct<id: bigint, name: string>>",
    "accounts": "id string, name string, valid boolean, type struct<id: string, properties: map<string, string>>",
}


def read_listing(
    spark: SparkSession, path: str, kind: str, page_per_line: bool = False, flat: bool = False
) -> DataFrame:
    """All pages of one listing as a table, ``flat`` with records inside spread
    over columns. Users' times are read as UTC."""
    df = scan_json_pages(spark, path, LISTINGS[kind], page_per_line)
    if kind == "users":
        df = df.withColumns({c: parse_user_time(F.col(c)) for c in ("createdAt", "updatedAt")})
    return flatten_records(df) if flat else df
