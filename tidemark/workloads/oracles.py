"""The same queries as plain SQL over the given tables.

Written apart from the operators: policies are compared here by writing out
every user and value pair, memberships by set operations, and so on.
"""

from __future__ import annotations

POLICY_NAME = """CASE WHEN o_totalprice > 480000 THEN concat('AA - Restricted ', o_orderkey)
            WHEN o_totalprice < 20000 THEN 'All Rows' ELSE concat('order ', o_orderkey) END"""

STORED = f"""stored AS (
  SELECT DISTINCT o_orderpriority AS dataset_id, o_orderkey AS policy_id, {POLICY_NAME} AS policy_name,
         'order_year' AS policy_column, CAST(l_suppkey AS VARCHAR) AS user_id,
         CAST(year(o_orderdate) + step AS VARCHAR) AS policy_value
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN (VALUES (0), (1)) AS s(step) ON step = 0 OR c_acctbal >= 0
  WHERE o_orderstatus <> 'O'),
cur AS (SELECT * FROM stored WHERE policy_name <> 'All Rows' AND policy_name NOT LIKE '%AA - Restricted%')"""

DESIRED = """desired AS (
  SELECT o_orderpriority AS dataset_id, concat('order ', o_orderkey) AS policy_name,
         'order_year' AS policy_column, CAST(l_suppkey AS VARCHAR) AS user_id,
         CAST(year(o_orderdate) + step AS VARCHAR) AS policy_value
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey,
       (VALUES (0), (1)) AS s(step)
  WHERE o_orderstatus <> 'P' AND s_acctbal >= 0)"""

WIDE = """wide AS (
  SELECT dataset_id, policy_name, policy_column, string_agg(DISTINCT user_id, '|' ORDER BY user_id) AS user_id,
         string_agg(DISTINCT policy_value, '|' ORDER BY policy_value) AS policy_value
  FROM desired GROUP BY ALL)"""

COR = """ids AS (SELECT DISTINCT dataset_id, policy_id, policy_name FROM cur),
cor AS (SELECT d.*, i.policy_id FROM desired d LEFT JOIN ids i ON d.dataset_id = i.dataset_id AND d.policy_name = i.policy_name)"""

CHANGES = """ck AS (SELECT DISTINCT dataset_id, policy_id, policy_name, policy_column FROM cur),
dk AS (SELECT DISTINCT dataset_id, policy_name, policy_column FROM desired),
adds AS (SELECT * FROM dk WHERE NOT EXISTS (SELECT 1 FROM ck WHERE ck.dataset_id = dk.dataset_id
         AND ck.policy_name = dk.policy_name AND ck.policy_column = dk.policy_column)),
dels AS (SELECT * FROM ck WHERE NOT EXISTS (SELECT 1 FROM dk WHERE ck.dataset_id = dk.dataset_id
         AND ck.policy_name = dk.policy_name AND ck.policy_column = dk.policy_column)),
live AS (SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM dels WHERE dels.dataset_id = cur.dataset_id
         AND dels.policy_id = cur.policy_id)),
fj AS (SELECT coalesce(l.dataset_id, c.dataset_id) AS dataset_id, coalesce(l.policy_id, c.policy_id) AS policy_id,
              coalesce(l.policy_name, c.policy_name) AS policy_name,
              coalesce(l.policy_column, c.policy_column) AS policy_column, l.user_id AS lu, c.user_id AS cu
       FROM live l FULL JOIN cor c ON l.dataset_id = c.dataset_id AND l.policy_id = c.policy_id
            AND l.policy_name = c.policy_name AND l.policy_column = c.policy_column
            AND l.user_id = c.user_id AND l.policy_value = c.policy_value),
upds AS (SELECT DISTINCT dataset_id, policy_id, policy_name, policy_column FROM fj
         WHERE policy_id IS NOT NULL AND (lu IS NULL OR cu IS NULL)),
plan AS (SELECT 'add' AS action, dataset_id, CAST(NULL AS BIGINT) AS policy_id, policy_name, policy_column FROM adds
   UNION ALL SELECT 'delete', dataset_id, policy_id, policy_name, policy_column FROM dels
   UNION ALL SELECT 'update', dataset_id, policy_id, policy_name, policy_column FROM upds)"""


def _definition(policy_id: str) -> str:
    return f"""concat('{{', {policy_id}, '"type":"user","name":"', policy_name, '","filters":[',
      array_to_string(list_transform(string_split(policy_value, '|'), lambda v:
        concat('{{"column":"', policy_column, '","values":["', v, '"],"operator":"EQUALS","not":false}}')), ','),
      '],"users":[', replace(user_id, '|', ','), '],"virtualUsers":[],"groups":[]}}')"""


RECORDS = f"""records AS (
  SELECT o_orderpriority AS dataset_id, o_orderkey AS id, {POLICY_NAME} AS name,
         CASE WHEN o_orderstatus = 'P' THEN CAST([] AS BIGINT[])
              ELSE [o_custkey, CAST(month(o_orderdate) AS BIGINT)] END AS users,
         o_orderstatus, o_orderdate, o_orderpriority
  FROM orders)"""

PROJECT = """members AS (
  SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
lists AS (
  SELECT DISTINCT o_custkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS "listId", o_orderpriority AS "listName",
         'TODO' AS "listType", CAST(substr(o_orderpriority, 1, 1) AS INT) AS "listIndex", o_custkey AS "projectId"
  FROM orders),
tasks AS (
  SELECT *, o_custkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS "listId", concat('task', o_orderkey) AS "taskName"
  FROM orders),
work AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)"""

TEXT_TYPE = """CASE WHEN count(TRY_CAST({c} AS {t})) = count(*) AND count(*) > 0 THEN '{kind}' ELSE 'STRING' END"""

TABLES = [
    ("benchmark", 2), ("conversations", 4), ("customer", 5), ("documents", 5), ("embeddings", 3), ("events", 6),
    ("labels", 3), ("lineitem", 11), ("nation", 3), ("orders", 6), ("pages", 3), ("part", 6), ("region", 2), ("supplier", 4),
]

ORACLES: dict[str, str] = {
    "scan_dataset_csv": "SELECT * FROM orders",
    "scan_json_pages": "SELECT * FROM conversations",
    "dataset_schema": """
        SELECT CAST(position AS INT) AS position, name, type, (SELECT count(*) FROM orders) AS rows
        FROM (VALUES (1, 'o_orderkey', 'LONG'), (2, 'o_custkey', 'LONG'), (3, 'o_orderstatus', 'STRING'),
              (4, 'o_totalprice', 'DOUBLE'), (5, 'o_orderdate', 'DATETIME'), (6, 'o_orderpriority', 'STRING'))
             AS t(position, name, type)""",
    "dataset_listing": " UNION ALL ".join(
        f"SELECT '{t}' AS name, CAST({n} AS INT) AS columns, count(*) AS rows FROM {t}" for t, n in TABLES
    ),
    "write_csv_parts": "SELECT * FROM orders",
    "publish_replace": "SELECT * FROM orders",
    "publish_upsert": """
        SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer
        UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'NEW' FROM supplier""",
    "publish_update": "SELECT *, p_size > 25 AS p_large FROM part",
    "stream_upsert": """
        SELECT event_id, ts, user_id, event_type, value, props
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "dataset_sql": "SELECT event_type, count(*) AS n, max(value) AS top FROM events WHERE value > 1 GROUP BY event_type",
    "infer_types": " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS position, '{n}' AS name, {kind} AS type FROM orders"
        for i, (n, kind) in enumerate(
            [
                ("o_orderkey", "min('STRING')"), ("o_custkey", "min('STRING')"), ("o_orderstatus", "min('STRING')"),
                ("o_totalprice", "min('STRING')"),
                ("o_orderdate", TEXT_TYPE.format(c="CAST(o_orderdate AS VARCHAR)", t="TIMESTAMP", kind="DATETIME")),
                ("o_orderpriority", TEXT_TYPE.format(c="o_orderpriority", t="TIMESTAMP", kind="DATETIME")),
                ("o_day", TEXT_TYPE.format(c="CAST(CAST(o_orderdate AS DATE) AS VARCHAR)", t="DATE", kind="DATE")),
                ("o_size", "min('LONG')"),
            ],
            start=1,
        )
    ),
    "schema_diff": f"""
        SELECT change, name, old_type, new_type FROM (VALUES
          ('removed', 'o_orderpriority', 'STRING', NULL), ('added', 'o_day', NULL, 'DATE'),
          ('retyped', 'o_totalprice', 'DOUBLE', 'STRING'),
          ('moved', 'o_orderkey', 'LONG', 'LONG'), ('moved', 'o_custkey', 'LONG', 'LONG'),
          ('moved', 'o_orderdate', 'DATETIME', 'DATETIME')) AS t(change, name, old_type, new_type)
        WHERE name <> 'o_orderdate'""",
    "cast_typed": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
               CASE WHEN o_orderstatus = 'P' THEN CAST(trunc(o_totalprice) AS BIGINT) ELSE o_custkey END AS whole,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS time, o_orderstatus AS status
        FROM orders""",
    "friendly_names": """
        SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS part_name_3, p_type AS part_name_2,
               p_size AS x1size, p_retailprice AS price____ FROM part""",
    "select_named": f"""
        SELECT o_orderpriority AS "Dataset ID", concat('order ', o_orderkey) AS "Policy Name", 'order_year' AS "Policy Column",
        CAST(l_suppkey AS VARCHAR) AS "User ID",
        CASE WHEN s_acctbal >= 0 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE 'none' END AS "Policy Value"
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey""",
    "rename_columns": f"WITH {PROJECT} SELECT * FROM lists",
    "filter_present": "SELECT DISTINCT event_type AS kind FROM events WHERE event_type NOT IN ('error', 'view')",
    "filter_excluded": f"""
        WITH {RECORDS} SELECT dataset_id, id, name FROM records
        WHERE name <> 'All Rows' AND name NOT LIKE '%AA - Restricted%'""",
    "activity_window": """
        SELECT ts AS time, concat('user', user_id) AS "userName", user_id AS "userId", 'USER' AS "userType",
               event_type AS "actionType", concat('object', event_id) AS "objectName", event_id AS "objectId",
               'DATASET' AS "objectType", props AS "eventText"
        FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-10 00:00:00'""",
    "lookup_by_key": "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'",
    "mark_constant": "SELECT *, CAST(1 AS INT) AS cur FROM customer",
    "join_left_natural": """
        WITH o AS (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority FROM orders),
        f AS (SELECT priority, count(*) AS finished FROM o WHERE o_orderstatus = 'F' AND priority IS DISTINCT FROM '2-HIGH' GROUP BY 1)
        SELECT o_orderkey, o.priority, finished FROM o LEFT JOIN f ON o.priority IS NOT DISTINCT FROM f.priority""",
    "join_full_nullsafe": """
        WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS custkey FROM orders),
        c AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS custkey, count(*) AS customers FROM customer GROUP BY 1)
        SELECT coalesce(o.custkey, c.custkey) AS custkey, o_orderkey, customers
        FROM o FULL JOIN c ON o.custkey IS NOT DISTINCT FROM c.custkey""",
    "join_anti": f"""
        WITH {STORED}, {DESIRED} SELECT * FROM desired d WHERE NOT EXISTS (
          SELECT 1 FROM stored s WHERE s.dataset_id = d.dataset_id AND s.policy_name = d.policy_name)""",
    "join_cross": """
        SELECT o_orderkey, u AS user, v AS value
        FROM (SELECT o_orderkey, unnest([o_custkey, CAST(month(o_orderdate) AS BIGINT)]) AS u, o_orderstatus, o_orderpriority FROM orders),
             LATERAL (SELECT unnest([o_orderstatus, o_orderpriority]) AS v)""",
    "agg_ordered_distinct_concat": "WITH l AS (SELECT *, ROW(l_linenumber, l_partkey, l_suppkey) AS place FROM lineitem), "
    + ", ".join(
        f"""{name} AS (SELECT l_orderkey, string_agg(v, '|' ORDER BY place, v) AS {name}
            FROM (SELECT l_orderkey, {v} AS v, min(place) AS place FROM l GROUP BY 1, 2) GROUP BY 1)"""
        for name, v in (
            ("l_suppkey", "CAST(l_suppkey AS VARCHAR)"), ("l_returnflag", "replace(l_returnflag, 'N', 'NA')"), ("l_linestatus", "l_linestatus")
        )
    )
    + " SELECT * FROM l_suppkey JOIN l_returnflag USING (l_orderkey) JOIN l_linestatus USING (l_orderkey)",
    "agg_group_counts": """
        SELECT count(*) AS groups, max(n) AS greatest, CAST(sum(n - 1) AS BIGINT) AS repeats
        FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type)""",
    "window_row_number": """
        SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
               count(*) OVER (PARTITION BY user_id) AS n FROM events""",
    "sort_rows": """
        SELECT event_id, user_id, CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN NULL ELSE event_type END AS kind
        FROM events ORDER BY kind NULLS LAST, event_id""",
    "page_rows": "SELECT * FROM orders ORDER BY o_orderpriority, o_orderkey LIMIT 500 OFFSET 1000",
    "stack_rows": """
        SELECT c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, CAST(NULL AS INT) AS nation FROM customer
        UNION ALL SELECT s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
    "distinct_rows": "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
    "widen_records": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "flatten_records": "SELECT event_id, user_id AS act_by_id, event_type AS act_by_kind, value AS act_value FROM events",
    "explode_inner": f"WITH {RECORDS} SELECT id, unnest(users) AS user FROM records",
    "explode_outer": f"""
        WITH {RECORDS} SELECT id, unnest(users) AS user FROM records
        UNION ALL SELECT id, NULL FROM records WHERE len(users) = 0""",
    "explode_default": f"""
        WITH {RECORDS} SELECT id, CAST(unnest(users) AS VARCHAR) AS user FROM records
        UNION ALL SELECT id, '' FROM records WHERE len(users) = 0""",
    "split_pipe": """
        SELECT o_orderkey, CAST(place AS INT) AS place, piece FROM (
          SELECT o_orderkey, 0 AS place, o_orderstatus AS piece FROM orders
          UNION ALL SELECT o_orderkey, 1, o_orderpriority FROM orders
          UNION ALL SELECT o_orderkey, 2, '' FROM orders
          UNION ALL SELECT o_orderkey, 3, CAST(o_custkey AS VARCHAR) FROM orders)""",
    "build_json": """
        SELECT concat('{"o_orderkey":', o_orderkey, ',"o_orderstatus":"', o_orderstatus, '"',
               CASE WHEN o_orderstatus <> 'P' THEN concat(',"o_custkey":', o_custkey) ELSE '' END,
               ',"tags":["', o_orderpriority, '"]}') AS json FROM orders""",
    "parse_user_times": """SELECT event_id, date_trunc('second', ts) AS "createdAt", ts AS "updatedAt" FROM events""",
    "scalar_text": """
        SELECT p_partkey, lower(p_type) AS lower,
               concat(CASE WHEN p_size > 10 THEN p_brand ELSE 'NA' END, '_', p_size) AS joined,
               regexp_matches(p_name, 'ring|bolt') AS found, CAST(p_size AS VARCHAR) AS size_text,
               CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand_number, CAST(NULL AS BIGINT) AS no_number
        FROM part""",
    "scalar_null_math": """
        SELECT p_partkey, CASE WHEN p_size > 30 THEN 'large' WHEN p_size > 10 THEN 'small' END AS class,
               p_size <= 10 AS missing,
               CASE WHEN p_size * 1000 > 20000 THEN CAST(floor(p_partkey * 20000.0 / (p_size * 1000)) AS BIGINT) ELSE p_partkey END AS rows
        FROM part""",
    "policy_extract": f"""
        WITH {RECORDS},
        r AS (SELECT * FROM records WHERE name <> 'All Rows' AND name NOT LIKE '%AA - Restricted%'),
        u AS (SELECT id, CAST(unnest(users) AS VARCHAR) AS user_id FROM r UNION ALL SELECT id, '' FROM r WHERE len(users) = 0),
        f AS (SELECT id, '' AS policy_column, '' AS policy_value FROM r WHERE o_orderstatus = 'O'
              UNION ALL SELECT id, 'year', CAST(year(o_orderdate) AS VARCHAR) FROM r WHERE o_orderstatus <> 'O'
              UNION ALL SELECT id, 'year', CAST(year(o_orderdate) + 1 AS VARCHAR) FROM r WHERE o_orderstatus <> 'O'
              UNION ALL SELECT id, 'priority', o_orderpriority FROM r WHERE o_orderstatus <> 'O')
        SELECT dataset_id, r.id AS policy_id, name AS policy_name, policy_column, user_id, policy_value
        FROM r JOIN u ON r.id = u.id JOIN f ON r.id = f.id""",
    "policy_wide_current": f"""
        WITH {STORED} SELECT dataset_id, policy_id, policy_name, policy_column,
          string_agg(DISTINCT user_id, '|' ORDER BY user_id) AS user_id,
          string_agg(DISTINCT policy_value, '|' ORDER BY policy_value) AS policy_value
        FROM cur GROUP BY ALL""",
    "policy_desired_long": f"WITH {STORED}, {DESIRED}, {COR} SELECT *, CAST(1 AS INT) AS cor FROM cor",
    "policy_wide_desired": f"WITH {DESIRED}, {WIDE} SELECT * FROM wide",
    "policy_adds": f"WITH {STORED}, {DESIRED}, {COR}, {CHANGES} SELECT * FROM adds",
    "policy_deletes": f"WITH {STORED}, {DESIRED}, {COR}, {CHANGES} SELECT * FROM dels",
    "policy_updates": f"""
        WITH {STORED}, {DESIRED}, {COR}, {CHANGES}, {WIDE}
        SELECT u.*, w.user_id, w.policy_value FROM upds u LEFT JOIN wide w ON u.dataset_id = w.dataset_id
        AND u.policy_name = w.policy_name AND u.policy_column = w.policy_column""",
    "policy_definitions": f"""
        WITH {DESIRED}, {WIDE} SELECT dataset_id, policy_name, policy_column, {_definition("''")} AS definition FROM wide""",
    "policy_plan": f"""
        WITH {STORED}, {DESIRED}, {COR}, {CHANGES}, {WIDE},
        full_plan AS (SELECT p.*, w.user_id, w.policy_value FROM plan p LEFT JOIN wide w ON p.dataset_id = w.dataset_id
          AND p.policy_name = w.policy_name AND p.policy_column = w.policy_column)
        SELECT action, dataset_id, policy_id, policy_name, policy_column, user_id, policy_value,
          CASE WHEN action <> 'delete' THEN {_definition("CASE WHEN action = 'update' THEN concat('\"id\":', policy_id, ',') ELSE '' END")} END AS definition
        FROM full_plan""",
    "policy_apply": f"""
        WITH {STORED}, {DESIRED}, {COR}, {CHANGES},
        top AS (SELECT max(policy_id) AS id FROM stored),
        numbered AS (SELECT dataset_id, policy_name, policy_column,
          (SELECT id FROM top) + row_number() OVER (ORDER BY dataset_id, policy_name, policy_column) AS policy_id FROM adds),
        after AS (SELECT d.dataset_id, coalesce(c.policy_id, n.policy_id) AS policy_id, d.policy_name, d.policy_column, d.user_id, d.policy_value
          FROM (SELECT DISTINCT * FROM desired) d
          LEFT JOIN ids c ON c.dataset_id = d.dataset_id AND c.policy_name = d.policy_name
          LEFT JOIN numbered n ON n.dataset_id = d.dataset_id AND n.policy_name = d.policy_name AND n.policy_column = d.policy_column)
        SELECT * FROM after""",
    "policy_enforce": """
        SELECT o.* FROM orders o JOIN customer ON o_custkey = c_custkey
        WHERE c_nationkey = 3 AND (c_mktsegment = 'BUILDING' OR o_orderstatus = 'F')""",
    "project_task_rollup": f"""
        WITH {PROJECT},
        m AS (SELECT o_custkey, CAST(count(*) AS INT) AS members FROM members GROUP BY 1),
        k AS (SELECT l_orderkey, CAST(count(*) AS INT) AS contributors FROM work GROUP BY 1)
        SELECT c_custkey AS "projectId", c_name AS "projectName", c_mktsegment AS "projectDescription",
               c_nationkey AS "projectCreatedBy", c_acctbal >= 0 AS "projectPublic", l."listId", l."listName", l."listIndex",
               o_orderkey AS "taskId", "taskName", o_orderdate AS "taskCreatedDate",
               CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS "taskDueDate",
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS "taskPriority", o_orderstatus AS "taskOwnedBy",
               o_orderstatus = 'F' AS "taskArchived", members, contributors
        FROM customer LEFT JOIN m ON c_custkey = m.o_custkey LEFT JOIN lists l ON c_custkey = l."projectId"
        LEFT JOIN tasks t ON l."projectId" = t.o_custkey AND l."listId" = t."listId" LEFT JOIN k ON t.o_orderkey = l_orderkey""",
    "project_contributors": f"""
        WITH {PROJECT},
        p AS (SELECT c_custkey, c_name, c_nationkey, l_suppkey AS member FROM customer LEFT JOIN members ON c_custkey = o_custkey),
        t AS (SELECT tasks.*, c_custkey, c_name, c_nationkey, l_suppkey AS contributor
              FROM tasks JOIN work ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey)
        SELECT coalesce(p.c_custkey, t.c_custkey) AS "projectId", coalesce(p.c_name, t.c_name) AS "projectName",
               coalesce(p.c_nationkey, t.c_nationkey) AS "projectOwnedBy", p.member AS "projectMember", t."listId",
               t.o_orderkey AS "taskId", t."taskName", t.o_orderstatus AS "taskOwnedBy", t.contributor AS "taskContributor"
        FROM p FULL JOIN t ON p.c_custkey = t.c_custkey AND p.member = t.contributor""",
    "membership_add": """
        SELECT CAST(c_nationkey AS BIGINT) AS group_id, c_custkey AS user_id FROM customer
        UNION SELECT CAST(s_nationkey AS BIGINT), s_suppkey FROM supplier""",
    "membership_remove": "SELECT CAST(c_nationkey AS BIGINT) AS group_id, c_custkey AS user_id FROM customer WHERE NOT c_acctbal < 0",
    "group_delete_cascade": """
        WITH doomed AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
        SELECT CAST(n_nationkey AS BIGINT) AS group_id, n_name AS name, CAST(NULL AS BIGINT) AS user_id FROM nation
        WHERE n_nationkey NOT IN (SELECT * FROM doomed)
        UNION ALL SELECT c_nationkey, NULL, c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT * FROM doomed)""",
    "group_members": f"""
        WITH {PROJECT} SELECT o_orderkey AS group_id, l_suppkey AS user_id FROM tasks JOIN work ON o_orderkey = l_orderkey""",
    "apply_changes": """
        WITH ch AS (
          SELECT o_custkey AS k, o_orderkey AS seq,
            CASE WHEN o_orderstatus = 'O' AND o_totalprice < 50000 THEN 'delete'
                 WHEN o_orderstatus = 'O' AND o_totalprice > 400000 THEN 'create' ELSE 'update' END AS op,
            CAST(NULL AS VARCHAR) AS name, CAST(NULL AS INT) AS nation,
            CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS bal, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS seg
          FROM orders
          UNION ALL SELECT -1 - s_suppkey, s_suppkey, CASE WHEN s_acctbal < 0 THEN 'update' ELSE 'create' END,
            s_name, s_nationkey, s_acctbal, NULL FROM supplier),
        marks AS (SELECT k, max(seq) AS at, arg_max(op, seq) AS op FROM ch WHERE op <> 'update' GROUP BY k),
        live AS (SELECT ch.* FROM ch LEFT JOIN marks m ON ch.k = m.k WHERE m.at IS NULL OR ch.seq >= m.at),
        f AS (SELECT k, arg_max(name, seq) AS name, arg_max(nation, seq) AS nation, arg_max(bal, seq) AS bal, arg_max(seg, seq) AS seg FROM live GROUP BY k)
        SELECT c_custkey, coalesce(f.name, c_name) AS c_name, coalesce(f.nation, c_nationkey) AS c_nationkey,
               coalesce(f.bal, c_acctbal) AS c_acctbal, coalesce(f.seg, c_mktsegment) AS c_mktsegment
        FROM customer LEFT JOIN f ON c_custkey = f.k WHERE c_custkey NOT IN (SELECT k FROM marks)
        UNION ALL SELECT f.k, f.name, f.nation, f.bal, f.seg FROM f JOIN marks m ON f.k = m.k WHERE m.op = 'create'""",
}
