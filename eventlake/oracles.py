"""DuckDB SQL oracles, one per registered query.

The Spark side goes the long way (driver rows -> JSON text -> parse -> layers);
these statements compute the same answers directly from the driver columns,
following the fixture rules in FIXTURES.md section 2.  Integer widths are cast
to match Spark (DuckDB sums are HUGEINT, ``hour()`` is BIGINT).
"""

from __future__ import annotations

from eventlake.operators.quality import KNOWN_EVENT_TYPES

SOURCE_FILE = "landing/events.jsonl"

# Driver events -> fixture fields, payload text, raw line text and reason.
EVENTS_CTE = r"""
ev AS (
  SELECT event_id AS n, ts, user_id,
         CAST(regexp_extract(props, '"k"\s*:\s*(-?[0-9]+)', 1) AS BIGINT) AS k,
         CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'SponsorshipEvent'
              ELSE CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
                                   WHEN 'signup' THEN 'ForkEvent' WHEN 'purchase' THEN 'PullRequestEvent'
                                   WHEN 'error' THEN 'IssuesEvent' END END AS etype
  FROM events
),
f AS (
  SELECT n, ts, user_id, k, etype,
         CASE WHEN n % 79 <> 0 THEN concat('user', CAST(user_id AS VARCHAR), CASE WHEN user_id % 10 = 0 THEN '[bot]' ELSE '' END) END AS login,
         CASE WHEN n % 97 <> 0 AND n % 109 <> 0 THEN CAST(n AS VARCHAR) END AS id,
         CASE WHEN n % 89 <> 0 THEN k END AS repo_id,
         CASE WHEN n % 107 <> 0 THEN concat('org', CAST(k % 10 AS VARCHAR), '/repo', CAST(k AS VARCHAR)) END AS repo_name,
         concat('org', CAST(k % 10 AS VARCHAR)) AS repo_owner,
         CASE n % 3 WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' END AS action,
         CASE WHEN n % 83 = 0 THEN 'not-a-timestamp' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
         CASE WHEN n % 83 = 0 THEN NULL ELSE date_trunc('second', ts) END AS event_ts,
         CASE WHEN n % 71 = 0 THEN 2 ELSE 1 END AS copies
  FROM ev
),
p AS (
  SELECT *,
         concat('{', concat_ws(',',
            CASE WHEN action IS NOT NULL THEN concat('"action":"', action, '"') END,
            CASE WHEN etype = 'PushEvent' THEN concat('"ref":"refs/heads/b', CAST(n % 4 AS VARCHAR), '"') END,
            CASE WHEN etype = 'PushEvent' THEN concat('"ref_type":"', CASE WHEN n % 4 = 0 THEN 'tag' ELSE 'branch' END, '"') END,
            CASE WHEN etype = 'PushEvent' THEN concat('"size":', CAST(CAST(n % 5 + (n % 2) * 0.5 AS DOUBLE) AS VARCHAR)) END,
            CASE WHEN etype = 'IssuesEvent' THEN concat('"number":', CAST(n % 1000 AS VARCHAR)) END,
            CASE WHEN etype = 'PullRequestEvent' THEN concat('"pull_request":{"number":', CAST(n % 1000 AS VARCHAR),
                 ',"merged":', CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END, '}') END
         ), '}') AS payload
  FROM f
),
r AS (
  SELECT *,
         CASE WHEN n % 109 = 0 THEN concat('broken line ', CAST(n AS VARCHAR)) ELSE concat('{', concat_ws(',',
            CASE WHEN id IS NOT NULL THEN concat('"id":"', id, '"') END,
            CASE WHEN etype IS NOT NULL THEN concat('"type":"', etype, '"') END,
            concat('"actor":{"id":', CAST(user_id AS VARCHAR), CASE WHEN login IS NOT NULL THEN concat(',"login":"', login, '"') END, '}'),
            concat('"repo":{', concat_ws(',', CASE WHEN repo_id IS NOT NULL THEN concat('"id":', CAST(repo_id AS VARCHAR)) END,
                   CASE WHEN repo_name IS NOT NULL THEN concat('"name":"', repo_name, '"') END), '}'),
            concat('"payload":', payload),
            concat('"created_at":"', created_at, '"')
         ), '}') END AS raw_record,
         CASE WHEN id IS NULL THEN 'missing_event_id'
              WHEN etype IS NULL THEN 'missing_event_type'
              WHEN repo_id IS NULL THEN 'missing_repo_id'
              WHEN repo_name IS NULL THEN 'missing_repo_name'
              WHEN event_ts IS NULL THEN 'invalid_event_timestamp' END AS dq_reason
  FROM p
),
valid AS (SELECT * FROM r WHERE dq_reason IS NULL),
quarantine AS (
  SELECT r.* FROM r JOIN (VALUES (1), (2)) AS c(i) ON c.i <= r.copies WHERE r.dq_reason IS NOT NULL
),
silver AS (
  SELECT id AS event_id, etype AS event_type, action AS event_action, user_id AS actor_id, login AS actor_login,
         CASE WHEN login IS NOT NULL THEN user_id % 10 = 0 END AS is_bot, repo_id, repo_name, repo_owner,
         CASE WHEN etype = 'PushEvent' THEN concat('refs/heads/b', CAST(n % 4 AS VARCHAR)) END AS ref,
         CASE WHEN etype = 'PushEvent' THEN CASE WHEN n % 4 = 0 THEN 'tag' ELSE 'branch' END END AS ref_type,
         CAST(CASE WHEN etype = 'PushEvent' THEN n % 5 END AS INTEGER) AS push_size,
         CAST(CASE WHEN etype IN ('IssuesEvent', 'PullRequestEvent') THEN n % 1000 END AS INTEGER) AS pr_or_issue_number,
         CASE WHEN etype = 'PullRequestEvent' THEN n % 2 = 0 END AS pr_merged,
         payload, event_ts, CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INTEGER) AS event_hour,
         '""" + SOURCE_FILE + r"""' AS source_file, 'batch' AS source
  FROM valid
)"""

# Driver part -> the two repository snapshots and the dimension after both.
DIM_CTE = r"""
snap1 AS (
  SELECT p_partkey AS repo_id,
         concat('org', CAST(p_partkey % 10 AS VARCHAR), '/repo', CAST(p_partkey AS VARCHAR)) AS repo_name,
         CASE WHEN p_partkey % 13 <> 0 THEN p_brand END AS primary_language,
         CAST(p_size AS INTEGER) AS stargazers_count,
         CAST(p_partkey % 50 AS INTEGER) AS forks_count,
         CAST(p_partkey % 7 AS INTEGER) AS open_issues_count,
         CASE WHEN p_partkey % 17 = 0 THEN '' ELSE array_to_string(list_sort(string_split(p_name, ' ')), ',') END AS topics,
         p_type AS description,
         (p_partkey % 9 = 0) AS is_fork,
         CAST(p_size * 10 AS INTEGER) AS size_kb
  FROM part
),
snap2 AS (
  SELECT id AS repo_id,
         concat('org', CAST(p_partkey % 10 AS VARCHAR), '/repo', CAST(p_partkey AS VARCHAR)) AS repo_name,
         CASE WHEN p_partkey % 13 <> 0 THEN p_brand END AS primary_language,
         CAST(CASE WHEN p_partkey % 4 = 0 THEN p_size + 1 ELSE p_size END AS INTEGER) AS stargazers_count,
         CAST(p_partkey % 50 AS INTEGER) AS forks_count,
         CAST(p_partkey % 7 AS INTEGER) AS open_issues_count,
         CASE WHEN p_partkey % 17 = 0 THEN '' ELSE array_to_string(list_sort(string_split(p_name, ' ')), ',') END AS topics,
         p_type AS description,
         (p_partkey % 9 = 0) AS is_fork,
         CAST(p_size * 10 + 1 AS INTEGER) AS size_kb
  FROM (SELECT p_partkey AS id, * FROM part WHERE p_partkey % 2 = 0
        UNION ALL SELECT p_partkey + 1000000 AS id, * FROM part WHERE p_partkey < 5)
),
h1 AS (
  SELECT *, sha256(concat_ws('||', coalesce(CAST(repo_name AS VARCHAR), '∅'), coalesce(CAST(primary_language AS VARCHAR), '∅'),
         coalesce(CAST(stargazers_count AS VARCHAR), '∅'), coalesce(CAST(forks_count AS VARCHAR), '∅'),
         coalesce(CAST(open_issues_count AS VARCHAR), '∅'), coalesce(CAST(topics AS VARCHAR), '∅'),
         coalesce(CAST(is_fork AS VARCHAR), '∅'))) AS record_hash
  FROM snap1
),
h2 AS (
  SELECT *, sha256(concat_ws('||', coalesce(CAST(repo_name AS VARCHAR), '∅'), coalesce(CAST(primary_language AS VARCHAR), '∅'),
         coalesce(CAST(stargazers_count AS VARCHAR), '∅'), coalesce(CAST(forks_count AS VARCHAR), '∅'),
         coalesce(CAST(open_issues_count AS VARCHAR), '∅'), coalesce(CAST(topics AS VARCHAR), '∅'),
         coalesce(CAST(is_fork AS VARCHAR), '∅'))) AS record_hash
  FROM snap2
),
dim1 AS (
  SELECT h1.*, TIMESTAMP '2024-01-15 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM h1
),
dim2 AS (
  -- kept open: absent from snapshot 2, or present with the same hash
  SELECT d.* FROM dim1 d LEFT JOIN h2 ON h2.repo_id = d.repo_id
  WHERE h2.repo_id IS NULL OR h2.record_hash = d.record_hash
  UNION ALL
  -- closed: present with a different hash
  SELECT d.repo_id, d.repo_name, d.primary_language, d.stargazers_count, d.forks_count, d.open_issues_count, d.topics,
         d.description, d.is_fork, d.size_kb, d.record_hash, d.valid_from, TIMESTAMP '2024-01-16 00:00:00' AS valid_to,
         FALSE AS is_current
  FROM dim1 d JOIN h2 ON h2.repo_id = d.repo_id AND h2.record_hash <> d.record_hash
  UNION ALL
  -- opened: new key or changed hash
  SELECT h2.*, TIMESTAMP '2024-01-16 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM h2 LEFT JOIN dim1 d ON d.repo_id = h2.repo_id
  WHERE d.repo_id IS NULL OR d.record_hash <> h2.record_hash
),
cur AS (SELECT repo_id, primary_language, topics FROM dim2 WHERE is_current)"""


def with_events(body: str) -> str:
    return "WITH " + EVENTS_CTE + "\n" + body


def with_all(body: str) -> str:
    return "WITH " + EVENTS_CTE + ",\n" + DIM_CTE + "\n" + body


GOLD_SQL = {
    "event_type_summary_hourly": """
  SELECT event_date, event_hour, event_type, count(*) AS event_count,
         count(DISTINCT actor_id) AS unique_actors, count(DISTINCT repo_id) AS unique_repos
  FROM silver GROUP BY event_date, event_hour, event_type""",
    "hot_repos_hourly": """
  SELECT event_date, event_hour, repo_id, repo_name, repo_owner, count(*) AS event_count,
         count(DISTINCT actor_id) AS unique_actors,
         count(*) FILTER (WHERE event_type = 'WatchEvent') AS stars,
         count(*) FILTER (WHERE event_type = 'ForkEvent') AS forks,
         count(*) FILTER (WHERE event_type = 'PushEvent') AS pushes,
         count(*) FILTER (WHERE event_type = 'PullRequestEvent') AS pull_requests,
         count(*) FILTER (WHERE event_type = 'IssuesEvent') AS issues
  FROM silver GROUP BY event_date, event_hour, repo_id, repo_name, repo_owner""",
    "contributor_activity_daily": """
  SELECT event_date, actor_id, actor_login, is_bot, count(*) AS total_events,
         count(DISTINCT repo_id) AS repos_touched,
         count(*) FILTER (WHERE event_type = 'PushEvent') AS push_events,
         count(*) FILTER (WHERE event_type = 'PullRequestEvent') AS pr_events,
         count(*) FILTER (WHERE event_type = 'PullRequestEvent' AND event_action = 'opened') AS prs_opened,
         count(*) FILTER (WHERE event_type = 'IssuesEvent') AS issue_events,
         count(*) FILTER (WHERE event_type = 'IssuesEvent' AND event_action = 'opened') AS issues_opened,
         count(*) FILTER (WHERE event_type = 'WatchEvent') AS stars_given
  FROM silver GROUP BY event_date, actor_id, actor_login, is_bot""",
    "language_trends_daily": """
  SELECT s.event_date, c.primary_language, count(*) AS event_count,
         count(DISTINCT s.repo_id) AS unique_repos, count(DISTINCT s.actor_id) AS unique_actors,
         count(*) FILTER (WHERE s.event_type = 'WatchEvent') AS stars
  FROM silver s JOIN cur c ON c.repo_id = s.repo_id
  WHERE c.primary_language IS NOT NULL
  GROUP BY s.event_date, c.primary_language""",
    "topic_trends_daily": """
  SELECT s.event_date, t.topic, count(*) AS event_count,
         count(DISTINCT s.repo_id) AS unique_repos, count(DISTINCT s.actor_id) AS unique_actors
  FROM silver s
  JOIN (SELECT repo_id, unnest(string_split(topics, ',')) AS topic FROM cur
        WHERE topics IS NOT NULL AND topics <> '') t ON t.repo_id = s.repo_id
  GROUP BY s.event_date, t.topic""",
}


def _gold(name: str) -> str:
    return f"gold_{name} AS ({GOLD_SQL[name]}\n)"


KNOWN_TYPES_SQL = ", ".join(f"'{t}'" for t in KNOWN_EVENT_TYPES)

LAYER_CTE = """,
t_bronze AS (SELECT id AS event_id, etype AS event_type, repo_id, repo_name, event_ts AS event_timestamp FROM valid),
t_silver AS (SELECT * FROM silver),
t_gold AS (SELECT * FROM gold_event_type_summary_hourly)"""


def _row(layer, name, ctype, sev, passed, observed, expected):
    return (f"SELECT '{name}' AS check_name, '{ctype}' AS check_type, '{sev}' AS severity, {passed} AS passed, "
            f"{observed} AS observed, '{expected}' AS expected, '{layer}' AS layer FROM t_{layer}")


def _custom_checks(layer: str) -> list[str]:
    out = [_row(layer, "row_count_min", "row_count", "critical", "count(*) >= 1", "CAST(count(*) AS VARCHAR)", ">=1")]
    if layer == "gold":
        return out
    cols = (["event_id", "event_type", "repo_id", "repo_name", "event_timestamp"] if layer == "bronze"
            else ["event_id", "event_type", "repo_id"])
    nn = [f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols]
    q = "''"
    parts = ", ".join(
        f"CASE WHEN {x} > 0 THEN concat('{q}{c}{q}: ', CAST({x} AS VARCHAR)) END" for c, x in zip(cols, nn)
    )
    anybad = " OR ".join(f"{x} > 0" for x in nn)
    observed = f"CASE WHEN {anybad} THEN concat('{{', concat_ws(', ', {parts}), '}}') ELSE 'no nulls' END"
    out.append(_row(layer, "not_null:" + ",".join(cols), "not_null", "critical", f"NOT ({anybad})", observed, "0 nulls"))
    dups = f"(count(*) - (SELECT count(*) FROM (SELECT DISTINCT event_id FROM t_{layer})))"
    out.append(_row(layer, "unique:event_id", "unique", "critical", f"{dups} = 0",
                    f"concat(CAST({dups} AS VARCHAR), ' dups')", "0 dups"))
    if layer == "silver":
        bad = f"count(*) FILTER (WHERE event_type IS NOT NULL AND event_type NOT IN ({KNOWN_TYPES_SQL}))"
        out.append(_row(layer, "accepted_values:event_type", "accepted_values", "warning", f"{bad} = 0",
                        f"concat(CAST({bad} AS VARCHAR), ' out-of-set')", "all in set"))
    return out


def _expectations(layer: str) -> list[str]:
    nn, ins = "expect_column_values_to_not_be_null", "expect_column_values_to_be_in_set"
    specs = {
        "bronze": [(nn, "event_id", None), (nn, "event_type", None), (nn, "repo_id", None)],
        "silver": [(nn, "event_id", None), (nn, "repo_id", None), (ins, "event_type", KNOWN_TYPES_SQL),
                   (ins, "is_bot", "TRUE, FALSE")],
        "gold": [(nn, "event_date", None)],
    }[layer]
    out = []
    for etype, col, values in specs:
        cond = f"{col} IS NULL" if values is None else f"{col} IS NOT NULL AND {col} NOT IN ({values})"
        bad = f"count(*) FILTER (WHERE {cond})"
        out.append(_row(layer, f"gx:{etype}:{col}", "expectation", "warning", f"{bad} = 0",
                        f"concat('unexpected=', CAST({bad} AS VARCHAR))", etype))
    return out


def _dq_sql(layers, custom: bool, declarative: bool) -> str:
    rows = []
    for layer in layers:
        if custom:
            rows += _custom_checks(layer)
        if declarative:
            rows += _expectations(layer)
    return "\nUNION ALL\n".join(rows)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_valid"] = with_events(f"""
SELECT id AS event_id, etype AS event_type, user_id AS actor_id, login AS actor_login, repo_id, repo_name, payload,
       strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp, CAST(event_ts AS DATE) AS event_date,
       '{SOURCE_FILE}' AS source_file
FROM valid""")
    q["bronze_quarantine"] = with_events(f"""
SELECT id AS event_id, '{SOURCE_FILE}' AS source_file, dq_reason, raw_record FROM quarantine""")
    q["quarantine_reasons"] = with_events("""
SELECT dq_reason, count(*) AS rows FROM quarantine GROUP BY dq_reason""")
    q["silver_events"] = with_events("""
SELECT event_id, event_type, event_action, actor_id, actor_login, is_bot, repo_id, repo_name, repo_owner, ref, ref_type,
       push_size, pr_or_issue_number, pr_merged, payload, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
       event_date, event_hour, source_file, source
FROM silver""")
    for name in ("event_type_summary_hourly", "hot_repos_hourly", "contributor_activity_daily"):
        q[name] = with_events("," + _gold(name) + f"\nSELECT * FROM gold_{name}")
    for name in ("language_trends_daily", "topic_trends_daily"):
        q[name] = with_all("," + _gold(name) + f"\nSELECT * FROM gold_{name}")
    trending = """
SELECT repo_name, CAST(sum(unique_actors) AS BIGINT) AS contributors, CAST(sum(event_count) AS BIGINT) AS events,
       CAST(sum(stars) AS BIGINT) AS stars, CAST(sum(forks) AS BIGINT) AS forks
FROM gold_hot_repos_hourly GROUP BY repo_name"""
    q["vw_trending_repos"] = with_events("," + _gold("hot_repos_hourly") + trending)
    dim_cols = """repo_id, repo_name, primary_language, stargazers_count, forks_count, open_issues_count, topics,
       description, is_fork, size_kb, record_hash, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
       strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to, is_current"""
    q["scd2_initial"] = with_all(f"SELECT {dim_cols} FROM dim1")
    q["scd2_second_snapshot"] = with_all(f"SELECT {dim_cols} FROM dim2")
    q["scd2_version_stats"] = with_all("""
SELECT count(*) AS rows_total, count(*) FILTER (WHERE is_current) AS current,
       count(*) FILTER (WHERE NOT is_current) AS historical FROM dim2""")
    q["snapshot_normalise"] = with_all("SELECT * FROM snap2")
    q["enrichment_targets"] = with_events("""
SELECT repo_id, repo_name, count(DISTINCT actor_id) AS actors, count(*) AS activity
FROM silver WHERE NOT is_bot GROUP BY repo_id, repo_name HAVING count(DISTINCT actor_id) >= 3
ORDER BY actors DESC, activity DESC, repo_id ASC LIMIT 100""")
    q["target_snapshot"] = with_all(", targets AS (" + q["enrichment_targets"].removeprefix("WITH " + EVENTS_CTE) + """)
SELECT t.repo_id, t.repo_name, s.* EXCLUDE (repo_id, repo_name) FROM targets t JOIN snap1 s USING (repo_name)""")
    etsum = "," + _gold("event_type_summary_hourly")
    q["vw_event_type_distribution"] = with_events(etsum + """
SELECT event_type, CAST(sum(event_count) AS BIGINT) AS events, CAST(sum(unique_actors) AS BIGINT) AS actors
FROM gold_event_type_summary_hourly GROUP BY event_type""")
    q["vw_hourly_activity"] = with_events(etsum + """
SELECT event_hour, CAST(sum(event_count) AS BIGINT) AS events FROM gold_event_type_summary_hourly GROUP BY event_hour""")
    lang = """
SELECT primary_language, CAST(sum(event_count) AS BIGINT) AS events, CAST(sum(unique_repos) AS BIGINT) AS repos,
       CAST(sum(stars) AS BIGINT) AS stars
FROM gold_language_trends_daily WHERE primary_language IS NOT NULL GROUP BY primary_language"""
    q["vw_language_trends"] = with_all("," + _gold("language_trends_daily") + lang)
    q["languages_top15"] = with_all("," + _gold("language_trends_daily") + lang
                                    + "\nORDER BY events DESC, primary_language ASC LIMIT 15")
    topic = """
SELECT topic, CAST(sum(event_count) AS BIGINT) AS events, CAST(sum(unique_repos) AS BIGINT) AS repos
FROM gold_topic_trends_daily GROUP BY topic"""
    q["vw_topic_trends"] = with_all("," + _gold("topic_trends_daily") + topic)
    q["topics_top20"] = with_all("," + _gold("topic_trends_daily") + topic + "\nORDER BY events DESC, topic ASC LIMIT 20")
    contrib = """
SELECT actor_login, CAST(sum(prs_opened) AS BIGINT) AS prs_opened, CAST(sum(issues_opened) AS BIGINT) AS issues_opened,
       CAST(sum(repos_touched) AS BIGINT) AS repos, CAST(sum(total_events) AS BIGINT) AS events
FROM gold_contributor_activity_daily WHERE NOT is_bot GROUP BY actor_login
HAVING sum(prs_opened) + sum(issues_opened) > 0"""
    cad = "," + _gold("contributor_activity_daily")
    q["vw_top_contributors"] = with_events(cad + contrib)
    q["contributors_top20"] = with_events(
        cad + contrib + "\nORDER BY prs_opened DESC, issues_opened DESC, repos DESC, actor_login ASC LIMIT 20"
    )
    q["vw_bot_vs_human"] = with_events(cad + """
SELECT CASE WHEN is_bot THEN 'bot' ELSE 'human' END AS actor_kind, CAST(sum(total_events) AS BIGINT) AS events,
       count(DISTINCT actor_login) AS actors
FROM gold_contributor_activity_daily GROUP BY is_bot""")
    q["vw_batch_vs_stream"] = with_events("""
SELECT CASE WHEN event_date <= DATE '2024-01-15' THEN 'batch' ELSE 'stream' END AS source, count(*) AS events
FROM silver GROUP BY 1""")
    q["vw_repo_versions"] = with_all("SELECT is_current, count(*) AS rows FROM dim2 GROUP BY is_current")
    q["kpi_totals"] = with_events("""
SELECT count(*) AS total_events, count(DISTINCT repo_id) AS distinct_repos,
       count(DISTINCT actor_id) AS distinct_contributors FROM silver""")
    dq_pre = etsum + LAYER_CTE + "\n"
    q["dq_bronze"] = with_events(dq_pre + _dq_sql(["bronze"], True, False))
    q["dq_silver"] = with_events(dq_pre + _dq_sql(["silver"], True, False))
    q["dq_gold"] = with_events(dq_pre + _dq_sql(["gold"], True, False))
    q["dq_declarative"] = with_events(dq_pre + _dq_sql(["bronze", "silver", "gold"], False, True))
    q["vw_dq_health"] = with_events(dq_pre.rstrip() + ",\ndq AS (" + _dq_sql(["bronze", "silver", "gold"], True, True) + """)
SELECT layer, count(*) AS checks, count(*) FILTER (WHERE passed) AS passed,
       CAST(round(100.0 * count(*) FILTER (WHERE passed) / count(*), 1) AS DOUBLE) AS pass_pct
FROM dq GROUP BY layer""")
    def silver_select(source_file: str, source: str) -> str:
        return f"""
SELECT event_id, event_type, event_action, actor_id, actor_login, is_bot, repo_id, repo_name, repo_owner, ref, ref_type,
       push_size, pr_or_issue_number, pr_merged, payload, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
       event_date, event_hour, {source_file} AS source_file, {source} AS source
FROM silver"""

    q["merge_insert_only"] = with_events("""
SELECT id AS event_id, etype AS event_type, user_id AS actor_id, login AS actor_login, repo_id, repo_name, payload,
       strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp, CAST(event_ts AS DATE) AS event_date,
       CASE WHEN CAST(event_ts AS DATE) <= DATE '2024-01-15' THEN 'batch-1' ELSE 'batch-2' END AS source_file
FROM valid""")
    q["merge_insert_moved_day"] = with_events(f"""
SELECT id AS event_id, etype AS event_type, user_id AS actor_id, login AS actor_login, repo_id, repo_name, payload,
       strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp, CAST(event_ts AS DATE) AS event_date,
       '{SOURCE_FILE}' AS source_file
FROM valid""")
    again = "right(event_id, 2) IN ('00', '50')"
    q["merge_upsert_moved_day"] = with_events(f"""
SELECT event_id, event_type, event_action, actor_id, actor_login, is_bot, repo_id, repo_name, repo_owner, ref, ref_type,
       push_size, pr_or_issue_number, pr_merged, payload,
       strftime(event_ts + CASE WHEN {again} THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
       CAST(event_date + CASE WHEN {again} THEN 1 ELSE 0 END AS DATE) AS event_date, event_hour, source_file,
       CASE WHEN {again} THEN 'stream' ELSE 'batch' END AS source
FROM silver""")
    q["merge_upsert"] = with_events(silver_select(
        "source_file", "CASE WHEN event_date >= DATE '2024-01-11' THEN 'stream' ELSE 'batch' END"))
    q["merge_insert_bloom_days"] = q["merge_insert_moved_day"]
    third = "event_date >= DATE '2024-01-18' OR event_date < DATE '2024-01-11'"
    q["upsert_two_writers"] = q["merge_upsert_moved_day"].replace(
        "ELSE 'batch' END AS source", f"WHEN {third} THEN 'batch' ELSE 'stream' END AS source"
    )
    q["dq_unique_incremental"] = with_events(f"""
SELECT 'unique:event_id' AS check_name, 'unique' AS check_type, 'critical' AS severity, count(*) = 0 AS passed,
       concat(CAST(count(*) AS VARCHAR), ' dups') AS observed, '0 dups' AS expected, 'silver' AS layer
FROM silver WHERE event_date > DATE '2024-01-15' AND {again}""")
    set_keys = {
        "event_type_summary_hourly": ["event_date", "event_hour", "event_type"],
        "hot_repos_hourly": ["event_date", "event_hour", "repo_id", "repo_name", "repo_owner"],
        "contributor_activity_daily": ["event_date", "actor_id", "actor_login", "is_bot"],
    }
    set_counts = {
        "event_type_summary_hourly": ["event_count", "unique_actors", "unique_repos"],
        "hot_repos_hourly": ["event_count", "forks", "issues", "pull_requests", "pushes", "stars", "unique_actors"],
        "contributor_activity_daily": ["issue_events", "issues_opened", "pr_events", "prs_opened", "push_events", "repos_touched", "stars_given", "total_events"],
    }
    all_keys = list(dict.fromkeys(k for ks in set_keys.values() for k in ks))
    q["gold_grouping_sets"] = with_events("," + ",".join(_gold(t) for t in set_keys) + "\n" + "\nUNION ALL BY NAME\n".join(
        f"SELECT '{t}' AS table_name, {', '.join(k if k in set_keys[t] else f'NULL AS {k}' for k in all_keys)}, "
        f"concat_ws(',', {', '.join(f"concat('{c}=', {c})" for c in set_counts[t])}) AS counts FROM gold_{t}"
        for t in set_keys
    ))
    q["contributors_rollup"] = with_events("," + _gold("hot_repos_hourly") + """
SELECT h.repo_name, CAST(sum(h.event_count) AS BIGINT) AS events, CAST(sum(h.unique_actors) AS BIGINT) AS contributors_summed,
       any_value(e.n) AS contributors_exact, true AS within_error
FROM gold_hot_repos_hourly h JOIN (SELECT repo_name, count(DISTINCT actor_id) AS n FROM silver GROUP BY repo_name) e USING (repo_name)
GROUP BY h.repo_name""")
    q["replace_day"] = with_events("""
SELECT event_date, event_hour, event_type, count(*) AS event_count,
       count(DISTINCT actor_id) AS unique_actors, count(DISTINCT repo_id) AS unique_repos
FROM silver
WHERE NOT (event_date = DATE '2024-01-10' AND event_type = 'PushEvent') AND event_date <> DATE '2024-01-11'
GROUP BY event_date, event_hour, event_type""")
    q["compact_day"] = with_events(silver_select("source_file", "source"))
    q["compact_day_zorder"] = q["compact_day"]
    q["stream_available_now"] = with_events(silver_select("'stream'", "'stream'"))
    q["stream_dedup_watermark"] = with_events("""
SELECT id AS event_id, etype AS event_type, user_id AS actor_id, login AS actor_login, repo_id, repo_name, payload,
       strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp, 'stream' AS source_file
FROM r WHERE id IS NOT NULL""")
    q["stream_replayed_batch"] = q["stream_bad_first_batch"] = q["stream_offsets"] = q["stream_available_now"]
    # more than 5000 other ids lie between the first days and their second coming
    q["stream_recent_set"] = with_events("""
SELECT id AS event_id, etype AS event_type, repo_id FROM r JOIN (VALUES (1), (2)) AS c(i)
  ON c.i = 1 OR (CAST(ts AS DATE) <= DATE '2024-01-03'
                 AND (SELECT count(DISTINCT id) FROM r WHERE CAST(ts AS DATE) > DATE '2024-01-03') > 5000)
WHERE id IS NOT NULL""")
    q["batch_job_moved_day"] = with_events(f""",
moved AS (SELECT * REPLACE (CAST(event_date + CASE WHEN {again} THEN 1 ELSE 0 END AS DATE) AS event_date) FROM silver)"""
        + GOLD_SQL["event_type_summary_hourly"].replace("FROM silver", "FROM moved"))
    q["batch_job_hot_hour"] = q["event_type_summary_hourly"]
    q["batch_job_gold"] = q["event_type_summary_hourly"]
    q["batch_job_trends"] = q["language_trends_daily"]
    q["batch_job_dimension"] = q["scd2_second_snapshot"]
    q["batch_job_quarantine"] = with_events("""
SELECT id AS event_id, dq_reason, raw_record FROM quarantine""")
    q["stream_quarantine"] = with_events("""
SELECT id AS event_id, 'stream' AS source_file, dq_reason, raw_record FROM quarantine
UNION ALL
SELECT id, 'stream', dq_reason, raw_record FROM quarantine WHERE CAST(ts AS DATE) <= DATE '2024-01-03'""")
    q["stream_bronze"] = with_events("""
SELECT id AS event_id, etype AS event_type, user_id AS actor_id, login AS actor_login, repo_id, repo_name, payload,
       strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp, CAST(event_ts AS DATE) AS event_date,
       'stream' AS source_file
FROM valid""")
    q["dq_health_ordered"] = q["vw_dq_health"] + "\nORDER BY layer"
    q["event_types_ordered"] = q["vw_event_type_distribution"] + "\nORDER BY events DESC, event_type"
    q["hours_ordered"] = q["vw_hourly_activity"] + "\nORDER BY event_hour"
    q["lake_trending_repos"] = q["vw_trending_repos"]
    q["lake_batch_vs_stream"] = q["vw_batch_vs_stream"]
    three = ["event_type_summary_hourly", "hot_repos_hourly", "contributor_activity_daily"]
    counts = ["SELECT 'bronze/events_batch' AS name, count(*) AS written, count(*) AS table_total FROM valid"]
    counts += [f"SELECT 'gold/{t}', count(*), count(*) FROM gold_{t}" for t in three]
    q["batch_job_metrics"] = with_events("," + ",".join(_gold(t) for t in three) + "\n" + "\nUNION ALL\n".join(counts))
    q["hour_slots"] = """
WITH b AS (SELECT date_trunc('hour', min(ts)) AS s, date_trunc('hour', max(ts)) AS e FROM events),
x AS (SELECT unnest(generate_series(b.s, b.e, INTERVAL 1 HOUR)) AS slot FROM b)
SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot_start, CAST(slot AS DATE) AS slot_date,
       CAST(hour(slot) AS INTEGER) AS slot_hour,
       concat(strftime(slot, '%Y-%m-%d'), '-', CAST(hour(slot) AS VARCHAR), '.json.gz') AS file_name,
       strftime(slot, 'year=%Y/month=%m/day=%d/hour=%H') AS folder
FROM x"""
    q["trending_top20"] = with_events(
        "," + _gold("hot_repos_hourly") + trending + "\nORDER BY contributors DESC, events DESC, repo_name ASC LIMIT 20"
    )
    return q
