"""Independent SQL for every registered job, runnable by DuckDB on views
named after the driver's tables.  Each statement derives its inputs with
the same fixed rules as ``sources.derived`` and computes the result the
plain way (global windows, self-joins), so it checks the Spark plans
rather than repeating them.  Output column names and types equal the
Spark jobs'."""

from __future__ import annotations

# -- shared derivations ---------------------------------------------------

_WORDS = r"""
lines AS (
  SELECT unnest(regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')) AS line
  FROM documents WHERE text <> ''),
toks AS (
  SELECT CASE WHEN line = '' THEN ['']
              WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
              ELSE string_split(rtrim(line, ' '), ' ') END AS ws
  FROM lines),
words AS (SELECT unnest(ws) AS w FROM toks)
"""

_MATRIX = """
li AS (SELECT l_suppkey, month(l_shipdate) AS m FROM lineitem),
months AS (SELECT DISTINCT m FROM li),
cnt AS (SELECT l_suppkey, m, count(*) % 6 AS n FROM li GROUP BY l_suppkey, m),
grid AS (
  SELECT s.s_suppkey, s.s_name, mo.m,
         CASE WHEN c.n IS NULL OR c.n = 0 THEN '' ELSE CAST(c.n AS VARCHAR) END AS cell
  FROM supplier s CROSS JOIN months mo
  LEFT JOIN cnt c ON c.l_suppkey = s.s_suppkey AND c.m = mo.m),
lines AS (
  SELECT s_name || ',' || string_agg(cell, ',' ORDER BY m) AS value
  FROM grid GROUP BY s_suppkey, s_name),
parsed AS (
  SELECT parts[1] AS title, parts[2:] AS cells
  FROM (SELECT string_split(value, ',') AS parts FROM lines)),
long AS (
  SELECT title, CAST(usr AS INTEGER) AS usr, cells[usr] AS cell,
         CASE WHEN cells[usr] = '' THEN NULL ELSE CAST(cells[usr] AS INTEGER) END AS rating
  FROM (SELECT title, cells, unnest(generate_series(1, len(cells))) AS usr FROM parsed))
"""

_OCCUPANCY = """
nr AS (SELECT greatest(2, CAST(floor(count(DISTINCT user_id) / 5) AS BIGINT)) AS r FROM events),
log AS (
  SELECT e.event_id AS seq,
         CASE WHEN e.event_id % 20 = 0 THEN 'class' ELSE 'student' END AS src,
         CASE WHEN e.event_id % 20 = 0
              THEN 'room-' || CAST((CAST(floor(e.event_id / 20) AS BIGINT) + e.user_id) % nr.r AS VARCHAR)
              ELSE CAST(e.user_id AS VARCHAR) END AS key,
         CASE WHEN e.event_id % 17 = 0 THEN NULL
              WHEN e.event_id % 20 = 0 THEN CAST(CAST(floor(e.value) AS BIGINT) % 8 + 2 AS VARCHAR)
              ELSE 'room-' || CAST((CAST(floor(e.event_id / 20) AS BIGINT) + e.user_id) % nr.r AS VARCHAR)
         END AS val
  FROM events e CROSS JOIN nr),
stud AS (
  SELECT seq, key, val, lag(val) OVER (PARTITION BY key ORDER BY seq) AS old
  FROM log WHERE src = 'student'),
deltas AS (
  SELECT seq, 0 AS sub, old AS room, -1 AS delta, CAST(NULL AS INTEGER) AS cap, 0 AS is_cap
  FROM stud WHERE old IS NOT NULL
  UNION ALL
  SELECT seq, 1 AS sub, val AS room, 1 AS delta, CAST(NULL AS INTEGER) AS cap, 0 AS is_cap
  FROM stud WHERE val IS NOT NULL
  UNION ALL
  SELECT seq, 0 AS sub, key AS room, 0 AS delta, CAST(val AS INTEGER) AS cap, 1 AS is_cap
  FROM log WHERE src = 'class'),
tl0 AS (
  SELECT *,
         CAST(sum(delta) OVER w AS BIGINT) AS cnt,
         CAST(sum(abs(delta)) OVER w AS BIGINT) AS seen,
         sum(is_cap) OVER w AS capgrp
  FROM deltas
  WINDOW w AS (PARTITION BY room ORDER BY seq, sub ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
tl AS (
  SELECT *, first_value(cap) OVER (PARTITION BY room, capgrp ORDER BY seq, sub) AS cur_cap
  FROM tl0),
status AS (
  SELECT seq, sub, room, cur_cap AS cap, cnt FROM tl
  WHERE seen > 0 AND capgrp > 0 AND cur_cap IS NOT NULL)
"""

_ALERTS = """
al AS (
  SELECT seq, sub, room,
         CASE WHEN cnt > cap THEN CAST(cnt AS VARCHAR)
              WHEN lag(cnt) OVER w > lag(cap) OVER w AND lag(cnt) OVER w > cnt THEN 'OK' END AS value
  FROM status WINDOW w AS (PARTITION BY room ORDER BY seq, sub))
"""

_OPLOG = """
ops AS (
  SELECT event_id, event_id % 8 AS tid, 'key-' || CAST(user_id AS VARCHAR) AS k,
         CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN 'w' ELSE 'r' END AS op,
         event_id * 1000 AS start,
         CAST(event_id * 1000 + (5 + CAST(floor(value) AS BIGINT) % 70) * 100 + 1 + event_id % 8
              AS BIGINT) AS finish,
         event_id % 53 = 0 AS pending
  FROM events),
wr AS (
  SELECT k, event_id, CASE WHEN event_id % 101 = 1 THEN 'value-shared'
                           ELSE 'value-' || CAST(event_id AS VARCHAR) END AS wv,
         row_number() OVER (PARTITION BY k ORDER BY event_id) AS wn
  FROM ops WHERE op = 'w'),
cntw AS (
  SELECT o.event_id, count(w.event_id) AS nb
  FROM ops o LEFT JOIN wr w ON w.k = o.k AND w.event_id < o.event_id
  GROUP BY o.event_id),
rd AS (
  SELECT o.*, w1.wv AS w1, w2.wv AS w2
  FROM ops o JOIN cntw c ON c.event_id = o.event_id
  LEFT JOIN wr w1 ON w1.k = o.k AND w1.wn = c.nb
  LEFT JOIN wr w2 ON w2.k = o.k AND w2.wn = c.nb - 1),
oplog AS (
  SELECT start AS t, tid, 'inv' AS phase, op, k,
         CASE WHEN op <> 'w' THEN NULL WHEN event_id % 101 = 1 THEN 'value-shared'
              ELSE 'value-' || CAST(event_id AS VARCHAR) END AS v
  FROM rd
  UNION ALL
  SELECT finish AS t, tid, 'res' AS phase, op, k,
         CASE WHEN op = 'w' THEN NULL
              WHEN event_id % 101 = 0 THEN 'junk-' || CAST(event_id AS VARCHAR)
              WHEN event_id % 97 = 0 AND w2 IS NOT NULL THEN w2
              ELSE coalesce(w1, '') END AS v
  FROM rd WHERE NOT pending),
nxt AS (
  SELECT *, lead(phase) OVER w AS nphase, lead(t) OVER w AS nt, lead(k) OVER w AS nk,
         lead(v) OVER w AS nv
  FROM oplog WINDOW w AS (PARTITION BY tid ORDER BY t)),
pairs AS (
  SELECT tid, op, k,
         CASE WHEN op = 'w' THEN v
              WHEN coalesce(nphase = 'res' AND nk = k, false) THEN nv END AS v,
         t AS start,
         CASE WHEN coalesce(nphase = 'res' AND nk = k, false) THEN nt END AS finish,
         CASE WHEN coalesce(nphase = 'res' AND nk = k, false) THEN 'ok' ELSE 'pending' END AS status
  FROM nxt WHERE phase = 'inv')
"""


# Lines of the JSON log that are damaged, by their instant.
_LINE_STATE = """CASE WHEN t % 59 = 0 OR t % 71 = 0 THEN 'malformed' WHEN t % 61 = 0 THEN 'missing_field'
  WHEN t % 67 = 0 THEN 'bad_value' ELSE 'ok' END"""


def _report(by: str) -> str:
    return f"""WITH {_OPLOG}
SELECT {by + "," if by else ""} count(CASE WHEN status = 'ok' THEN 1 END) AS n_ok,
       count(CASE WHEN status <> 'ok' THEN 1 END) AS n_pending,
       CAST(sum(CASE WHEN status = 'ok' THEN finish - start END) AS BIGINT) AS total_latency_us,
       floor(CAST(sum(CASE WHEN status = 'ok' THEN finish - start END) AS DOUBLE)
             / count(CASE WHEN status = 'ok' THEN 1 END) / 1000.0::DOUBLE * 100) / 100.0
         AS avg_latency_ms,
       CAST(floor(1e6::DOUBLE * count(CASE WHEN status = 'ok' THEN 1 END)
                  / (max(finish) - min(start))) AS BIGINT) AS throughput_per_s
FROM pairs {"GROUP BY " + by if by else ""}"""


_HISTORY = """
evs AS (
  SELECT k, v, op, start,
         CASE WHEN status = 'ok' THEN finish ELSE 4611686018427387904 END AS fin
  FROM pairs WHERE op = 'w' OR status = 'ok'),
cl0 AS (
  SELECT k, v,
         min(CASE WHEN op = 'w' THEN start END) AS ws,
         min(CASE WHEN op = 'w' THEN fin END) AS wf,
         min(CASE WHEN op = 'r' THEN fin END) AS rf,
         count(CASE WHEN op = 'r' THEN 1 END) AS n_reads,
         count(CASE WHEN op = 'w' THEN 1 END) AS n_writes,
         min(fin) AS f, max(start) AS s
  FROM evs GROUP BY k, v),
cl AS (
  SELECT k, v, ws IS NOT NULL OR v = '' AS has_write,
         n_writes > CASE WHEN v = '' THEN 0 ELSE 1 END AS duplicate,
         CASE WHEN v = '' THEN -4611686018427387904 ELSE ws END AS ws, rf,
         CASE WHEN v = '' THEN -4611686018427387903 ELSE f END AS f, s
  FROM cl0
  WHERE v = '' OR NOT (wf = 4611686018427387904 AND n_reads = 0 AND n_writes = 1)),
zones AS (
  SELECT k, v, ws, rf, f < s AS fwd, least(f, s) AS lo, greatest(f, s) AS hi
  FROM cl WHERE has_write AND k NOT IN (SELECT k FROM cl WHERE duplicate)),
flagged AS (
  SELECT z.k, z.v,
         CASE WHEN z.rf < z.ws THEN 'read_before_write'
              WHEN z.fwd AND EXISTS (SELECT 1 FROM zones o WHERE o.k = z.k AND o.fwd
                                     AND o.lo < z.lo AND o.hi > z.lo) THEN 'overlap'
              WHEN NOT z.fwd AND EXISTS (SELECT 1 FROM zones o WHERE o.k = z.k AND o.fwd
                                         AND o.lo < z.lo AND o.hi > z.hi) THEN 'containment'
         END AS reason
  FROM zones z),
pairs_of AS (
  SELECT f.k, f.v, f.reason, o.v AS other, o.hi
  FROM flagged f JOIN zones z ON z.k = f.k AND z.v = f.v
  JOIN zones o ON o.k = z.k AND o.fwd AND o.lo < z.lo
    AND o.hi > CASE WHEN f.reason = 'overlap' THEN z.lo ELSE z.hi END
  WHERE f.reason IN ('overlap', 'containment')),
checked AS (
  SELECT k, v, 2 AS score, 'junk' AS reason, CAST(NULL AS VARCHAR) AS other FROM cl WHERE NOT has_write
  UNION ALL
  SELECT k, v, 2 AS score, 'duplicate_write' AS reason, NULL AS other FROM cl WHERE duplicate
  UNION ALL
  SELECT k, v, 1 AS score, reason, NULL AS other FROM flagged WHERE reason = 'read_before_write'
  UNION ALL
  SELECT k, v, 1 AS score, reason, arg_max(other, hi) AS other FROM pairs_of GROUP BY k, v, reason)
"""

_DIGEST = "'$s2$' || md5(CAST(doc_id AS VARCHAR)) || '$' || sha256(md5(CAST(doc_id AS VARCHAR)) || text)"

_HASHES = """
hs AS (
  SELECT event_id AS id,
         CASE WHEN event_id % 7 = 0 THEN '$3a$' WHEN event_id % 7 = 1 THEN '$2x$'
              WHEN event_id % 7 = 2 THEN '$2$' ELSE '$2a$' END
         || CASE WHEN event_id % 11 = 0 THEN '99' WHEN event_id % 5 = 0 THEN '06' ELSE '12' END
         || CASE WHEN event_id % 17 = 0 THEN '-' ELSE '$' END
         || CASE WHEN event_id % 13 = 1
                 THEN substr(md5(CAST(event_id AS VARCHAR)) || md5(CAST(event_id + 1 AS VARCHAR)), 1, 52)
                 WHEN event_id % 13 = 0
                 THEN substr(md5(CAST(event_id AS VARCHAR)) || md5(CAST(event_id + 1 AS VARCHAR)), 1, 20)
                 ELSE substr(md5(CAST(event_id AS VARCHAR)) || md5(CAST(event_id + 1 AS VARCHAR)), 1, 53)
            END AS hash
  FROM events),
p AS (
  SELECT hash, substr(hash, 3, 1) <> '$' AS has_rev FROM hs),
q AS (
  SELECT hash, has_rev,
         (NOT has_rev OR (substr(hash, 3, 1) = 'a' AND substr(hash, 4, 1) = '$')) AS rev_ok,
         substr(hash, CASE WHEN has_rev THEN 5 ELSE 4 END, 2) AS rtxt,
         substr(hash, CASE WHEN has_rev THEN 7 ELSE 6 END, 1) AS term,
         substr(hash, CASE WHEN has_rev THEN 8 ELSE 7 END, 22) AS salt
  FROM p),
r AS (
  SELECT *, CASE WHEN regexp_full_match(rtxt, '[0-9]{2}') THEN CAST(rtxt AS INTEGER) END AS rounds
  FROM q),
c AS (
  SELECT CASE WHEN NOT starts_with(hash, '$2') THEN 'BAD_VERSION'
              WHEN NOT rev_ok THEN 'BAD_REVISION'
              WHEN term <> '$' THEN 'MISSING_ROUNDS'
              WHEN rounds IS NULL OR rounds < 4 OR rounds > 30 THEN 'BAD_ROUNDS'
              WHEN NOT regexp_full_match(salt, '[./A-Za-z0-9]{22}') THEN 'BAD_SALT'
              WHEN length(hash) <> CASE WHEN has_rev THEN 60 ELSE 59 END THEN 'BAD_LENGTH'
              WHEN rounds < 10 THEN 'WEAK_COST'
              ELSE 'OK' END AS class,
         rounds
  FROM r)
"""


def queries_sql() -> dict[str, str]:
    return {
        "word_count": f"""WITH {_WORDS}
SELECT w AS word, count(*) AS n FROM words GROUP BY w""",

        "text_word_count": f"""WITH {_WORDS}
SELECT w || ',' || CAST(count(*) AS VARCHAR) AS value FROM words GROUP BY w""",

        "matrix_titles": f"""WITH {_MATRIX}
SELECT split_part(value, ',', 1) AS title FROM lines""",

        "rating_lines": f"""WITH {_MATRIX}
SELECT p.title, CAST(len(p.cells) AS INTEGER) AS width,
       CAST(coalesce(sum(CASE WHEN l.rating IS NOT NULL THEN 1 ELSE 0 END), 0) AS INTEGER) AS n_rated,
       CAST(coalesce(sum(l.rating), 0) AS BIGINT) AS rating_sum
FROM parsed p LEFT JOIN long l ON l.title = p.title
GROUP BY p.title, p.cells""",

        "top_users": f"""WITH {_MATRIX}
SELECT title,
       coalesce(string_agg(CAST(usr AS VARCHAR), ',' ORDER BY usr) FILTER (WHERE rating = mx), '')
         AS top_users
FROM (SELECT title, usr, rating,
             greatest(1, coalesce(max(rating) OVER (PARTITION BY title), 1)) AS mx
      FROM long)
GROUP BY title""",

        "total_ratings": f"""WITH {_MATRIX}
SELECT CAST(sum(CASE WHEN cell <> '' THEN 1 ELSE 0 END) AS BIGINT) AS n
FROM long HAVING count(*) > 0""",

        "ratings_per_user": f"""WITH {_MATRIX}
SELECT usr, CAST(sum(CASE WHEN cell <> '' THEN 1 ELSE 0 END) AS BIGINT) AS n
FROM long GROUP BY usr""",

        "similarity": f"""WITH {_MATRIX}
SELECT a.title AS m1, b.title AS m2,
       count(CASE WHEN a.rating = b.rating AND a.rating <> 0 THEN 1 END) AS n
FROM long a JOIN long b ON a.usr = b.usr AND a.title < b.title
GROUP BY a.title, b.title""",

        "output_diff": """
WITH a AS (SELECT o_orderpriority || ',' || o_orderstatus AS line FROM orders WHERE o_orderkey % 3 <> 0),
b AS (SELECT o_orderpriority || ',' || o_orderstatus AS line FROM orders WHERE o_orderkey % 3 <> 1),
ab AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
ba AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
SELECT line, '<' AS side, CAST(count(*) AS BIGINT) AS n FROM ab GROUP BY line
UNION ALL
SELECT line, '>' AS side, CAST(count(*) AS BIGINT) AS n FROM ba GROUP BY line""",

        "latest_state": f"""WITH {_OCCUPANCY}
SELECT src, key, val FROM (
  SELECT src, key, val, row_number() OVER (PARTITION BY src, key ORDER BY seq DESC) AS rn FROM log)
WHERE rn = 1 AND val IS NOT NULL""",

        "room_counts": f"""WITH {_OCCUPANCY}
SELECT seq, sub, room, cnt FROM tl WHERE delta <> 0""",

        "room_status": f"""WITH {_OCCUPANCY}
SELECT seq, sub, room, cap, cnt FROM status""",

        "alerts": f"""WITH {_OCCUPANCY}, {_ALERTS}
SELECT seq, sub, room, value FROM al WHERE value IS NOT NULL""",

        "latest_by_key": """
SELECT key, value FROM (
  SELECT user_id AS key, props AS value,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1""",

        "bulk_upsert": """
WITH sp AS (SELECT floor((max(event_id) + 1) / 2) AS split FROM events),
old AS (
  SELECT key, value FROM (
    SELECT user_id AS key, props AS value,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
    FROM events, sp WHERE event_id < sp.split) WHERE rn = 1),
ld AS (
  SELECT key, value FROM (
    SELECT user_id AS key, props AS value,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
    FROM events, sp WHERE event_id >= sp.split) WHERE rn = 1)
SELECT key, value FROM old WHERE NOT EXISTS (SELECT 1 FROM ld WHERE ld.key = old.key)
UNION ALL
SELECT key, value FROM ld""",

        "lookup_default": """
WITH t AS (
  SELECT key, value FROM (
    SELECT user_id AS key, props AS value,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
  WHERE rn = 1)
SELECT c.c_custkey AS key, coalesce(t.value, '') AS value
FROM customer c LEFT JOIN t ON t.key = c.c_custkey""",

        "snapshot_export": """
SELECT key, value FROM (
  SELECT user_id AS key, props AS value,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1""",

        "snapshot_files": """
SELECT true AS several, true AS bounded, count(DISTINCT user_id) AS n FROM events""",

        "ingested_state": f"""WITH {_OCCUPANCY}
SELECT src, key, val FROM (
  SELECT src, key, val, row_number() OVER (PARTITION BY src, key ORDER BY seq DESC) AS rn
  FROM log WHERE src = 'student')
WHERE rn = 1 AND val IS NOT NULL""",

        "stream_counts": f"""WITH {_OCCUPANCY}, {_ALERTS}
SELECT count(*) AS alerts, count(CASE WHEN value = 'OK' THEN 1 END) AS recoveries
FROM al WHERE value IS NOT NULL""",

        "stream_state": f"""WITH {_OCCUPANCY}
SELECT src, key, val FROM (
  SELECT src, key, val, row_number() OVER (PARTITION BY src, key ORDER BY seq DESC) AS rn FROM log)
WHERE rn = 1 AND val IS NOT NULL
UNION ALL
SELECT 'count' AS src, room AS key, CAST(arg_max(cnt, seq * 2 + sub) AS VARCHAR) AS val
FROM tl WHERE delta <> 0 GROUP BY room""",

        "stream_monitor": f"""WITH {_OCCUPANCY}, {_ALERTS}
SELECT 'student' AS name, count(*) AS n FROM log WHERE src = 'student'
UNION ALL SELECT 'capacity', count(*) FROM log WHERE src = 'class'
UNION ALL SELECT 'count', count(*) FROM tl WHERE delta <> 0
UNION ALL SELECT 'joined', count(*) FROM status
UNION ALL SELECT 'alert', count(*) FROM al WHERE value IS NOT NULL
UNION ALL SELECT 'recovery', count(*) FROM al WHERE value = 'OK'""",

        "op_report_total": _report(""),

        "op_pairing": f"""WITH {_OPLOG}
SELECT tid, op, k, v, start, finish, status FROM pairs""",

        "json_pairing": f"""WITH {_OPLOG.replace("FROM oplog WINDOW", f"FROM oplog WHERE {_LINE_STATE} = 'ok' WINDOW")}
SELECT tid, op, k, v, start, finish, status FROM pairs""",

        "json_bad_lines": f"""WITH {_OPLOG}
SELECT {_LINE_STATE} AS state, count(*) AS n FROM oplog GROUP BY 1""",

        "op_report": _report("op"),

        "op_report_by_thread": _report("tid"),

        "history_check": f"""WITH {_OPLOG}, {_HISTORY}
SELECT k, v, score, reason, other FROM checked""",

        "history_summary": f"""WITH {_OPLOG}, {_HISTORY}
SELECT score, count(*) AS n FROM checked GROUP BY score""",

        "salted_digest": f"""
SELECT doc_id, {_DIGEST} AS digest FROM documents""",

        "verify_digest": f"""
WITH st AS (
  SELECT doc_id,
         CASE WHEN doc_id % 11 = 0 THEN substr({_DIGEST}, 1, 40) ELSE {_DIGEST} END AS digest
  FROM documents),
vals AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || '.' ELSE text END AS text FROM documents),
j AS (
  SELECT st.doc_id, st.digest, vals.text,
         regexp_full_match(st.digest, '\\$s2\\$[0-9a-f]+\\$[0-9a-f]{{64}}') AS good
  FROM st LEFT JOIN vals ON vals.doc_id = st.doc_id)
SELECT doc_id,
       CASE WHEN good THEN
         sha256(regexp_extract(digest, '^\\$s2\\$([0-9a-f]+)\\$', 1) || text)
           = regexp_extract(digest, '\\$([0-9a-f]{{64}})$', 1)
       END AS ok,
       NOT good AS malformed
FROM j""",

        "output_check": """
WITH a AS (SELECT o_orderpriority || ',' || o_orderstatus AS line FROM orders WHERE o_orderkey % 3 <> 0),
b AS (SELECT o_orderpriority || ',' || o_orderstatus AS line FROM orders WHERE o_orderkey % 3 <> 1),
c AS (SELECT * FROM a UNION ALL (SELECT line FROM a ORDER BY line LIMIT 1)),
sides AS (
  SELECT 'reordered' AS pair, line, 1 AS l, 1 AS r FROM a
  UNION ALL SELECT 'slices', line, 1, 0 FROM a UNION ALL SELECT 'slices', line, 0, 1 FROM b
  UNION ALL SELECT 'repeated', line, 1, 0 FROM a UNION ALL SELECT 'repeated', line, 0, 1 FROM c),
net AS (SELECT pair, line, sum(l) AS l, sum(r) AS r FROM sides GROUP BY ALL)
SELECT pair, bool_and(l = r) AS equal, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right,
       CAST(sum(abs(l - r)) AS BIGINT) AS n_diff
FROM net GROUP BY pair""",

        "hash_audit": f"""WITH {_HASHES}
SELECT class,
       CASE WHEN class IN ('BAD_VERSION', 'BAD_REVISION', 'MISSING_ROUNDS') THEN NULL
            ELSE rounds END AS cost,
       count(*) AS n
FROM c GROUP BY 1, 2""",
    }
