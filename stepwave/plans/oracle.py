"""The registered queries as plain SQL, written independently of the Spark plans."""

from __future__ import annotations

DAY_MS = 86_400_000
READINGS = """
base AS (
  SELECT event_id AS "index", CAST(user_id AS VARCHAR) AS "userID", epoch_us(ts) // 1000 AS "timeMs",
         value AS "accX", CAST(json_extract_string(props, '$.k') AS DOUBLE) AS "accY",
         CAST(event_id % 97 AS DOUBLE) AS "accZ", event_type
  FROM events),
r AS (SELECT *, sqrt("accX" * "accX" + "accY" * "accY" + "accZ" * "accZ") AS "vSum" FROM base)"""

LIFECYCLE = """
e AS (
  SELECT event_id AS "index", CAST(user_id AS VARCHAR) AS "userID", epoch_us(ts) // 1000 AS "timeMs",
         CASE event_type WHEN 'signup' THEN 'connect' WHEN 'error' THEN 'stop'
                         WHEN 'view' THEN 'inference' ELSE 'point' END AS kind
  FROM events),
n AS (
  SELECT *,
         count(*) FILTER (kind = 'stop') OVER before AS session_no,
         max(CASE WHEN kind = 'point' THEN "timeMs" END) OVER before AS last_point,
         max(CASE WHEN kind = 'stop' THEN "timeMs" END) OVER before AS last_stop,
         count(*) FILTER (kind = 'stop') OVER (PARTITION BY "userID") AS n_stops
  FROM e
  WINDOW before AS (PARTITION BY "userID" ORDER BY "timeMs", "index" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (
  SELECT *, last_point IS NOT NULL AND (last_stop IS NULL OR last_point > last_stop) AS online FROM n)"""


def r6(expression: str) -> str:
    return f"round({expression} + 1e-9, 6)"


def with_readings(body: str, *parts: str) -> str:
    return "WITH RECURSIVE " + ",".join((READINGS, *parts)) + body


def with_lifecycle(body: str) -> str:
    return "WITH " + LIFECYCLE + body


def maxima(scope_ms: int | None = None, skip: bool = True, time: str = '"timeMs"', index: str = '"index"') -> str:
    scope = "CAST(0 AS BIGINT)" if scope_ms is None else f'"timeMs" // {scope_ms}'
    kept = "WHERE pos NOT IN (0, 3)" if skip else ""
    return f"""
t AS (SELECT * REPLACE ({time} AS "timeMs", {index} AS "index") FROM r),
o AS (
  SELECT *, {scope} AS scope,
         row_number() OVER (PARTITION BY {scope}, "userID" ORDER BY "timeMs", "index") - 1 AS pos
  FROM t),
l AS (
  SELECT *, lag("vSum") OVER w AS v1, lead("vSum") OVER w AS v3 FROM o {kept}
  WINDOW w AS (PARTITION BY scope, "userID" ORDER BY "timeMs", "index")),
m AS (
  SELECT *, row_number() OVER (PARTITION BY scope, "userID" ORDER BY "timeMs", "index") AS mk
  FROM l WHERE v1 < "vSum" AND v3 < "vSum")"""


def peaks(gap: int = 1000, scope_ms: int | None = None, time: str = '"timeMs"', index: str = '"index"') -> str:
    return maxima(scope_ms, time=time, index=index) + f""",
x AS (
  SELECT *, min(mk) OVER (PARTITION BY scope, "userID" ORDER BY "timeMs"
                          RANGE BETWEEN {gap + 1} FOLLOWING AND UNBOUNDED FOLLOWING) AS hit FROM m),
chain AS (
  SELECT scope, "userID", hit AS mk FROM x WHERE mk = 1 AND hit IS NOT NULL
  UNION ALL
  SELECT x.scope, x."userID", x.hit FROM chain c
  JOIN x ON x.scope = c.scope AND x."userID" = c."userID" AND x.mk = c.mk + 1 WHERE x.hit IS NOT NULL),
p AS (
  SELECT x.*, row_number() OVER (PARTITION BY x.scope, x."userID" ORDER BY x.mk) AS cycle
  FROM chain JOIN x USING (scope, "userID", mk))"""


def segment_rows(gap: int = 1000, scope_ms: int | None = None, time: str = '"timeMs"') -> str:
    return peaks(gap, scope_ms, time) + """,
g AS (
  SELECT o.*, a.cycle AS segment_no FROM p a
  JOIN p b ON b.scope = a.scope AND b."userID" = a."userID" AND b.cycle = a.cycle + 2
  JOIN o ON o.scope = a.scope AND o."userID" = a."userID" AND o.pos > a.pos AND o.pos <= b.pos),
gs AS (
  SELECT *, min("timeMs") OVER w AS first_ms, max("timeMs") OVER w AS last_ms FROM g
  WINDOW w AS (PARTITION BY scope, "userID", segment_no))"""


def grid(gap: int = 1000, scope_ms: int | None = None) -> str:
    def fill(axis: str) -> str:
        return f"""CASE WHEN b0 = k THEN {axis}0 ELSE {axis}0 + ({axis}1 - {axis}0) * ((k - b0) / (b1 - b0)) END AS "acc{axis.upper()}\""""

    return segment_rows(gap, scope_ms) + f""",
w0 AS (
  SELECT *, (last_ms - first_ms) // 128 AS bin_ms, first_ms - first_ms % {DAY_MS} AS day0 FROM gs),
bins AS (
  SELECT scope, "userID", segment_no, ("timeMs" - day0) // bin_ms - (first_ms - day0) // bin_ms AS k,
         avg("accX") AS x, avg("accY") AS y, avg("accZ") AS z
  FROM w0 WHERE bin_ms > 0 GROUP BY ALL),
slots AS (
  SELECT scope, "userID", segment_no, unnest(generate_series(0, max(k))) AS k
  FROM bins GROUP BY scope, "userID", segment_no),
filled AS (
  SELECT s.scope, s."userID", s.segment_no, s.k,
         last_value(CASE WHEN b.k IS NOT NULL THEN b.k END IGNORE NULLS) OVER lo AS b0,
         last_value(x IGNORE NULLS) OVER lo AS x0, last_value(y IGNORE NULLS) OVER lo AS y0,
         last_value(z IGNORE NULLS) OVER lo AS z0,
         first_value(CASE WHEN b.k IS NOT NULL THEN b.k END IGNORE NULLS) OVER hi AS b1,
         first_value(x IGNORE NULLS) OVER hi AS x1, first_value(y IGNORE NULLS) OVER hi AS y1,
         first_value(z IGNORE NULLS) OVER hi AS z1
  FROM slots s LEFT JOIN bins b ON b.scope = s.scope AND b."userID" = s."userID"
       AND b.segment_no = s.segment_no AND b.k = s.k
  WINDOW lo AS (PARTITION BY s.scope, s."userID", s.segment_no ORDER BY s.k
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         hi AS (PARTITION BY s.scope, s."userID", s.segment_no ORDER BY s.k
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
f AS (
  SELECT scope, "userID", segment_no, CAST(k AS INTEGER) AS k, {fill('x')}, {fill('y')}, {fill('z')}
  FROM filled WHERE k < 128)"""


CENTERS = """
centers AS (
  SELECT CAST(CAST("userID" AS BIGINT) % 3 + 1 AS INTEGER) AS class, k,
         avg("accX") AS cx, avg("accY") AS cy, avg("accZ") AS cz FROM f GROUP BY 1, 2)"""

SCORES = CENTERS + """,
d AS (
  SELECT "userID", segment_no, class,
         sum(("accX" - cx) ** 2 + ("accY" - cy) ** 2 + ("accZ" - cz) ** 2) AS d2
  FROM f JOIN centers USING (k) GROUP BY ALL),
w AS (
  SELECT *, exp(min(d2) OVER (PARTITION BY "userID", segment_no) - d2) AS e FROM d),
pr AS (SELECT *, e / sum(e) OVER (PARTITION BY "userID", segment_no) AS pc FROM w),
best AS (
  SELECT "userID", segment_no, class AS inferred_user_id, pc AS confidency FROM pr
  QUALIFY row_number() OVER (PARTITION BY "userID", segment_no ORDER BY pc DESC, class) = 1)"""

MODEL = CENTERS + """,
cm AS (SELECT class, avg(cx) AS mx, avg(cy) AS my, avg(cz) AS mz FROM centers GROUP BY class),
sm AS (
  SELECT "userID", segment_no, avg(CAST(CAST(round("accX", 8) AS FLOAT) AS DOUBLE)) AS x,
         avg(CAST(CAST(round("accY", 8) AS FLOAT) AS DOUBLE)) AS y,
         avg(CAST(CAST(round("accZ", 8) AS FLOAT) AS DOUBLE)) AS z FROM f GROUP BY 1, 2),
lo AS (
  SELECT "userID", segment_no, class,
         0.001 * (2 * (x * mx + y * my + z * mz) - (mx * mx + my * my + mz * mz)) AS logit FROM sm, cm),
we AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY "userID", segment_no)) AS e FROM lo),
mp AS (SELECT *, e / sum(e) OVER (PARTITION BY "userID", segment_no) AS pc FROM we),
chosen AS (
  SELECT "userID", segment_no, class AS inferred_user_id, pc AS confidency FROM mp
  QUALIFY row_number() OVER (PARTITION BY "userID", segment_no ORDER BY pc DESC, class) = 1)"""

AXES3 = f"""{r6('"accX"')} AS "accX", {r6('"accY"')} AS "accY", {r6('"accZ"')} AS "accZ\""""
READING_OUT = f""" "index", "userID", "timeMs", {AXES3}, {r6('"vSum"')} AS "vSum" """
FEED_OUT = f""" "userID", "index", {r6('"vSum"')} AS "vSum", "timeMs" """
SUMS = ", ".join(f'{r6(f"""sum("{a}")""")} AS "sum_{a}"' for a in ("accX", "accY", "accZ"))


def _placed(value: str = '"{a}"') -> str:
    """Sums of the values times their places from 1."""
    return ", ".join(
        f"""round(sum(CAST({value.format(a=a)} AS DOUBLE) * (k + 1)) + 1e-7, 4) AS "placed_{a}\""""
        for a in ("accX", "accY", "accZ")
    )


SINGLE = 'CAST(round("{a}", 8) AS FLOAT)'


def _coarse_sums(value: str) -> str:
    return ", ".join(
        f'round(sum(CAST(CAST({value.format(a=a)} AS FLOAT) AS DOUBLE)), 2) AS "sum_{a}"' for a in ("accX", "accY", "accZ")
    )


def _peaks_out(gap: int) -> str:
    return with_readings(' SELECT "userID", cycle, "index", "timeMs" FROM p', peaks(gap))


def _maxima_out(skip: bool) -> str:
    return with_readings(f""" SELECT "userID", "index", "timeMs", {r6('"vSum"')} AS "vSum" FROM m""", maxima(skip=skip))


CURSORS = """
cu AS (
  SELECT CAST(user_id AS VARCHAR) AS "userID", max(epoch_us(ts) // 1000) AS read_ms FROM events
  WHERE event_type = 'error' GROUP BY 1),
un AS (SELECT r.* FROM r LEFT JOIN cu USING ("userID") WHERE read_ms IS NULL OR "timeMs" > read_ms)"""


def _front(rows: str) -> str:
    return f""" SELECT "userID", arg_min("index", "timeMs") AS "index",
      {r6('arg_min("vSum", "timeMs")')} AS "vSum", min("timeMs") AS "timeMs", count(*) AS backlog
      FROM {rows} GROUP BY "userID" """


ORACLE: dict[str, str] = {
    "parse_readings_csv": with_readings(f" SELECT {READING_OUT} FROM r"),
    "parse_quarantine": """
        SELECT event_id, CASE WHEN event_type = 'signup' THEN 'not a number' ELSE 'missing' END AS problem
        FROM events WHERE event_type IN ('error', 'signup', 'view')""",
    "parse_damaged_good": with_readings(f" SELECT {READING_OUT} FROM r WHERE event_type IN ('click', 'purchase')"),
    "line_keys": 'SELECT CAST(user_id AS VARCHAR) AS "userID", count(*) AS n_lines FROM events GROUP BY 1',
    "envelope_points": with_readings(
        f""" SELECT "userID" AS uuid, 1 AS pos, "index", "userID", "timeMs", {r6('"vSum"')} AS "vSum"
        FROM r WHERE event_type IN ('click', 'purchase')"""
    ),
    "envelope_routes": """
        SELECT CAST(user_id AS VARCHAR) AS uuid,
               CASE event_type WHEN 'signup' THEN 'connect' WHEN 'error' THEN 'stop' WHEN 'view' THEN 'other'
                               ELSE 'gait' END AS route,
               count(*) AS n_messages
        FROM events GROUP BY 1, 2""",
    "envelope_sessions": """
        WITH j AS (
          SELECT e.event_id, CAST(e.user_id AS VARCHAR) AS "userID", event_type IN ('click', 'purchase') AS is_point,
                 CAST(json_extract_string(props, '$.k') AS DOUBLE) < 50
                   OR bool_or(event_type IN ('click', 'purchase')) OVER before AS named
          FROM events e
          WINDOW before AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        c AS (
          SELECT j.*, count(*) FILTER (event_type = 'error' AND named) OVER (PARTITION BY "userID" ORDER BY j.event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS session_no
          FROM j JOIN events USING (event_id))
        SELECT "userID", session_no, event_id AS arrival,
               row_number() OVER (PARTITION BY "userID", session_no ORDER BY event_id) AS counter
        FROM c WHERE is_point""",
    "points_xyz4": with_readings(f" SELECT {READING_OUT} FROM r"),
    "vector_norm": with_readings(f""" SELECT "index", {r6('"vSum"')} AS "vSum" FROM r"""),
    "local_maxima": _maxima_out(True),
    "local_maxima_no_warmup": _maxima_out(False),
    "cycle_peaks": _peaks_out(1000),
    "cycle_peaks_restarted": with_readings(
        ' SELECT "userID", cycle, "index", "timeMs" FROM p',
        peaks(1000, index=f"""row_number() OVER (PARTITION BY "userID", "timeMs" // {DAY_MS}
                            ORDER BY "timeMs", "index") - 1"""),
    ),
    "cycle_peaks_day_gap": _peaks_out(DAY_MS),
    "cycle_peaks_scoped": with_readings(
        ' SELECT scope, "userID", cycle, "index", "timeMs" FROM p', peaks(1000, 10 * DAY_MS)
    ),
    "cycle_strongest": with_readings(
        f""",
        c AS (
          SELECT m.scope, m."userID", (SELECT min(p.cycle) FROM p WHERE p.scope = m.scope
                 AND p."userID" = m."userID" AND p.mk >= m.mk) AS cycle, m."index", m."timeMs", m."vSum", m.mk
          FROM m)
        SELECT "userID", cycle, "index", "timeMs", {r6('"vSum"')} AS "vSum" FROM c WHERE cycle IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY scope, "userID", cycle ORDER BY c."vSum" DESC, mk) = 1""",
        peaks(DAY_MS),
    ),
    "cycle_numbers": with_readings(
        """ SELECT o."userID", o."index", o."timeMs", count(p.mk) AS cycle FROM o
        LEFT JOIN p ON p.scope = o.scope AND p."userID" = o."userID" AND p.pos < o.pos GROUP BY 1, 2, 3""",
        peaks(),
    ),
    "segments": with_readings(
        ' SELECT "userID", segment_no, "index", "timeMs", first_ms, last_ms FROM gs', segment_rows()
    ),
    "segments_scoped": with_readings(
        ' SELECT scope, "userID", segment_no, "index", "timeMs" FROM g', segment_rows(1000, 10 * DAY_MS)
    ),
    "segment_stats": with_readings(
        """ SELECT "userID", segment_no, count(*) AS n_rows, min("timeMs") AS t_first, max("timeMs") AS t_last,
        max("timeMs") - min("timeMs") AS duration_ms FROM g GROUP BY 1, 2""",
        segment_rows(DAY_MS),
    ),
    "group_counts": with_readings(
        """ SELECT "userID", count(*) AS n_peaks, greatest(count(*) - 2, 0) AS n_segments FROM p GROUP BY 1""",
        peaks(),
    ),
    "too_short_segments": with_readings(
        ' SELECT DISTINCT "userID", segment_no, first_ms, last_ms FROM gs WHERE last_ms - first_ms < 128',
        segment_rows(2, None, '"timeMs" // 4000000'),
    ),
    "resampled_long": with_readings(f' SELECT "userID", segment_no, k, {AXES3} FROM f', grid()),
    "resampled_long_day_gap": with_readings(f' SELECT "userID", segment_no, k, {AXES3} FROM f', grid(DAY_MS)),
    "resampled_vectors": with_readings(
        f""" SELECT "userID", segment_no, CAST(count(*) AS INTEGER) AS n_points, {SUMS}, {_placed()} FROM f GROUP BY 1, 2""", grid()
    ),
    "resampled_vectors_scoped": with_readings(
        f""" SELECT scope, "userID", segment_no, CAST(count(*) AS INTEGER) AS n_points, {SUMS}, {_placed()} FROM f GROUP BY 1, 2, 3""",
        grid(1000, 10 * DAY_MS),
    ),
    "vector_text": with_readings(
        f""" SELECT "userID", segment_no, CAST(count(*) AS INTEGER) AS n_points, {_coarse_sums('round("{a}", 8)')},
        {_placed(SINGLE)} FROM f GROUP BY 1, 2""",
        grid(),
    ),
    "tensor_shape": with_readings(
        f""" SELECT "userID", segment_no, CAST(count(*) AS INTEGER) AS n_points, 6 AS n_channels,
        {_coarse_sums('round("{a}", 8)')}, {_placed(SINGLE)}, CAST(0 AS DOUBLE) AS sum_zero FROM f GROUP BY 1, 2""",
        grid(),
    ),
    "class_centroids": with_readings(
        f""" SELECT class, k, {r6('cx')} AS "c_accX", {r6('cy')} AS "c_accY", {r6('cz')} AS "c_accZ" FROM centers""",
        grid(),
        CENTERS,
    ),
    "score_centroid": with_readings(
        f' SELECT "userID", segment_no, inferred_user_id, {r6("confidency")} AS confidency FROM best', grid(), SCORES
    ),
    "score_names": with_readings(
        """ SELECT "userID" AS actual_user_id, segment_no, inferred_user_id, n_name AS inferred_users_name,
        n_name IS NOT NULL AS known FROM best LEFT JOIN nation ON n_nationkey = inferred_user_id""",
        grid(),
        SCORES,
    ),
    "score_model": with_readings(
        f' SELECT "userID", segment_no, inferred_user_id, {r6("confidency")} AS confidency FROM chosen', grid(), MODEL
    ),
    "inference_names": f"""
        SELECT event_id, {r6('value / 100')} AS confidency,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS inferred_user_id,
               CAST(user_id AS VARCHAR) AS actual_user_id, n_name AS inferred_users_name, n_name IS NOT NULL AS known
        FROM events LEFT JOIN nation ON n_nationkey = CAST(json_extract_string(props, '$.k') AS INTEGER)
        WHERE event_type = 'view'""",
    "inference_accepted": with_lifecycle(
        """ SELECT "userID", "index", "timeMs", session_no FROM s WHERE kind = 'inference' AND online"""
    ),
    "inference_rejected": with_lifecycle(
        """ SELECT "userID", "index", "timeMs", session_no FROM s WHERE kind = 'inference' AND NOT online"""
    ),
    "inference_known_users": with_lifecycle(
        """, z AS (SELECT "userID", max(CASE WHEN kind = 'point' THEN "timeMs" END) AS lp,
                  max(CASE WHEN kind = 'stop' THEN "timeMs" END) AS ls FROM e GROUP BY 1)
        SELECT "userID", "index", "timeMs" FROM e JOIN z USING ("userID")
        WHERE kind = 'inference' AND lp IS NOT NULL AND (ls IS NULL OR lp > ls)"""
    ),
    "inference_unknown_users": with_lifecycle(
        """, z AS (SELECT "userID", max(CASE WHEN kind = 'point' THEN "timeMs" END) AS lp,
                  max(CASE WHEN kind = 'stop' THEN "timeMs" END) AS ls FROM e GROUP BY 1)
        SELECT "userID", "index", "timeMs" FROM e JOIN z USING ("userID")
        WHERE kind = 'inference' AND (lp IS NULL OR lp < ls)"""
    ),
    "inference_lists": with_lifecycle(
        """ SELECT "userID", "index", "timeMs", session_no,
        row_number() OVER (PARTITION BY "userID", session_no ORDER BY "timeMs", "index") AS position,
        session_no = n_stops AS open FROM s WHERE kind = 'inference' AND online"""
    ),
    "online_users": with_lifecycle(
        """ SELECT "userID", session_no, count(*) AS counter FROM s
        WHERE kind = 'point' AND session_no = n_stops GROUP BY 1, 2"""
    ),
    "online_ids": with_lifecycle(
        """ SELECT "userID" FROM e WHERE kind IN ('point', 'stop') GROUP BY 1 HAVING arg_max(kind, "timeMs") = 'point'"""
    ),
    "session_points": with_lifecycle(
        """ SELECT "userID", session_no,
        row_number() OVER (PARTITION BY "userID", session_no ORDER BY "timeMs", "index") AS counter, "index", "timeMs"
        FROM s WHERE kind = 'point'"""
    ),
    "session_messages": with_lifecycle(
        """ SELECT "userID", session_no, count(*) FILTER (kind <> 'stop') AS n_messages FROM s
        WHERE kind <> 'inference' GROUP BY 1, 2"""
    ),
    "connection_messages": with_lifecycle(
        """, m AS (SELECT DISTINCT "userID" || '-' || CAST("index" % 2 AS VARCHAR) AS uuid, "index" // 400 AS arrival, kind
                   FROM e),
        c AS (SELECT *, count(*) FILTER (kind = 'stop') OVER (PARTITION BY uuid ORDER BY arrival, kind = 'stop'
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS session_no FROM m)
        SELECT uuid, session_no, count(*) FILTER (kind <> 'stop') AS n_messages FROM c GROUP BY 1, 2"""
    ),
    "session_export_rows": with_readings(
        f""", k AS (SELECT *, "userID" || '-' || CAST("index" % 2 AS VARCHAR) AS uuid, "index" // 400 AS arrival FROM r),
        z AS (SELECT DISTINCT uuid, arrival FROM k WHERE event_type = 'error'),
        p AS (SELECT k.*, (SELECT count(*) FROM z WHERE z.uuid = k.uuid AND z.arrival < k.arrival) AS session_no
              FROM k WHERE event_type NOT IN ('signup', 'error', 'view')),
        g AS (SELECT uuid, max(arrival) AS last_stop FROM z GROUP BY 1)
        SELECT uuid, session_no, row_number() OVER (PARTITION BY uuid, session_no ORDER BY "index") AS place,
               "index", "userID", "timeMs", {r6('"accX"')} AS "accX", {r6('"accY"')} AS "accY", {r6('"accZ"')} AS "accZ",
               {r6('"vSum"')} AS "vSum"
        FROM p JOIN g USING (uuid) WHERE arrival <= last_stop"""
    ),
    "order_violations": with_readings(
        """, q AS (SELECT "index" // 20 AS message_id, "index", CAST(row_number() OVER (PARTITION BY "index" // 20
                   ORDER BY "accY", "index") - 1 AS INTEGER) AS pos FROM r),
        v AS (SELECT *, lag("index") OVER (PARTITION BY message_id ORDER BY pos) AS previous FROM q)
        SELECT message_id, pos, "index", previous FROM v WHERE "index" < previous"""
    ),
    "live_feed": with_readings(f" SELECT {FEED_OUT} FROM r"),
    "live_messages": with_readings(
        f""" SELECT "userID", "index", {r6('"vSum"')} AS xyz, CAST("timeMs" AS VARCHAR) AS timestamp FROM r"""
    ),
    "live_front": with_readings(_front("r")),
    "live_front_after_stop": with_readings(_front("un"), CURSORS),
    "live_tail": with_readings(f""" SELECT {FEED_OUT} FROM r WHERE "timeMs" > 1705363200000"""),
    "decimate_nth": with_readings(
        """ SELECT "userID", "index", "timeMs" FROM r
        QUALIFY (row_number() OVER (PARTITION BY "userID" ORDER BY "timeMs", "index") - 1) % 25 = 0"""
    ),
    "throttle_gap": with_readings(
        """ SELECT r."userID", r."index", r."timeMs" FROM sent JOIN q USING ("userID", rn) JOIN r USING ("index")""",
        """
        q AS (
          SELECT "userID", "index", row_number() OVER w AS rn,
                 min("index") OVER (PARTITION BY "userID" ORDER BY "timeMs"
                                    RANGE BETWEEN 21600000 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_index
          FROM r WINDOW w AS (PARTITION BY "userID" ORDER BY "timeMs", "index")),
        j AS (SELECT a."userID", a.rn, b.rn AS next_rn FROM q a LEFT JOIN q b ON b."index" = a.next_index),
        sent AS (
          SELECT "userID", rn FROM j WHERE rn = 1
          UNION ALL
          SELECT j."userID", j.next_rn FROM sent JOIN j USING ("userID", rn) WHERE j.next_rn IS NOT NULL)""",
    ),
    "users_sorted": 'SELECT CAST(user_id AS VARCHAR) AS "userID", count(*) AS n_readings FROM events GROUP BY 1',
    "stream_scopes": with_readings(
        ' SELECT scope, "userID", segment_no, "index", "timeMs" FROM g', segment_rows(1000, 10 * DAY_MS)
    ),
}
ORACLE["stream_sessions"] = ORACLE["session_export_rows"]
