"""Independent SQL for every registered query (DuckDB dialect).

Written directly from the semantics, not generated from the Spark plans:
views ``customer``, ``nation``, ``orders``, ``events``, ``region`` are the
driver's parquet tables.
"""

from __future__ import annotations

from lakevault.plans.customer import CODE_NOT_AVAILABLE, NOT_DEFINED, NOT_RECORDED, STATE_NOT_RECORDED
from lakevault.plans.queries import (
    DIM_OLD_TS,
    HUB_OLD_TS,
    LOAD_TS,
    ORDERS_SPLIT,
)

SEP = "chr(31)"

# The derived customer snapshot (same expressions as testdata.customer_snapshot).
FIXTURE = """
fx AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 97 = 96 THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS customer_id,
    CASE WHEN c_custkey % 11 = 0 THEN '  ' WHEN c_custkey % 13 = 0 THEN NULL ELSE substr(c_name, 1, 8) END AS first_name,
    substr(c_name, 10) AS last_name,
    concat(n_name, ' ', CAST(c_custkey % 100 AS VARCHAR)) AS street,
    n_name AS city,
    substr(c_mktsegment, 1, 2) AS state,
    CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 0
         ELSE CAST(10000 + c_custkey AS INTEGER) END AS zip_code,
    CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'NULL'
         WHEN c_custkey % 31 = 0 THEN concat('9163', lpad(CAST(c_custkey AS VARCHAR), 6, '0'))
         WHEN c_custkey % 37 = 0 THEN '(916) abc'
         ELSE concat('(', CAST(100 + c_nationkey AS VARCHAR), ') ', lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0'), '-',
                     lpad(CAST((c_custkey * 7) % 10000 AS VARCHAR), 4, '0')) END AS phone,
    CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN 'NULL'
         ELSE concat('c', CAST(c_custkey AS VARCHAR), '@example.com') END AS email
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


def _clean(prefix: str = "") -> str:
    p = prefix
    return f"""
    coalesce(nullif(trim({p}first_name), ''), '{NOT_RECORDED}') AS Nombre,
    coalesce(nullif(trim({p}last_name), ''), '{NOT_RECORDED}') AS Apellido,
    coalesce(nullif(trim({p}street), ''), '{NOT_RECORDED}') AS CalleUbicacion,
    coalesce(nullif(trim({p}city), ''), '{NOT_RECORDED}') AS CiudadUbicacion,
    coalesce(nullif(trim({p}state), ''), '{STATE_NOT_RECORDED}') AS CodigoEstadoUbicacion,
    coalesce(CASE WHEN {p}zip_code <= 0 THEN NULL ELSE {p}zip_code END, -1) AS CodigoPostalUbicacion"""


def _txt(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), '')"


EVENT_BUCKET = "CAST(floor(value / 10) AS BIGINT)"
EVENT_HK = "sha256(CAST(user_id AS VARCHAR))"
EVENT_HD = f"sha256(concat_ws({SEP}, CAST(user_id AS VARCHAR), {_txt('event_type')}, {_txt(EVENT_BUCKET)}))"


def _satellite_events(mode: str) -> str:
    if mode == "ever_seen":
        hist = "h AS (SELECT hk, hd FROM hist)"
    else:
        hist = """h AS (SELECT hk, hd FROM (
            SELECT hk, hd, row_number() OVER (PARTITION BY hk ORDER BY load_ts DESC, hd ASC) AS rn FROM hist
        ) WHERE rn = 1)"""
    return f"""
WITH s AS (
  SELECT DISTINCT {EVENT_HK} AS hk, {EVENT_HD} AS hd, user_id, event_type, {EVENT_BUCKET} AS value_bucket
  FROM events
  WHERE user_id IS NOT NULL AND ts >= TIMESTAMP '2024-01-20 00:00:00'
),
hist AS (
  SELECT DISTINCT {EVENT_HK} AS hk, {EVENT_HD} AS hd, ts AS load_ts
  FROM events WHERE user_id IS NOT NULL AND ts < TIMESTAMP '2024-01-20 00:00:00'
),
{hist}
SELECT s.hk, s.hd, s.user_id, s.event_type, s.value_bucket, '{LOAD_TS}' AS load_ts, 'events' AS record_source
FROM s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.hk = s.hk AND h.hd = s.hd)
"""


_HUB_CTE = f"""
WITH old_keys AS (
  SELECT DISTINCT o_custkey AS customer_key FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderdate < TIMESTAMP '{ORDERS_SPLIT}'
),
new_keys AS (
  SELECT DISTINCT o_custkey AS customer_key FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderdate >= TIMESTAMP '{ORDERS_SPLIT}'
    AND o_custkey NOT IN (SELECT customer_key FROM old_keys)
)"""

_DIM_CTE = f"""
WITH src AS (
  SELECT c_custkey AS customer_key, c_name AS name, c_mktsegment AS segment, n_name AS nation
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
dim AS (
  SELECT row_number() OVER (ORDER BY customer_key) AS dim_id, customer_key, name,
         CASE WHEN customer_key % 4 = 0 THEN 'OLD' ELSE segment END AS segment, nation,
         '{DIM_OLD_TS}' AS load_ts
  FROM src WHERE customer_key % 10 <> 0
  UNION ALL
  SELECT -1, -1, 'unknown', 'unknown', 'unknown', '{DIM_OLD_TS}'
),
changed AS (
  SELECT d.dim_id, d.customer_key, coalesce(s.name, d.name) AS name, coalesce(s.segment, d.segment) AS segment,
         coalesce(s.nation, d.nation) AS nation, '{LOAD_TS}' AS load_ts
  FROM dim d JOIN src s ON d.customer_key = s.customer_key
  WHERE coalesce(s.name, d.name) IS DISTINCT FROM d.name
     OR coalesce(s.segment, d.segment) IS DISTINCT FROM d.segment
     OR coalesce(s.nation, d.nation) IS DISTINCT FROM d.nation
),
new_rows AS (
  SELECT (SELECT coalesce(max(dim_id), 0) FROM dim WHERE dim_id >= 1)
         + row_number() OVER (ORDER BY s.customer_key) AS dim_id,
         s.customer_key, s.name, s.segment, s.nation, '{LOAD_TS}' AS load_ts
  FROM src s WHERE s.customer_key NOT IN (SELECT customer_key FROM dim)
),
merged AS (
  SELECT * FROM dim WHERE customer_key NOT IN (SELECT customer_key FROM changed)
  UNION ALL SELECT * FROM changed
  UNION ALL SELECT * FROM new_rows
)"""


def _pipeline_sql() -> str:
    phone_code = "substr(phone, 1, instr(phone, ')'))"
    t1, t2 = "2024-01-19 06:00:00", "2024-01-20 06:00:00"
    return f"""
WITH {FIXTURE.strip()},
d1 AS (
  SELECT customer_id, first_name, last_name, street,
         CASE WHEN c_custkey % 5 = 0 THEN concat(city, '_OLD') ELSE city END AS city, state, zip_code,
         CASE WHEN c_custkey % 6 = 0 THEN '(999) 000-0000' ELSE phone END AS phone
  FROM fx WHERE c_custkey % 7 <> 0 OR customer_id IS NULL
),
d2 AS (SELECT customer_id, first_name, last_name, street, city, state, zip_code, phone FROM fx),
g AS (
  SELECT 1 AS day, customer_id, {_clean()} FROM d1 WHERE customer_id IS NOT NULL
  UNION ALL
  SELECT 2 AS day, customer_id, {_clean()} FROM d2 WHERE customer_id IS NOT NULL
),
p AS (
  SELECT 1 AS day, customer_id, {phone_code} AS code FROM d1
  WHERE customer_id IS NOT NULL AND phone IS NOT NULL AND phone <> 'NULL'
  UNION ALL
  SELECT 2 AS day, customer_id, {phone_code} AS code FROM d2
  WHERE customer_id IS NOT NULL AND phone IS NOT NULL AND phone <> 'NULL'
),
v1 AS (
  SELECT g.customer_id, g.Nombre, g.Apellido, g.CalleUbicacion, g.CiudadUbicacion, g.CodigoEstadoUbicacion,
         g.CodigoPostalUbicacion, CASE WHEN p.code = '' THEN '{CODE_NOT_AVAILABLE}' ELSE p.code END AS code
  FROM g JOIN p ON g.customer_id = p.customer_id AND g.day = 1 AND p.day = 1
),
gl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY day DESC) AS rn FROM g) WHERE rn = 1),
pl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY day DESC) AS rn FROM p) WHERE rn = 1),
v2 AS (
  SELECT gl.customer_id, gl.Nombre, gl.Apellido, gl.CalleUbicacion, gl.CiudadUbicacion, gl.CodigoEstadoUbicacion,
         gl.CodigoPostalUbicacion, CASE WHEN pl.code = '' THEN '{CODE_NOT_AVAILABLE}' ELSE pl.code END AS code
  FROM gl JOIN pl ON gl.customer_id = pl.customer_id
),
dim1 AS (SELECT row_number() OVER (ORDER BY customer_id) AS id, v1.*, '{t1}' AS ts FROM v1),
upd AS (
  SELECT d.id, d.customer_id,
         v2.customer_id IS NOT NULL AND (
           v2.Nombre <> d.Nombre OR v2.Apellido <> d.Apellido OR v2.CalleUbicacion <> d.CalleUbicacion
           OR v2.CiudadUbicacion <> d.CiudadUbicacion OR v2.CodigoEstadoUbicacion <> d.CodigoEstadoUbicacion
           OR v2.CodigoPostalUbicacion <> d.CodigoPostalUbicacion OR v2.code <> d.code) AS chg,
         d.Nombre AS o1, d.Apellido AS o2, d.CalleUbicacion AS o3, d.CiudadUbicacion AS o4,
         d.CodigoEstadoUbicacion AS o5, d.CodigoPostalUbicacion AS o6, d.code AS o7, d.ts AS ots,
         v2.Nombre AS n1, v2.Apellido AS n2, v2.CalleUbicacion AS n3, v2.CiudadUbicacion AS n4,
         v2.CodigoEstadoUbicacion AS n5, v2.CodigoPostalUbicacion AS n6, v2.code AS n7
  FROM dim1 d LEFT JOIN v2 ON d.customer_id = v2.customer_id
),
final AS (
  SELECT id, customer_id,
         CASE WHEN chg THEN n1 ELSE o1 END AS Nombre, CASE WHEN chg THEN n2 ELSE o2 END AS Apellido,
         CASE WHEN chg THEN n3 ELSE o3 END AS CalleUbicacion, CASE WHEN chg THEN n4 ELSE o4 END AS CiudadUbicacion,
         CASE WHEN chg THEN n5 ELSE o5 END AS CodigoEstadoUbicacion,
         CASE WHEN chg THEN n6 ELSE o6 END AS CodigoPostalUbicacion,
         CASE WHEN chg THEN n7 ELSE o7 END AS code, CASE WHEN chg THEN '{t2}' ELSE ots END AS ts
  FROM upd
  UNION ALL
  SELECT (SELECT coalesce(max(id), 0) FROM dim1) + row_number() OVER (ORDER BY customer_id),
         customer_id, Nombre, Apellido, CalleUbicacion, CiudadUbicacion, CodigoEstadoUbicacion,
         CodigoPostalUbicacion, code, '{t2}'
  FROM v2 WHERE customer_id NOT IN (SELECT customer_id FROM dim1)
  UNION ALL
  SELECT -1, -1, '{NOT_DEFINED}', '{NOT_DEFINED}', '{NOT_DEFINED}', '{NOT_DEFINED}', '{CODE_NOT_AVAILABLE}', -1, '{CODE_NOT_AVAILABLE}', '{t1}'
)
SELECT CAST(id AS INTEGER) AS DimClienteId, CAST(customer_id AS INTEGER) AS LlaveNegocioIdCliente,
       Nombre, Apellido, CalleUbicacion, CiudadUbicacion, CodigoEstadoUbicacion,
       CAST(CodigoPostalUbicacion AS INTEGER) AS CodigoPostalUbicacion, code AS CodigoPaisTelefono,
       ts AS FechaRegistro
FROM final
"""


def _stage_general() -> str:
    parts = ", ".join(
        ["CAST(customer_id AS VARCHAR)", "Nombre", "Apellido", "CalleUbicacion", "CiudadUbicacion",
         "CodigoEstadoUbicacion", "CAST(CodigoPostalUbicacion AS VARCHAR)"]
    )
    return f"""
WITH {FIXTURE.strip()},
c AS (SELECT customer_id, {_clean()} FROM fx WHERE customer_id IS NOT NULL)
SELECT DISTINCT sha256(CAST(customer_id AS VARCHAR)) AS Hk_Clientes, sha256(concat_ws({SEP}, {parts})) AS Hk_Diff,
       Nombre, Apellido, CalleUbicacion, CiudadUbicacion, CodigoEstadoUbicacion, CodigoPostalUbicacion
FROM c
"""


def _stage_phone() -> str:
    return f"""
WITH {FIXTURE.strip()},
c AS (
  SELECT coalesce(customer_id, -1) AS k, substr(phone, 1, instr(phone, ')')) AS area,
         replace(substr(phone, instr(phone, ')') + 1, 25), '-', '') AS rest
  FROM fx WHERE phone IS NOT NULL AND phone <> 'NULL'
)
SELECT DISTINCT sha256(CAST(k AS VARCHAR)) AS Hk_Clientes,
       sha256(concat_ws({SEP}, CAST(k AS VARCHAR), area, rest)) AS Hk_Diff,
       area AS CodigoPais, coalesce(TRY_CAST(rest AS INTEGER), -1) AS NumeroTelefono
FROM c
"""


def _stage_email() -> str:
    return f"""
WITH {FIXTURE.strip()},
c AS (
  SELECT coalesce(customer_id, -1) AS k, coalesce(email, '{NOT_DEFINED}') AS e
  FROM fx WHERE email IS NOT NULL OR email <> 'NULL'
)
SELECT DISTINCT sha256(CAST(k AS VARCHAR)) AS Hk_Clientes, sha256(concat_ws({SEP}, CAST(k AS VARCHAR), e)) AS Hk_Diff,
       e AS CorreoElectronico
FROM c
"""


def _pipeline_satellite(stage: str, columns: str, t1: str = "2024-01-19 00:00:00", t2: str = "2024-01-20 00:00:00") -> str:
    """The stored rows after two days: a state seen on day 1 isn't stored again."""
    return f"""
WITH {FIXTURE.strip()},
snap AS (
  SELECT 1 AS day, customer_id, CASE WHEN c_custkey % 6 = 0 THEN '(999) 000-0000' ELSE phone END AS phone, email FROM fx
  WHERE c_custkey % 7 <> 0 OR customer_id IS NULL
  UNION ALL SELECT 2, customer_id, phone, email FROM fx
),
c AS (SELECT DISTINCT day, coalesce(customer_id, -1) AS k, {stage}),
n AS (SELECT * FROM c WHERE day = 1 UNION ALL
      SELECT * FROM c WHERE day = 2 AND NOT EXISTS (SELECT 1 FROM c o WHERE o.day = 1 AND o.k = c.k AND o.state = c.state))
SELECT sha256(CAST(k AS VARCHAR)) AS Hk_Clientes, CASE day WHEN 1 THEN '{t1}' ELSE '{t2}' END AS FechaRegistro,
       {columns}, 'bronze/customers' AS FuenteDatos
FROM n
"""


_DAMAGED = """
  SELECT event_id, CAST(year(ts) AS VARCHAR) AS y,
    CASE WHEN event_id % 77 = 0 THEN '13' WHEN event_id % 91 = 0 THEN 'x' ELSE CAST(month(ts) AS VARCHAR) END AS m,
    CASE WHEN event_id % 50 = 0 THEN '32' WHEN event_id % 83 = 0 THEN NULL ELSE CAST(day(ts) AS VARCHAR) END AS d
  FROM events"""


ORACLE_SQL: dict[str, str] = {
    "snapshot_latest": """
WITH w AS (
  SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-20'
)
SELECT event_id, user_id, event_type, strftime(d, '%Y-%m-%d') AS snapshot_date
FROM w WHERE d = (SELECT max(d) FROM w)
""",
    "snapshot_empty_window": """
WITH w AS (
  SELECT CAST(ts AS DATE) AS d FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2023-12-26' AND DATE '2023-12-31'
)
SELECT count(*) AS n_rows FROM w WHERE d = (SELECT max(d) FROM w)
""",
    "hub_new_keys": _HUB_CTE
    + f"""
SELECT sha256(CAST(customer_key AS VARCHAR)) AS hk, customer_key, '{LOAD_TS}' AS load_ts, 'orders' AS record_source
FROM new_keys
""",
    "hub_merged": _HUB_CTE
    + f"""
SELECT sha256(CAST(customer_key AS VARCHAR)) AS hk, customer_key, '{HUB_OLD_TS}' AS load_ts, 'orders' AS record_source
FROM old_keys
UNION ALL
SELECT sha256(CAST(customer_key AS VARCHAR)) AS hk, customer_key, '{LOAD_TS}' AS load_ts, 'orders' AS record_source
FROM new_keys
""",
    "hash_key_256": "SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS hk FROM customer",
    "hash_diff_256": f"""
SELECT c_custkey,
       sha256(concat_ws({SEP}, {_txt('c_custkey')}, {_txt('c_name')}, {_txt('c_mktsegment')}, {_txt('c_nationkey')})) AS hd
FROM customer
""",
    "clean_attributes": f"""
WITH {FIXTURE.strip()}
SELECT c_custkey, customer_id,
  coalesce(nullif(trim(first_name), ''), '{NOT_RECORDED}') AS first_name,
  coalesce(nullif(trim(last_name), ''), '{NOT_RECORDED}') AS last_name,
  coalesce(nullif(trim(street), ''), '{NOT_RECORDED}') AS street,
  coalesce(nullif(trim(city), ''), '{NOT_RECORDED}') AS city,
  coalesce(nullif(trim(state), ''), '{STATE_NOT_RECORDED}') AS state,
  coalesce(CASE WHEN zip_code <= 0 THEN NULL ELSE zip_code END, -1) AS zip_code
FROM fx
""",
    "split_phone": f"""
WITH {FIXTURE.strip()}
SELECT c_custkey, coalesce(customer_id, -1) AS customer_id,
  substr(phone, 1, instr(phone, ')')) AS area_code,
  replace(substr(phone, instr(phone, ')') + 1, 25), '-', '') AS phone_rest,
  coalesce(TRY_CAST(replace(substr(phone, instr(phone, ')') + 1, 25), '-', '') AS INTEGER), -1) AS phone_number
FROM fx WHERE phone IS NOT NULL AND phone <> 'NULL'
""",
    "null_tokens_and": f"""
WITH {FIXTURE.strip()}
SELECT c_custkey, phone FROM fx WHERE phone IS NOT NULL AND phone != 'NULL'
""",
    "null_tokens_or": f"""
WITH {FIXTURE.strip()}
SELECT c_custkey, email FROM fx WHERE email IS NOT NULL OR email != 'NULL'
""",
    "latest_per_key": """
SELECT user_id, event_id, event_type FROM (
  SELECT user_id, event_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id ASC) AS rn
  FROM events
) WHERE rn = 1
""",
    "satellite_new_ever_seen": _satellite_events("ever_seen"),
    "satellite_new_latest": _satellite_events("latest"),
    "general_stage": _stage_general(),
    "phone_stage": _stage_phone(),
    "email_stage": _stage_email(),
    "current_entity_view": f"""
WITH hub AS (SELECT DISTINCT c_custkey AS customer_key FROM customer WHERE c_custkey IS NOT NULL),
os AS (
  SELECT DISTINCT sha256(CAST(o_custkey AS VARCHAR)) AS hk,
         sha256(concat_ws({SEP}, CAST(o_custkey AS VARCHAR), {_txt('o_orderstatus')}, {_txt('o_orderpriority')})) AS hd,
         o_orderdate AS load_ts, o_orderstatus, o_orderpriority
  FROM orders WHERE o_custkey IS NOT NULL
),
ol AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hk ORDER BY load_ts DESC, hd ASC) AS rn FROM os) WHERE rn = 1),
es AS (
  SELECT DISTINCT {EVENT_HK} AS hk, {EVENT_HD} AS hd, ts AS load_ts, event_type, {EVENT_BUCKET} AS value_bucket
  FROM events WHERE user_id IS NOT NULL
),
el AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hk ORDER BY load_ts DESC, hd ASC) AS rn FROM es) WHERE rn = 1)
SELECT sha256(CAST(h.customer_key AS VARCHAR)) AS hk, h.customer_key,
       ol.o_orderstatus AS last_order_status, ol.o_orderpriority AS last_order_priority,
       el.event_type AS last_event_type, el.value_bucket AS last_value_bucket
FROM hub h
JOIN ol ON ol.hk = sha256(CAST(h.customer_key AS VARCHAR))
JOIN el ON el.hk = sha256(CAST(h.customer_key AS VARCHAR))
""",
    "scd1_changed": _DIM_CTE + "\nSELECT * FROM changed",
    "scd1_new": _DIM_CTE + "\nSELECT * FROM new_rows",
    "scd1_delta": _DIM_CTE + "\nSELECT * FROM changed UNION ALL SELECT * FROM new_rows",
    "scd1_merged": _DIM_CTE + "\nSELECT * FROM merged",
    "unknown_member": _DIM_CTE
    + "\nSELECT count(*) AS total_rows, count(*) FILTER (WHERE dim_id = -1) AS unknown_rows FROM dim",
    "max_surrogate_key": _DIM_CTE + "\nSELECT CAST(coalesce(max(dim_id), 0) AS BIGINT) AS max_id FROM dim WHERE dim_id >= 1",
    "hash_diff_compat": """
SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR) || c_name || c_mktsegment || CAST(c_nationkey AS VARCHAR)) AS hd FROM customer
""",
    "surrogate_keys": """
SELECT l_orderkey, 100 + row_number() OVER (ORDER BY l_orderkey) AS order_id FROM (SELECT DISTINCT l_orderkey FROM lineitem)
""",
    "param_lookup": """
SELECT max(CASE WHEN r_name = 'AFRICA' THEN CAST(r_regionkey AS VARCHAR) END) AS "AFRICA",
       max(CASE WHEN r_name = 'ASIA' THEN CAST(r_regionkey AS VARCHAR) END) AS "ASIA",
       max(CASE WHEN r_name = 'EUROPE' THEN CAST(r_regionkey AS VARCHAR) END) AS "EUROPE"
FROM region
""",
    "pipeline_dimension": _pipeline_sql(),
    "dimension_incremental": _pipeline_sql(),
    "dimension_pit": _pipeline_sql(),
    "pipeline_sat_phone": _pipeline_satellite(
        """substr(phone, 1, instr(phone, ')')) AS code, replace(substr(phone, instr(phone, ')') + 1, 25), '-', '') AS rest,
       concat(code, rest) AS state FROM snap WHERE phone IS NOT NULL AND phone <> 'NULL'""",
        "code AS CodigoPais, coalesce(TRY_CAST(rest AS INTEGER), -1) AS NumeroTelefono",
    ),
    "pipeline_sat_email": _pipeline_satellite("email AS state FROM snap WHERE email IS NOT NULL", "state AS CorreoElectronico"),
    "hub_lineage": f"""
SELECT sha256(CAST(k AS VARCHAR)) AS hk, k AS customer_key, '{LOAD_TS}' AS load_ts, min(f) AS record_source
FROM (SELECT o_custkey AS k, 'orders.parquet' AS f FROM orders UNION ALL SELECT user_id, 'events.parquet' FROM events)
WHERE k IS NOT NULL GROUP BY k
""",
    "snapshot_rejects": f"""
WITH x AS ({_DAMAGED.strip()})
SELECT event_id, concat(coalesce(y, ''), '-', coalesce(m, ''), '-', coalesce(d, '')) AS snapshot_text,
       CASE WHEN d IS NULL THEN 'part missing' WHEN m = 'x' THEN 'part is no number' WHEN m = '13' THEN 'no such month'
            ELSE 'no such day' END AS reason, '{LOAD_TS}' AS load_ts
FROM x WHERE d IS NULL OR m IN ('x', '13') OR d = '32'
""",
    "scd1_partitioned": _DIM_CTE + "\nSELECT * FROM merged",
}
# a table kept up to date load by load gives the view of the whole history
ORACLE_SQL["pit_view"] = ORACLE_SQL["current_entity_view"]
# other layouts and ways to read, the same rows
ORACLE_SQL["hub_ranged"] = ORACLE_SQL["hub_merged"]
ORACLE_SQL["hub_selective"] = ORACLE_SQL["hub_new_keys"]
ORACLE_SQL["snapshot_by_folder"] = ORACLE_SQL["snapshot_latest"]
