"""The same results in DuckDB SQL, written the plain way: CTEs, windows and left joins."""

from __future__ import annotations

FEED = """
feed AS (
  SELECT c_custkey * 10 + 1 AS seq,
    '{"name":"' || CASE WHEN c_custkey % 40 = 7 THEN '' ELSE c_mktsegment END
    || '","last_name":"Fam' || (c_custkey % 1000)
    || '","sex":["' || CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END
    || '"],"telfnumber":"' || c_nationkey || '-' || c_custkey
    || '","passport":"P' || c_custkey
    || '","email":"u' || c_custkey || '@example.com"}' AS data
  FROM customer
  UNION ALL
  SELECT 1000000000 + o_orderkey * 10 + 2,
    '{"passport":"' || CASE WHEN o_orderkey % 50 = 3 THEN 'X' ELSE 'P' END || o_custkey
    || '","IBAN":"XX' || o_orderkey
    || '","salary":"' || CAST(round(o_totalprice) AS BIGINT) || '$"}'
  FROM orders
  UNION ALL
  SELECT 2000000000 + c_custkey * 10 + 3,
    '{"fullname":"  ' || upper(c_mktsegment) || ' FAM' || (c_custkey % 1000)
    || ' ","city":"' || n_name || '","address":"' || (c_custkey % 300) || ' Main St"}'
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 10 <> 0
  UNION ALL
  SELECT 3000000000 + c_custkey * 10 + 4,
    '{"fullname":"' || c_mktsegment || ' Fam' || (c_custkey % 1000)
    || '","company":"' || s_name || '","company address":"' || s_nationkey
    || ' Plaza","company_telfnumber":"T' || s_suppkey
    || '","company_email":"s' || s_suppkey || '@example.com","job":"Job' || (c_custkey % 9) || '"}'
  FROM customer JOIN supplier ON s_suppkey = c_custkey % (SELECT count(*) FROM supplier)
  WHERE c_custkey % 7 <> 0
  UNION ALL
  SELECT 4000000000 + c_custkey * 10 + 5,
    '{"address":"' || (c_custkey % 300) || ' MAIN ST","IPv4":"10.0.' || (c_custkey % 256) || '.1"}'
  FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL
  SELECT 5000000000 + c_custkey * 10 + 6,
    CASE c_custkey % 3 WHEN 0 THEN '{"foo":1}' WHEN 1 THEN '{}'
      ELSE '{"passport":null,"IBAN":"Z","salary":"1$"}' END
  FROM customer WHERE c_custkey % 100 IN (1, 2, 3)
)"""

_FIELDS = (
    "passport name last_name telfnumber email IBAN salary fullname city address IPv4 company "
    "company_telfnumber company_email job"
).split()


def _has(*keys: str) -> str:
    return " AND ".join(f"list_contains(json_keys(data), '{k}')" for k in keys)


def _stage(p: str, source: str) -> str:
    """CTEs from messages to golden records; ``p`` prefixes their names."""
    fields = ",\n    ".join(f"json_extract_string(data, '$.{f}') AS {f}" for f in _FIELDS)
    win = "PARTITION BY shape, link_key ORDER BY seq DESC"
    return f"""
{p}shaped AS (
  SELECT seq, data, {fields},
    json_extract_string(data, '$."company address"') AS company_address,
    json_extract_string(data, '$.sex[0]') AS sex,
    CASE WHEN data = '{{}}' THEN 'empty'
      WHEN {_has("passport", "name", "last_name", "sex")} THEN 'personal'
      WHEN {_has("passport", "IBAN", "salary")} THEN 'bank'
      WHEN {_has("fullname", "city", "address")} AND NOT {_has("company")} THEN 'location'
      WHEN {_has("fullname", "company", "job")} THEN 'professional'
      WHEN {_has("IPv4", "address")} AND NOT {_has("fullname")} THEN 'network'
      ELSE 'unknown' END AS shape
  FROM {source}
),
{p}valued AS (
  SELECT *, CASE WHEN shape IN ('personal', 'bank') THEN passport
    WHEN shape IN ('location', 'professional') THEN fullname
    WHEN shape = 'network' THEN address END AS link_value
  FROM {p}shaped
),
{p}msg AS (
  SELECT *, CASE WHEN coalesce(link_value, '') = '' THEN NULL
    WHEN shape IN ('personal', 'bank') THEN link_value
    ELSE lower(trim(link_value)) END AS link_key
  FROM {p}valued
),
{p}latest AS (
  SELECT * FROM {p}msg WHERE link_key IS NOT NULL
  QUALIFY row_number() OVER ({win}) = 1
),
{p}people AS (
  SELECT coalesce(p.link_key, b.link_key) AS _id,
    p.link_key IS NOT NULL AS has_personal, b.link_key IS NOT NULL AS has_bank,
    p.name, p.last_name, p.sex, p.email, p.telfnumber, b.IBAN, b.salary,
    lower(trim(coalesce(p.name, '') || ' ' || coalesce(p.last_name, ''))) AS fullname_key
  FROM (SELECT * FROM {p}latest WHERE shape = 'personal') p
  FULL JOIN (SELECT * FROM {p}latest WHERE shape = 'bank') b ON p.link_key = b.link_key
),
{p}linked AS (
  SELECT d.*, l.fullname, l.city, l.address, n.IPv4, w.company, w.company_address,
    w.company_telfnumber, w.company_email, w.job,
    l.link_key IS NOT NULL AS has_location, n.link_key IS NOT NULL AS has_network,
    w.link_key IS NOT NULL AS has_professional
  FROM {p}people d
  LEFT JOIN {p}latest l ON l.shape = 'location' AND l.link_key = d.fullname_key
    AND d.fullname_key <> ''
  LEFT JOIN {p}latest n ON n.shape = 'network' AND l.link_key IS NOT NULL
    AND n.link_key = lower(trim(coalesce(l.address, '')))
  LEFT JOIN {p}latest w ON w.shape = 'professional' AND w.link_key = d.fullname_key
    AND d.fullname_key <> ''
),
{p}candidate AS (
  SELECT *, CAST(has_personal AS INTEGER) + CAST(has_bank AS INTEGER)
      + CAST(has_location AS INTEGER) + CAST(has_network AS INTEGER)
      + CAST(has_professional AS INTEGER) AS n_sources,
    concat_ws(',', CASE WHEN has_personal THEN 'personal' END,
      CASE WHEN has_bank THEN 'bank' END, CASE WHEN has_location THEN 'location' END,
      CASE WHEN has_network THEN 'network' END,
      CASE WHEN has_professional THEN 'professional' END) AS data_sources
  FROM {p}linked
),
{p}golden AS (
  SELECT *, false AS uploaded FROM {p}candidate
  WHERE coalesce(name, '') <> '' AND coalesce(last_name, '') <> ''
)"""


BASE = "WITH" + FEED + "," + _stage("", "feed")

TWO_BATCHES = (
    "WITH"
    + FEED
    + """,
old_feed AS (
  SELECT * FROM feed WHERE seq < 3000000000 AND data NOT LIKE '%"name":"MACHINERY"%'
),
new_feed AS (
  SELECT * FROM feed WHERE seq >= 3000000000 OR data LIKE '%"name":"MACHINERY"%'
    OR data LIKE '%"sex":["F"]%'
),"""
    + _stage("", "feed")
    + ","
    + _stage("old_", "old_feed")
    + ","
    + _stage("new_", "new_feed")
)

_CONTENT = (
    "name last_name sex email telfnumber fullname city address IPv4 IBAN salary company "
    "company_address company_telfnumber company_email job"
).split()


def _content(expr="{f}") -> str:
    cols = []
    for f in _CONTENT:
        out = '"company address"' if f == "company_address" else f
        cols.append(f"{expr.format(f=f)} AS {out}")
    return ", ".join(cols)


def _golden_select(table: str, uploaded: str = "false") -> str:
    return (
        f"SELECT _id, '2024-01-01T00:00:00' AS consolidated_at, data_sources, "
        f'{uploaded} AS "uploaded_2_SQL", {_content()} FROM {table}'
    )


def _ids(*order: str, base: str = "0") -> str:
    return f"{base} + row_number() OVER (ORDER BY {', '.join(order)})"


def _tables(p: str, golden: str, mode: str = "bulk", base: str | None = None) -> str:
    """CTEs of the five tables of a golden relation; ``base`` prefixes existing ones."""

    def start(table):
        return "0" if base is None else f"(SELECT coalesce(max(id), 0) FROM {base}{table})"

    t = "coalesce({}, '')".format
    ws = r"chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

    def street(c):
        return f"trim(translate(coalesce({c}, ''), chr(10) || chr(13), '  '), {ws})"

    order = ("md5(_id)", "_id")
    if mode == "bulk":
        full_name = t("fullname")
        home = f"{street('address')}, {t('city')}, {t('IPv4')}"
        home_if = f"{t('address')} <> '' OR {t('city')} <> '' OR {t('IPv4')} <> ''"
        work_adr = f"{street('company_address')}, '', ''"
        work_adr_if = f"{t('company_address')} <> ''"
        work_if = (
            f"{t('company')} <> '' OR {t('job')} <> '' OR {t('company_telfnumber')} <> '' "
            f"OR {t('company_email')} <> ''"
        )
    else:
        full_name = "name || ' ' || last_name"
        home = f"address, coalesce(city, 'Unknown'), coalesce(nullif(IPv4, ''), '0.0.0.0')"
        home_if = f"{t('address')} <> ''"
        work_adr = "company_address, city, '0.0.0.0'"
        work_adr_if = f"{t('company_address')} <> '' AND {t('city')} <> ''"
        work_if = f"{t('company')} <> ''"
    return f"""
{p}person AS (
  SELECT {_ids(*order, base=start("person"))} AS id, _id AS passport, {t("name")} AS name,
    {t("last_name")} AS last_name, {full_name} AS full_name, {t("sex")} AS sex,
    {t("email")} AS email, {t("telfnumber")} AS phone
  FROM {golden}
),
{p}own AS (
  SELECT g.*, p.id AS person_id FROM {golden} g JOIN {p}person p ON p.passport = g._id
),
{p}bank AS (
  SELECT {_ids(*order, base=start("bank"))} AS id, person_id, {t("IBAN")} AS iban,
    {t("salary")} AS salary
  FROM {p}own WHERE {t("IBAN")} <> '' OR {t("salary")} <> ''
),
{p}work AS (
  SELECT {_ids(*order, base=start("work"))} AS id, person_id, {t("company")} AS company,
    {t("job")} AS position, {t("company_telfnumber")} AS phone, {t("company_email")} AS email
  FROM {p}own WHERE {work_if}
),
{p}places(_id, person_id, type, street_name, city, ip_address) AS (
  SELECT _id, person_id, 'Home', {home} FROM {p}own WHERE {home_if}
  UNION ALL
  SELECT _id, person_id, 'Work', {work_adr} FROM {p}own WHERE {work_adr_if}
),
{p}located AS (
  SELECT {_ids(*order, "type", base=start("address"))} AS id, * FROM {p}places
),
{p}address AS (SELECT id, street_name, city, ip_address FROM {p}located),
{p}person_address AS (SELECT id AS address_id, person_id, type FROM {p}located)"""


_PENDING = """
pending AS (SELECT * FROM golden WHERE n_sources = 5 AND uploaded IS DISTINCT FROM true)"""
_STRICT_NEW = """
strict_new AS (
  SELECT * FROM golden WHERE n_sources = 5 AND coalesce(sex, '') <> ''
    AND _id NOT IN (SELECT passport FROM old_person)
)"""
_JSON_NEW = """
json_new AS (SELECT * FROM golden WHERE _id NOT IN (SELECT passport FROM old_person))"""
_OLD_TABLES = _tables("old_", "old_golden")
_PERSON_ONLY = """
known_person AS (SELECT * FROM old_person),
known_bank AS (SELECT * FROM old_bank WHERE false),
known_work AS (SELECT * FROM old_work WHERE false),
known_address AS (SELECT * FROM old_address WHERE false)"""

_FLAT = """
SELECT p.passport AS person_passport, p.name AS person_name, p.last_name AS person_last_name,
  p.full_name AS person_full_name, p.sex AS person_sex, p.email AS person_email,
  p.phone AS person_phone, b.iban AS bank_iban, b.salary AS bank_salary,
  w.company AS work_company, w.position AS work_position, w.phone AS work_phone,
  w.email AS work_email, ha.street_name AS home_street, ha.city AS home_city,
  ha.ip_address AS home_ip, wa.street_name AS work_street, wa.city AS work_city
FROM person p
LEFT JOIN bank b ON p.id = b.person_id
LEFT JOIN work w ON p.id = w.person_id
LEFT JOIN person_address hl ON p.id = hl.person_id AND hl.type = 'Home'
LEFT JOIN address ha ON hl.address_id = ha.id
LEFT JOIN person_address wl ON p.id = wl.person_id AND wl.type = 'Work'
LEFT JOIN address wa ON wl.address_id = wa.id"""
_ALL_BANKS = """,
every_bank AS (
  SELECT p.id AS person_id, m.IBAN AS iban, m.salary
  FROM msg m JOIN person p ON p.passport = m.link_key WHERE m.shape = 'bank'
)"""
_FLAT_ALL = _FLAT.replace("LEFT JOIN bank b", "LEFT JOIN every_bank b")


def _blank(sql: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'coalesce({c}, $$$$) AS {c}' for c in _FLAT_NAMES)}) FROM ({sql})"


_FLAT_NAMES = (
    "bank_iban bank_salary work_company work_position work_phone work_email home_street "
    "home_city home_ip work_street work_city"
).split()

_COUNTS = """
  count(*) AS total_raw_messages,
  count(*) FILTER (shape = 'personal' AND link_key IS NOT NULL) AS personal_records,
  count(*) FILTER (shape = 'bank' AND link_key IS NOT NULL) AS bank_records,
  count(*) FILTER (shape = 'location' AND link_key IS NOT NULL) AS location_records,
  count(*) FILTER (shape = 'network' AND link_key IS NOT NULL) AS network_records,
  count(*) FILTER (shape = 'professional' AND link_key IS NOT NULL) AS professional_records,
  count(*) FILTER (shape = 'unknown') AS unknown_records,
  count(*) FILTER (shape = 'empty') AS empty_data_count,
  count(*) FILTER (link_key IS NOT NULL OR shape = 'empty')"""

_BULK = BASE + "," + _PENDING + "," + _tables("", "pending")
_ALL_TABLES = BASE + "," + _tables("", "golden")
_STRICT = (
    TWO_BATCHES + "," + _OLD_TABLES + "," + _STRICT_NEW + ","
    + _tables("", "strict_new", "strict", "old_")
)
_JSON = (
    TWO_BATCHES + "," + _OLD_TABLES + "," + _PERSON_ONLY + "," + _JSON_NEW + ","
    + _tables("", "json_new", "strict", "known_")
)

_STRICT_ALL = """
strict_all AS (SELECT * FROM golden WHERE n_sources = 5 AND coalesce(sex, '') <> '')"""
_COLUMNS = {
    "address": "id, street_name, city, ip_address",
    "bank": "id, person_id, iban, salary",
    "person": "id, passport, name, last_name, full_name, sex, email, phone",
    "person_address": "address_id, person_id, type",
    "work": "id, person_id, company, position, phone, email",
}
_ROWS_OF_ALL = " UNION ALL".join(
    f" SELECT '{t}' AS tab, concat_ws('|', {c}) AS content FROM {t}" for t, c in _COLUMNS.items()
)

_ENVELOPE = """
rows AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
    epoch_us(ts) // 1000 AS ts_ms, CAST(user_id AS VARCHAR) AS key, props AS data
  FROM events
  UNION ALL
  SELECT 'documents', 0, doc_id, NULL, NULL, text FROM documents
)"""

_UNI_WS = " || ".join(
    f"chr({c})"
    for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233,
              8239, 8287, 12288]
)


def _upsert(merge: str) -> str:
    def pick(f, out=None):
        out = out or f
        if merge == "coalesce":
            return f"coalesce(n.{f}, o.{f}) AS {out}"
        return f"CASE WHEN n._id IS NOT NULL THEN n.{f} ELSE o.{f} END AS {out}"

    content = ", ".join(
        pick(f, '"company address"' if f == "company_address" else f) for f in _CONTENT
    )
    if merge == "coalesce":
        flags = [
            f"coalesce(o.has_{s}, false) OR coalesce(n.has_{s}, false)"
            for s in ("personal", "bank", "location", "network", "professional")
        ]
        names = ("personal", "bank", "location", "network", "professional")
        sources = "concat_ws(',', {}) AS data_sources, {} AS n_sources".format(
            ", ".join(f"CASE WHEN {f} THEN '{s}' END" for f, s in zip(flags, names)),
            " + ".join(f"CAST({f} AS INTEGER)" for f in flags),
        )
    else:
        sources = pick("data_sources")
    return f"""
SELECT coalesce(n._id, o._id) AS _id, '2024-01-01T00:00:00' AS consolidated_at, {sources},
  CASE WHEN n._id IS NOT NULL THEN false ELSE o.city IS NOT NULL END AS "uploaded_2_SQL",
  {content},
  CASE WHEN n._id IS NULL THEN 'kept' WHEN o._id IS NULL THEN 'created' ELSE 'updated' END AS change
FROM old_golden o FULL JOIN new_golden n ON o._id = n._id"""


_STRICT_PERSON = "name || ' ' || last_name"
_NAMESAKES = """(SELECT count(*) FROM (
  SELECT 1 FROM {g} GROUP BY lower(trim(name || ' ' || last_name)) HAVING count(*) > 1))"""

ORACLES: dict[str, str] = {
    # sources, scans, sinks
    "ingest_stream": "WITH" + _ENVELOPE
    + " SELECT topic, partition, \"offset\", ts_ms, key, data FROM rows WHERE topic <> 'documents'",
    "decode_envelope": "WITH" + _ENVELOPE
    + ' SELECT topic, partition, "offset", ts_ms, key, data FROM rows WHERE json_valid(data)',
    "decode_rejects": "WITH" + _ENVELOPE
    + ' SELECT topic, partition, "offset", data AS value,'
    " CASE WHEN data IS NULL THEN 'tombstone' ELSE 'bad_json' END AS reason"
    " FROM rows WHERE NOT coalesce(json_valid(data), false)",
    "bronze_append": "WITH" + _ENVELOPE
    + ' SELECT topic, partition, count(*) AS documents, min("offset") AS first_offset'
    " FROM rows WHERE topic <> 'documents' GROUP BY ALL",
    "bronze_scan": "WITH" + FEED + "SELECT 'people' AS topic, seq AS \"offset\", data FROM feed",
    "golden_pending_scan": BASE + "," + _PENDING + _golden_select("pending"),
    "golden_json_source": BASE + f" SELECT _id, {_content()} FROM golden",
    "golden_upsert": TWO_BATCHES + _upsert("replace"),
    "golden_upsert_coalesce": TWO_BATCHES + _upsert("coalesce"),
    "load_tables": _BULK + _ROWS_OF_ALL,
    "run_strict_tables": BASE + "," + _STRICT_ALL + "," + _tables("", "strict_all", "strict")
    + _ROWS_OF_ALL,
    "run_strict_golden": BASE + "," + _STRICT_ALL
    + " SELECT _id, n_sources, _id IN (SELECT _id FROM strict_all) AS \"uploaded_2_SQL\" FROM golden",
    "run_json_golden": TWO_BATCHES + "," + _STRICT_ALL
    + ", known AS (SELECT _id FROM strict_all UNION SELECT _id FROM old_golden)"
    " SELECT _id, _id IN (SELECT _id FROM known) AS \"uploaded_2_SQL\","
    " _id IN (SELECT _id FROM known) AS has_person FROM golden",
    "table_scan": _BULK + " SELECT * FROM person",
    "export_csv": _ALL_TABLES + _blank(_FLAT),
    "bronze_remaining": BASE
    + " SELECT seq, data FROM msg WHERE link_key IS NULL AND shape <> 'empty'",
    "bronze_remaining_retained": BASE
    + " SELECT seq, data FROM msg WHERE (link_key IS NULL AND shape <> 'empty')"
    " OR (shape IN ('personal', 'bank') AND link_key IN (SELECT _id FROM people"
    " WHERE coalesce(name, '') = '' OR coalesce(last_name, '') = ''))",
    "mark_uploaded": BASE
    + ' SELECT _id, n_sources, n_sources = 5 AS "uploaded_2_SQL" FROM golden',
    # projections, filters, scalar functions
    "detect_schema": BASE + " SELECT seq, shape FROM msg WHERE shape <> 'empty'",
    "filter_empty_payload": BASE + " SELECT seq, data FROM msg WHERE shape = 'empty'",
    "reject_missing_key": BASE
    + " SELECT seq, shape, data FROM msg WHERE link_key IS NULL"
    " AND shape NOT IN ('empty', 'unknown')",
    "unknown_payloads": BASE + " SELECT seq, data FROM msg WHERE shape = 'unknown'",
    "normalize_key": BASE
    + " SELECT seq, lower(trim(link_value)) AS normalized FROM msg WHERE link_value IS NOT NULL",
    "build_fullname": BASE
    + " SELECT seq, name || ' ' || last_name AS fullname,"
    " lower(trim(name || ' ' || last_name)) AS fullname_key FROM msg WHERE shape = 'personal'",
    "golden_projection": BASE + _golden_select("candidate"),
    "data_sources": BASE + " SELECT _id, data_sources, n_sources FROM candidate",
    "filter_complete_identity": BASE + " SELECT _id, name, last_name FROM golden",
    "unmatched_passports": BASE
    + " SELECT _id AS key, has_personal FROM people"
    " WHERE coalesce(name, '') = '' OR coalesce(last_name, '') = ''",
    "filter_all_sources": BASE + " SELECT _id FROM golden WHERE n_sources = 5",
    "filter_not_uploaded": TWO_BATCHES
    + ' SELECT _id, false AS "uploaded_2_SQL" FROM old_golden WHERE city IS NULL',
    "skip_missing_passport": BASE + " SELECT _id FROM candidate WHERE coalesce(_id, '') <> ''",
    "person_projection": _ALL_TABLES + " SELECT * EXCLUDE (id) FROM person",
    "sex_scalar": BASE
    + " SELECT _id, coalesce(sex, '') AS sex_bulk, nullif(sex, '') AS sex_strict FROM candidate",
    "clean_street": "SELECT doc_id, trim(translate(text, chr(10) || chr(13), '  '), "
    + _UNI_WS
    + ") AS street FROM documents",
    "home_address_projection": _ALL_TABLES
    + " SELECT _id AS passport, type, street_name, city, ip_address FROM places"
    " WHERE type = 'Home'",
    "work_address_projection": _ALL_TABLES
    + " SELECT _id AS passport, type, street_name, city, ip_address FROM places"
    " WHERE type = 'Work'",
    "bank_projection": BASE
    + " SELECT _id AS passport, coalesce(IBAN, '') AS iban, coalesce(salary, '') AS salary"
    " FROM golden WHERE coalesce(IBAN, '') <> '' OR coalesce(salary, '') <> ''",
    "work_projection": BASE
    + " SELECT _id AS passport, coalesce(company, '') AS company, coalesce(job, '') AS position,"
    " coalesce(company_telfnumber, '') AS phone, coalesce(company_email, '') AS email"
    " FROM golden WHERE concat(company, job, company_telfnumber, company_email) <> ''",
    "strict_row_validation": BASE
    + " SELECT _id, CASE WHEN coalesce(name, '') = '' OR coalesce(last_name, '') = ''"
    " THEN 'missing_name' WHEN coalesce(sex, '') = '' THEN 'missing_sex' END AS reject_reason"
    " FROM candidate",
    "strict_address_defaults": BASE + "," + _tables("", "golden", "strict")
    + " SELECT _id AS passport, type, street_name, city, ip_address FROM places",
    "full_name_from_parts": BASE
    + f" SELECT _id AS passport, {_STRICT_PERSON} AS full_name FROM golden",
    "stamp_time": BASE + " SELECT _id, true AS stamped FROM golden",
    # joins
    "link_personal_bank": BASE
    + " SELECT _id AS passport, name, last_name, IBAN, salary FROM people",
    "link_location": BASE + " SELECT _id AS passport, fullname, city, address FROM golden",
    "link_network": BASE + " SELECT _id AS passport, address, IPv4 FROM golden",
    "link_professional": BASE
    + " SELECT _id AS passport, company, company_address, company_telfnumber, company_email, job"
    " FROM golden",
    "resolve_person_fk": TWO_BATCHES + "," + _OLD_TABLES + ","
    + """
known AS (
  SELECT passport, id FROM old_person
  UNION ALL
  SELECT _id, (SELECT max(id) FROM old_person) + row_number() OVER (ORDER BY md5(_id), _id)
  FROM golden
),
newest AS (SELECT passport, max(id) AS person_id FROM known GROUP BY passport)
SELECT m.link_key AS passport, m.seq, m.IBAN AS iban, k.person_id
FROM msg m JOIN newest k ON k.passport = m.link_key WHERE m.shape = 'bank'""",
    "unresolved_persons": BASE
    + " SELECT link_key AS passport, seq, IBAN AS iban FROM msg WHERE shape = 'bank'"
    " AND link_key IS NOT NULL AND link_key NOT IN (SELECT _id FROM golden)",
    "resolve_address_fk": _ALL_TABLES + " SELECT * FROM person_address",
    "skip_existing_persons": TWO_BATCHES
    + " SELECT _id, name FROM golden WHERE _id NOT IN (SELECT _id FROM old_golden)",
    "dump_bank": _ALL_TABLES + _ALL_BANKS
    + " SELECT p.passport AS person_passport, b.iban AS bank_iban, b.salary AS bank_salary"
    " FROM person p LEFT JOIN every_bank b ON p.id = b.person_id",
    "dump_work": _ALL_TABLES
    + " SELECT p.passport AS person_passport, w.company AS work_company,"
    " w.position AS work_position, w.phone AS work_phone, w.email AS work_email"
    " FROM person p LEFT JOIN work w ON p.id = w.person_id",
    "dump_home": _ALL_TABLES
    + " SELECT p.passport AS person_passport, a.street_name AS home_street, a.city AS home_city,"
    " a.ip_address AS home_ip FROM person p LEFT JOIN person_address l"
    " ON p.id = l.person_id AND l.type = 'Home' LEFT JOIN address a ON l.address_id = a.id",
    "flat_person_dataset": _ALL_TABLES + _ALL_BANKS + _FLAT_ALL,
    "semi_consumed": BASE
    + " SELECT seq FROM feed WHERE seq IN (SELECT seq FROM msg"
    " WHERE link_key IS NOT NULL OR shape = 'empty')",
    # aggregations
    "latest_by_key": BASE + " SELECT shape, link_key AS key, seq FROM latest",
    "class_counts": BASE + " SELECT" + _COUNTS + " AS consumed_records FROM msg",
    "consolidation_stats": TWO_BATCHES
    + ", c AS (SELECT" + _COUNTS + " AS raw_records_deleted FROM new_msg)"
    " SELECT c.*,"
    " (SELECT count(*) FROM new_golden WHERE _id NOT IN (SELECT _id FROM old_golden))"
    " AS golden_records_created,"
    " (SELECT count(*) FROM new_golden WHERE _id IN (SELECT _id FROM old_golden))"
    " AS golden_records_updated,"
    " (SELECT count(*) FROM new_people WHERE coalesce(name, '') = ''"
    " OR coalesce(last_name, '') = '') AS unmatched_records, "
    + _NAMESAKES.format(g="new_golden") + " AS namesake_conflicts FROM c",
    "dry_run_stats": BASE
    + ", c AS (SELECT" + _COUNTS + " AS raw_records_deleted FROM msg)"
    " SELECT c.*, (SELECT count(*) FROM golden) AS golden_records_created,"
    " CAST(0 AS BIGINT) AS golden_records_updated,"
    " (SELECT count(*) FROM people WHERE coalesce(name, '') = ''"
    " OR coalesce(last_name, '') = '') AS unmatched_records, "
    + _NAMESAKES.format(g="golden") + " AS namesake_conflicts FROM c",
    "collection_status": BASE
    + " SELECT 'raw' AS collection, count(*) AS documents FROM feed"
    " UNION ALL SELECT 'golden', count(*) FROM golden",
    "ingest_bounds": "SELECT epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us"
    " FROM events",
    "throughput_blocks": "SELECT *, CASE WHEN elapsed_us > 0 THEN messages / (elapsed_us / 1e6)"
    " END AS msg_per_sec FROM (SELECT CAST(user_id % 4 AS INTEGER) AS partition,"
    " event_id // 100 AS block, count(*) AS messages,"
    " epoch_us(max(ts)) - epoch_us(min(ts)) AS elapsed_us FROM events GROUP BY ALL)",
    "load_summary": TWO_BATCHES
    + " SELECT CASE WHEN _id IN (SELECT _id FROM old_golden) THEN 'skipped'"
    " WHEN coalesce(sex, '') = '' THEN 'error' ELSE 'processed' END AS outcome,"
    " count(*) AS records FROM golden WHERE n_sources = 5 GROUP BY ALL",
    "table_counts": _ALL_TABLES + _ALL_BANKS
    + " SELECT (SELECT count(*) FROM person) AS persons, (SELECT count(*) FROM every_bank)"
    " AS banks, (SELECT count(*) FROM work) AS works, (SELECT count(*) FROM address)"
    " AS addresses",
    "pending_gate": BASE
    + " SELECT (SELECT count(*) FROM feed) > 0 AS has_new_data,"
    " (SELECT count(*) FROM feed) AS raw_count, (SELECT count(*) FROM golden) AS golden_count",
    "pipeline_health": "SELECT n AS total_documents, age AS last_insert_age_sec,"
    " n / ((l - f) / 6e7) AS docs_per_min,"
    " n / ((l - f) / 6e7) * CAST(1440 AS DOUBLE) AS estimated_daily_volume,"
    " CASE WHEN age <= 3600 THEN 'FRESH' ELSE 'STALE' END AS data_status"
    " FROM (SELECT n, f, l, (epoch_us(TIMESTAMP '2024-03-01 00:00:00') - l) / 1e6 AS age"
    " FROM (SELECT count(*) AS n, epoch_us(min(ts)) AS f, epoch_us(max(ts)) AS l FROM events))",
    # ids, sort, unions
    "assign_surrogate_ids": TWO_BATCHES
    + " SELECT _id AS passport, (SELECT count(*) FROM old_golden)"
    " + row_number() OVER (ORDER BY md5(_id), _id) AS id FROM golden",
    "latest_messages": 'SELECT event_id AS "offset", props AS data FROM events'
    " ORDER BY ts DESC, event_id DESC, user_id % 4 DESC LIMIT 3",
    "all_passports": BASE
    + " SELECT link_key AS passport FROM msg WHERE shape = 'personal' AND link_key IS NOT NULL"
    " UNION SELECT link_key FROM msg WHERE shape = 'bank' AND link_key IS NOT NULL",
    "address_union": _ALL_TABLES
    + " SELECT _id AS passport, type, street_name, city, ip_address FROM places",
    "person_address_union": _ALL_TABLES + " SELECT * FROM person_address",
    # streaming
    "stream_ingest": "WITH" + _ENVELOPE
    + ' SELECT topic, partition, "offset", CASE WHEN data IS NULL THEN \'tombstone\''
    " WHEN json_valid(data) THEN 'kept' ELSE 'bad_json' END AS reason, data AS content"
    " FROM rows",
    "stream_resume": 'SELECT event_type AS topic, event_id AS "offset", props AS data FROM events',
    "stream_dedup": "SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition,"
    ' event_id AS "offset" FROM events',
    "stream_consolidate": BASE + _golden_select("golden", "n_sources = 5"),
    "stream_consolidate_batches": BASE + _golden_select("golden", "n_sources = 5"),
    "stream_consolidate_tables": _BULK
    + " SELECT 'person' AS tab, passport AS owner, concat_ws('|', email, full_name, last_name, name, passport, phone, sex) AS content"
    " FROM person UNION ALL"
    " SELECT 'bank', passport, concat_ws('|', iban, salary) FROM bank JOIN person ON person.id = person_id UNION ALL"
    " SELECT 'work', passport, concat_ws('|', company, work.email, work.phone, position) FROM work"
    " JOIN person ON person.id = person_id UNION ALL"
    " SELECT 'address', passport, concat_ws('|', city, ip_address, street_name, type) FROM address"
    " JOIN person_address ON address.id = address_id JOIN person ON person.id = person_id",
    "stream_rate": "SELECT CAST(epoch(w) AS BIGINT) AS window_start_s, messages,"
    " messages / CAST(3600 AS DOUBLE) AS msg_per_sec FROM"
    " (SELECT date_trunc('hour', ts) AS w, count(*) AS messages FROM events GROUP BY ALL)",
    # pipelines
    "consolidate": BASE + _golden_select("golden"),
    "load_bulk_skip_existing": TWO_BATCHES + "," + _OLD_TABLES + "," + _PENDING
    + ", fresh AS (SELECT * FROM pending WHERE _id NOT IN (SELECT passport FROM old_person)),"
    + _tables("", "fresh", "bulk", "old_")
    + " SELECT * FROM person",
    "load_json": _JSON + " SELECT * FROM person",
    "load_json_summary": _JSON
    + " SELECT 'processed' AS outcome, (SELECT count(*) FROM json_new) AS records UNION ALL"
    " SELECT 'skipped', (SELECT count(*) FROM golden) - (SELECT count(*) FROM json_new)",
    "dump": _ALL_TABLES + _ALL_BANKS + _blank(_FLAT_ALL),
}
for _name in ("person", "address", "person_address", "bank", "work"):
    ORACLES[f"load_bulk_{_name}"] = _BULK + f" SELECT * FROM {_name}"
    ORACLES[f"load_strict_{_name}"] = _STRICT + f" SELECT * FROM {_name}"
ORACLES["dry_run"] = ORACLES["dry_run_stats"]
