"""The expected result of each query as DuckDB SQL.

Written against the tables and the registry rows, not against the engine: hashes
from the text of a tuple, JSON by joining text, dates by one regular expression.
"""

from __future__ import annotations

from regloom.workload.registry import columns, registry_sql

REG = f"WITH reg AS ({registry_sql()})\n"
Q, DQ = "chr(39)", "chr(34)"


def short_hash(text: str) -> str:
    return f"regexp_replace(translate(to_base64(unhex(sha256({text}))), '+/', '-_'), '(.).', '\\1', 'g')"


def quoted(c: str) -> str:
    return f"CASE WHEN contains({c}, {Q}) THEN concat({DQ}, {c}, {DQ}) ELSE concat({Q}, {c}, {Q}) END"


REG_HASH = short_hash("concat('(', " + ", ', ', ".join(quoted(c) for c in columns()) + ", ')')")


def member(name: str, c: str) -> str:
    """``"name":"value"``, or null for an empty cell."""
    return f"""CASE WHEN {c} <> '' THEN concat('"{name}":"', {c}, '"') END"""


def obj(*members: str) -> str:
    """A JSON object of the members present, or null when there are none."""
    joined = f"concat_ws(',', {', '.join(members)})"
    return f"CASE WHEN {joined} <> '' THEN concat('{{', {joined}, '}}') END"


def holding(name: str, value: str) -> str:
    """``"name":value`` for a value that is JSON text already."""
    return f"""CASE WHEN {value} IS NOT NULL THEN concat('"{name}":', {value}) END"""


def first(*cells: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({c}, '')" for c in cells) + ")"


# --- dates ---

DAYS = r"3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9]"
MDY = rf"^(1[0-2]|0[1-9]|[1-9])({DAYS})(\d\d\d\d)"
FILE_DATE = "COR_FILE_DATE"


def mdy(i: int, c: str = FILE_DATE) -> str:
    return f"lpad(trim(regexp_extract({c}, '{MDY}', {i})), 2, '0')"


def mdy_date(c: str = FILE_DATE) -> str:
    """The first way to match has to use up the whole text."""
    whole = f"regexp_extract({c}, '{MDY}', 0) = {c} AND {c} <> ''"
    day = f"try_cast(concat(regexp_extract({c}, '{MDY}', 3), '-', {mdy(1, c)}, '-', {mdy(2, c)}) AS DATE)"
    return f"CASE WHEN {whole} THEN {day} END"


FILE_VALUE = f"CASE WHEN {mdy_date()} IS NOT NULL THEN strftime({mdy_date()}, '%m%d%Y') ELSE {FILE_DATE} END"
INCORPORATION = f"""CASE WHEN {FILE_DATE} <> '' THEN concat('{{"file_date":{{"value":"', {FILE_VALUE},
    '","format":"MMDDYYYY","python_date_format":"%m%d%Y"}}}}') END"""
VALID = f"({FILE_DATE} = '' OR {mdy_date()} IS NOT NULL)"

# --- full record ---


AGENT = obj(
    member("name", "RA_NAME"),
    holding("other_attributes", obj(member("type", "RA_NAME_TYPE"))),
    member("street_address", "RA_ADD_1"),
    member("city", "RA_CITY"),
    member("state", "RA_STATE"),
    member("zip5", "RA_ZIP5"),
    member("zip4", "RA_ZIP4"),
    "CASE WHEN concat(RA_NAME, RA_NAME_TYPE, RA_ADD_1, RA_CITY, RA_STATE, RA_ZIP5, RA_ZIP4) <> '' THEN '\"position\":\"agent\"' END",
)


def principal(n: int) -> str:
    return obj(
        member("position", f"PRINC{n}_TITLE"),
        member("name", first(f"PRINC{n}_NAME", f"PRINC{n}_NAME_TYPE")),
        member("street_address", f"PRINC{n}_ADD_1"),
        member("city", f"PRINC{n}_CITY"),
        member("state", f"PRINC{n}_STATE"),
        member("zip5", f"PRINC{n}_ZIP5"),
        member("zip4", f"PRINC{n}_ZIP4"),
    )


OFFICERS = obj(holding("RA_", AGENT), *[holding(str(n), principal(n)) for n in range(1, 7)])


def address(prefix: str) -> str:
    inner = obj(
        member("street_address_1", f"{prefix}_ADD_1"),
        member("street_address_2", f"{prefix}_ADD_2"),
        member("locality", f"{prefix}_CITY"),
        member("region", f"{prefix}_STATE"),
    )
    return obj(holding(prefix, inner))


ATTRIBUTES = obj(member("jurisdiction_of_origin", "STATE_COUNTRY"), "'\"identifier_system_code\":\"us_fein\"'")
NONE = "CAST(NULL AS VARCHAR)"
FULL = {
    "company_number": "COR_NUMBER",
    "name": "COR_NAME",
    "jurisdiction_code": "'us_fl'",
    "current_status": "COR_STATUS",
    "company_type": "COR_FILING_TYPE",
    "incorporation_date": INCORPORATION,
    "dissolution_date": NONE,
    "registry_url": NONE,
    "officers": OFFICERS,
    "registered_address": NONE,
    "mailing_address": address("COR_MAIL"),
    "headquarters_address": address("COR_PRINC"),
    "company_identifiers": obj(member("uid", "COR_FEI_NUMBER")),
    "all_attributes": ATTRIBUTES,
    "previous_names": NONE,
    "periodicity": "'daily'",
    "fetched_by": "'fetcher'",
    "fetched_at": "'2024-10-07T05:00:00'",
    "parsed_by": "'us_fl_fixed_width_field_def_0.1'",
    "parsed_at": "'2024-10-07T06:00:00'",
    "cdm_mapping_rules": "'cdm_mapping_us_fl:0.1'",
    "cdm_mapped_by": "'regloom'",
    "cdm_mapped_at": "'2024-10-07T07:00:00'",
    "source_name": "'cordata'",
    "hash": REG_HASH,
    "source_timestamp": NONE,
}


def pick(names) -> str:
    return ", ".join(f"{FULL[n]} AS {n}" for n in names)


def from_reg(select: str, rest: str = "") -> str:
    return f"{REG}SELECT {select} FROM reg {rest}"


SHARED = ["company_number", "name", "jurisdiction_code", "current_status", "company_type", "incorporation_date"]
SPLIT = list(FULL)

# --- texts ---

BLANK_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BLANKS = "[" + "".join(f"\\x{{{c:X}}}" for c in BLANK_CODES) + "]+"
BREAKS = "[" + "".join(f"\\x{{{c:X}}}" for c in (0x0A, 0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029)) + "]"


def stripped(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{BLANKS}', ''), '{BLANKS}$', '')"


def python_text(c: str) -> str:
    """How Python prints a string whose only odd characters are line breaks,
    quotes and backslashes."""
    escaped = f"replace(replace({c}, '\\', '\\\\'), chr(10), '\\n')"
    return f"""CASE WHEN NOT contains({c}, {Q}) THEN concat({Q}, {escaped}, {Q})
        WHEN NOT contains({c}, {DQ}) THEN concat({DQ}, {escaped}, {DQ})
        ELSE concat({Q}, replace({escaped}, {Q}, concat('\\', {Q})), {Q}) END"""


EVENT_FILE = """SELECT event_id, concat('us_fl/', event_type, '/f', event_id, CASE event_id % 4
    WHEN 0 THEN '_invalid.csv.bz2' WHEN 1 THEN '.csv' ELSE '.csv.bz2' END) AS key FROM events"""
TASKS = """SELECT concat(event_type, '/', lpad(concat('', event_id), 12, '0')) AS object_key,
    CASE event_id % 5 WHEN 0 THEN 'NEW' WHEN 1 THEN 'PREPARING' WHEN 2 THEN 'PROCESSING' WHEN 3 THEN 'PROCESSED' END AS status,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, event_id, event_type FROM events"""
MANIFEST = """SELECT concat('cfg_', lower(r_name)) AS ingest_config, lower(r_name) AS jurisdiction, r_regionkey,
    'daily' AS periodicity, r_regionkey % 4 = 2 AS check_timestamp FROM region"""
WANTED = """SELECT m.*, c.c_custkey, c.c_acctbal, concat('c', c.c_custkey, '.txt') AS name
    FROM manifest m JOIN customer c ON c.c_custkey % 5 = m.r_regionkey
    WHERE CASE WHEN m.r_regionkey % 2 = 0 THEN c.c_custkey % 10 = 0 ELSE c.c_custkey IN (1, 21, 301) END"""
ORDER_DAY = "CASE WHEN o_orderkey % 10 = 0 THEN 31 ELSE day(o_orderdate) END"
ORDER_DATE = f"try_cast(concat(year(o_orderdate), '-', lpad(concat('', month(o_orderdate)), 2, '0'), '-', lpad(concat('', {ORDER_DAY}), 2, '0')) AS DATE)"
ORDER_MONTH = "['Jan','FEB','mar','Apr','May','Jun','Jul','Aug','Sep','oct','Nov','Dec'][month(o_orderdate)]"
VALID_STATE = f"""CASE WHEN COR_NUMBER LIKE '%00' THEN 'missing' WHEN COR_NUMBER LIKE '%01' THEN 'bad'
    WHEN COR_NUMBER LIKE '%02' THEN 'bad' WHEN COR_NUMBER LIKE '%03' THEN 'missing' WHEN COR_NUMBER LIKE '%04' THEN 'bad'
    WHEN COR_NUMBER LIKE '%05' THEN 'good' WHEN COR_NUMBER LIKE '%06' THEN 'bad' WHEN COR_NUMBER LIKE '%07' THEN 'bad'
    WHEN {mdy_date()} IS NOT NULL THEN 'good' ELSE 'bad' END"""


def registry_officers(with_address: bool) -> str:
    if not with_address:
        def part(name, position, keep):
            return f"SELECT COR_NUMBER AS company_number, nullif({name}, '') AS name, nullif({position}, '') AS position FROM reg WHERE {keep} <> ''"

        agent = part("RA_NAME", "'agent'", "concat(RA_NAME, RA_NAME_TYPE, RA_ADD_1, RA_CITY, RA_STATE, RA_ZIP5, RA_ZIP4)")
        rest = [
            part(f"coalesce(nullif(PRINC{n}_NAME, ''), PRINC{n}_NAME_TYPE)", f"PRINC{n}_TITLE", f"concat(PRINC{n}_NAME, PRINC{n}_NAME_TYPE, PRINC{n}_TITLE, PRINC{n}_ADD_1, PRINC{n}_CITY, PRINC{n}_STATE, PRINC{n}_ZIP5, PRINC{n}_ZIP4)")
            for n in range(1, 7)
        ]
    else:
        def part(name, prefix):
            return f"""SELECT COR_NUMBER AS company_number, nullif({name}, '') AS officer_name, nullif({prefix}_ADD_1, '') AS street_address,
                nullif({prefix}_CITY, '') AS locality, nullif({prefix}_STATE, '') AS region,
                nullif(concat_ws('-', nullif({prefix}_ZIP5, ''), nullif({prefix}_ZIP4, '')), '') AS postal_code
                FROM reg WHERE concat({prefix}_ADD_1, {prefix}_CITY, {prefix}_STATE, {prefix}_ZIP5, {prefix}_ZIP4) <> ''"""

        agent = part("RA_NAME", "RA")
        rest = [part(f"coalesce(nullif(PRINC{n}_NAME, ''), PRINC{n}_NAME_TYPE)", f"PRINC{n}") for n in range(1, 7)]
    return REG + " UNION ALL ".join([agent, *rest])


def address_rows(prefix: str, kind: str) -> str:
    return f"""SELECT COR_NUMBER AS company_number,
        nullif(concat_ws(', ', nullif({prefix}_ADD_1, ''), nullif({prefix}_ADD_2, '')), '') AS street_address,
        nullif({prefix}_CITY, '') AS locality, nullif({prefix}_STATE, '') AS region, {NONE} AS postal_code, '{kind}' AS kind
        FROM reg WHERE concat({prefix}_ADD_1, {prefix}_ADD_2, {prefix}_CITY, {prefix}_STATE) <> ''"""


CUSTOMER_TEXTS = """SELECT c_custkey, concat('', c_custkey) AS id, concat(c_name, CASE c_custkey % 4 WHEN 0 THEN concat(chr(10), 'line')
    WHEN 1 THEN ', "quoted"' WHEN 2 THEN concat(chr(13), chr(10), '"') ELSE '' END) AS note, c_mktsegment AS segment FROM customer"""
STAMPS = ["fetched_at", "parsed_at", "cdm_mapped_at"]
ISLE = ["company_number", "name", "jurisdiction_code", "incorporation_date", "officers", "all_attributes", "previous_names"]

ORACLE: dict[str, str] = {
    "fw_parse": from_reg(f"*, {REG_HASH} AS hash"),
    "fw_chunk": from_reg(
        "COR_NUMBER, COR_NAME, CAST(floor((row_number() OVER (ORDER BY COR_NUMBER) - 1) / 100) AS BIGINT) AS chunk_index"
    ),
    "fw_dirty": f"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
        dirty AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN concat(chr(9), line) WHEN 1 THEN concat(line, chr(160)) ELSE line END AS v FROM lines),
        clean AS (SELECT doc_id, replace(unnest(regexp_split_to_array(v, '{BREAKS}')), {DQ}, '') AS v FROM dirty)
        SELECT {stripped('substr(v, 1, 12)')} AS head, {stripped('substr(v, 13, 48)')} AS body, {stripped('substr(v, 61)')} AS rest, doc_id FROM clean""",
    "row_hash_registry": from_reg(f"COR_NUMBER, {REG_HASH} AS hash"),
    "row_hash_documents": f"""WITH f AS (SELECT doc_id, concat(lang, {Q}, source) AS origin, replace(text, 'ion', {Q}) AS body FROM documents)
        SELECT doc_id, {short_hash(f"concat('(', {python_text('origin')}, ', ', {python_text('body')}, ')')")} AS hash FROM f""",
    "csv_scan": "SELECT concat('', o_orderkey) AS o_orderkey, concat('', o_custkey) AS o_custkey, o_orderstatus, o_orderpriority FROM orders",
    "csv_bz2": "SELECT concat('', c_custkey) AS c_custkey, c_name, c_mktsegment FROM customer",
    "csv_roundtrip": from_reg(
        "COR_NUMBER AS company_number, COR_NAME AS name, "
        + obj(member("street", "COR_MAIL_ADD_1"), member("unit", "COR_MAIL_ADD_2"))
        + " AS mailing_address"
    ),
    "jsonl_scan": "SELECT conv_id, turn, role, text FROM conversations",
    "read_dispatch": """SELECT concat('', event_id) AS event_id, event_type, props, fmt
        FROM events, (SELECT unnest(['csv', 'json_lines', 'parquet']) AS fmt)""",
    "zip_expand": f"""WITH lines AS (SELECT concat('batch', conv_id // 40, '.zip') AS archive, strlen(text) AS size,
            concat('c', conv_id, '_t', turn) AS source_name, string_split(text, chr(10)) AS parts FROM conversations),
        kept AS (SELECT archive, size, source_name, CASE WHEN parts[-1] = '' THEN parts[:-2] ELSE parts END AS parts FROM lines)
        SELECT archive, concat('conv/', source_name, '.txt') AS member, size, concat('turns/conv/', source_name, '.txt') AS key,
            source_name, unnest(parts) AS value FROM kept""",
    "file_inventory": """SELECT DISTINCT concat('event_type=', event_type, '/day=', strftime(ts, '%Y-%m-%d')) AS path,
        true AS key_ok, true AS name_ok, true AS time_ok FROM events""",
    "csv_multiline": f"SELECT id, note, segment, how FROM ({CUSTOMER_TEXTS}), (SELECT unnest(['table', 'stream']) AS how)",
    "csv_blocks": """SELECT concat(l_orderkey, '-', l_linenumber) AS id,
        concat(l_returnflag, CASE l_orderkey % 5 WHEN 0 THEN ',"' WHEN 1 THEN repeat(chr(10), CAST(l_linenumber % 3 + 1 AS BIGINT))
            WHEN 2 THEN concat('"', chr(13), chr(10), '"') ELSE '' END, l_linestatus) AS note, concat('', l_suppkey) AS supplier FROM lineitem""",
    "csv_mixed_headers": f"SELECT id, note, CASE WHEN c_custkey % 2 = 0 THEN segment END AS segment FROM ({CUSTOMER_TEXTS})",
    "jsonl_corrupt": """WITH lines AS (SELECT o_orderkey % 10 = 3 AS bad, concat('O', o_orderkey) AS id, o_orderstatus AS status,
        concat('{"id":"O', o_orderkey, '","status":"', o_orderstatus, '"}')[:12] AS cut FROM orders)
        SELECT CASE WHEN bad THEN concat(p, CASE WHEN p = '' THEN 'quarantine' ELSE 'invalid' END)
            ELSE concat(p, CASE WHEN p = '' THEN 'row' ELSE 'valid' END) END AS kind,
        CASE WHEN NOT bad THEN id END AS id, CASE WHEN NOT bad THEN status END AS status, CASE WHEN bad THEN cut END AS value, true AS has_path
        FROM lines, (SELECT unnest(['', 'stream ']) AS p)""",
    "fw_chunk_file": from_reg(
        """COR_PRINC_CITY AS city, CASE WHEN part = 0 THEN COR_NUMBER ELSE 'second line' END AS value,
        CAST(floor((2 * (row_number() OVER (PARTITION BY COR_PRINC_CITY, part ORDER BY COR_NUMBER) - 1) + part) / 100) AS BIGINT) AS chunk_index""",
        ", (SELECT unnest([0, 1]) AS part)",
    ),
    "csv_chunks": """WITH c AS (SELECT floor((row_number() OVER () - 1) / 100) AS file FROM customer),
        f AS (SELECT count(*) AS rows FROM c GROUP BY file) SELECT rows, count(*) AS files FROM f GROUP BY rows""",
    "csv_chunk_rows": """WITH c AS (SELECT *, (row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS file FROM customer)
        SELECT concat('', c_custkey) AS c_custkey, c_name, count(*) OVER (PARTITION BY file) AS rows FROM c""",
    "jurisdiction_check": """WITH f AS (SELECT concat('in/', c_custkey) AS path,
            CASE c_nationkey % 5 WHEN 0 THEN 'us_fl' WHEN 1 THEN 'im' WHEN 2 THEN 'IM' WHEN 3 THEN '' END AS code FROM customer)
        SELECT path, code, coalesce(code = 'us_fl' OR code = 'im', false) AS known FROM f""",
    "date_fields": REG
    + f"""SELECT 'us_fl' AS code, 'incorporation_date' AS field, count(*) FILTER ({FILE_DATE} <> '' AND {mdy_date()} IS NOT NULL) AS valid,
        count(*) FILTER ({FILE_DATE} = '') AS without FROM reg UNION ALL SELECT 'im', 'incorporation_date', count(*), 0 FROM reg""",
    "fw_bad_bytes": """SELECT concat('e', event_id, ' ', event_type, CASE WHEN event_id % 3 = 0 THEN concat(chr(65533), 'é') ELSE '' END) AS value
        FROM events""",
    "file_names": f"""SELECT key, regexp_extract(key, '^(.*)/', 1) AS path, split_part(key, '/', -1) AS name FROM ({EVENT_FILE})
        WHERE starts_with(key, 'us_fl/c') AND event_id % 8 = 1""",
    "file_route": f"""SELECT key, CASE WHEN key LIKE '%_invalid.csv.bz2' THEN 'invalid' ELSE 'valid' END AS route
        FROM ({EVENT_FILE}) WHERE key LIKE '%.csv.bz2'""",
    "bulk_projection": from_reg(pick(FULL) + ", TIMESTAMP '2024-10-08 00:00:00' AS extracted_at"),
    "evolve_append": """SELECT n_nationkey, n_name, CAST(NULL AS BIGINT) AS c_custkey, CAST(NULL AS VARCHAR) AS c_mktsegment FROM nation
        UNION ALL SELECT c_nationkey, NULL, c_custkey, c_mktsegment FROM customer""",
    "rules_key": """SELECT n_nationkey, concat('cdm_mapping_rules/', lower(n_name), '/',
        CASE n_nationkey % 3 WHEN 0 THEN 'jsonlines' WHEN 1 THEN 'csv' ELSE 'json' END, '/',
        CASE WHEN n_nationkey % 2 = 0 THEN concat('v', n_regionkey) ELSE 'latest' END,
        '/cdm_mapping_', lower(n_name), '.json') AS rules_key,
        concat('fixed_width_field_def/', lower(n_name), '/latest/', lower(n_name), '.json') AS layout_key FROM nation""",
    "target_key": """WITH o AS (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN concat('', o_custkey) ELSE 'anon' END AS stem FROM orders)
        SELECT o_orderkey, concat('us_fl/', year(o_orderdate), '/', month(o_orderdate), '/', day(o_orderdate), '/', stem, '/', stem,
        CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 4 > 0 THEN concat('_', o_orderkey % 4 - 1) ELSE '' END,
        CASE WHEN o_orderstatus = 'F' THEN '_invalid' ELSE '' END, '.csv') AS target_key FROM o""",
    "raw_key": """SELECT o_orderkey, concat('landing/', strftime(CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate ELSE TIMESTAMP '2024-10-07' END,
        '%Y/%m/%d'), '/o', o_orderkey, '.txt') AS raw_key FROM orders""",
    "date_norm": from_reg(f"COR_NUMBER, {FILE_VALUE} AS value, 'MMDDYYYY' AS format, {mdy_date()} AS parsed"),
    "date_norm_named_month": f"""SELECT o_orderkey, CASE WHEN {ORDER_DATE} IS NOT NULL THEN strftime({ORDER_DATE}, '%d %b %Y')
        ELSE concat({ORDER_DAY}, ' ', {ORDER_MONTH}, '  ', year(o_orderdate)) END AS value, {ORDER_DATE} AS parsed FROM orders""",
    "date_valid": from_reg(f"COR_NUMBER, {VALID_STATE} = 'good' AS strict, ({VALID_STATE} = 'good') OR CASE WHEN COR_NUMBER LIKE '%00' OR COR_NUMBER LIKE '%03' THEN true ELSE false END AS lax"),
    "ts_norm": """SELECT event_id, CASE WHEN event_id % 6 = 5 THEN strftime(ts, '%d/%m/%Y %H:%M')
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS ts FROM events""",
    "cdm_copy": from_reg(
        "COR_NUMBER AS company_number, " + first("COR_PRINC_ADD_2", "COR_MAIL_ADD_1", "COR_MAIL_CITY") + f" AS name, {NONE} AS company_type"
    ),
    "cdm_empty": from_reg(
        "COR_NUMBER AS company_number, "
        + obj(member("uid", "COR_FEI_NUMBER"))
        + " AS company_identifiers, "
        + obj(member("unit", "COR_MAIL_ADD_2"), member("jurisdiction_of_origin", "STATE_COUNTRY"))
        + " AS all_attributes"
    ),
    "cdm_literal": from_reg(
        """nullif(RA_NAME, '') AS name, CASE WHEN concat(RA_NAME, RA_CITY) <> '' THEN 'us_fl' END AS jurisdiction_code,
        CASE WHEN concat(RA_NAME, RA_CITY) <> '' THEN '{"identifier_system_code":"us_fein"}' END AS all_attributes"""
    ),
    "cdm_nested": from_reg(
        "COR_NUMBER AS company_number, "
        + obj(member("street", "COR_PRINC_ADD_1"), member("extra", first("COR_MAIL_ADD_1", "COR_PRINC_ADD_2")))
        + " AS registered_address"
    ),
    "cdm_nested2": from_reg(
        "COR_NUMBER AS company_number, "
        + obj(holding("filing", obj(member("uid", "COR_FEI_NUMBER"), member("origin", "STATE_COUNTRY"))))
        + " AS all_attributes"
    ),
    "cdm_regex": from_reg(
        "COR_NUMBER AS company_number, "
        + obj(
            *[
                holding(str(n), obj(member("name", first(f"PRINC{n}_NAME", f"PRINC{n}_NAME_TYPE")), member("city", f"PRINC{n}_CITY")))
                for n in range(1, 7)
            ]
        )
        + " AS officers"
    ),
    "cdm_group_literal": from_reg(
        "COR_NUMBER AS company_number, "
        + obj(
            holding(
                "RA_",
                obj(
                    member("name", "RA_NAME"),
                    member("zip4", "RA_ZIP4"),
                    "CASE WHEN concat(RA_NAME, RA_ZIP4) <> '' THEN '\"position\":\"agent\"' END",
                ),
            )
        )
        + " AS officers"
    ),
    "cdm_regex_child": from_reg(
        "COR_NUMBER AS company_number, "
        + obj(
            *[
                holding(
                    str(n),
                    obj(holding("other_attributes", obj(member("type", f"PRINC{n}_NAME_TYPE"))), member("name", f"PRINC{n}_NAME")),
                )
                for n in (1, 2, 3)
            ]
        )
        + " AS officers"
    ),
    "cdm_full": from_reg(pick(FULL)),
    "cdm_isle_of_man": from_reg(
        ", ".join(f"{NONE} AS {n}" for n in FULL if n not in ISLE)
        + """, COR_NUMBER AS company_number, COR_NAME AS name, 'im' AS jurisdiction_code,
        CASE WHEN PRINC2_NAME <> '' THEN concat('[{"Name":"', PRINC2_NAME, '","Status":"', COR_STATUS, '"},{"Name":"', COR_NAME,
            '","Status":"', COR_STATUS, '"}]') END AS previous_names,
        concat('{"date_of_registration":{"value":"03 Oct ', REPORT_YEAR_1, '","format":"DD Mon YYYY","python_date_format":"%d %b %Y"}}') AS incorporation_date,
        CASE WHEN RA_NAME <> '' THEN concat('[{"Agent":"', RA_NAME, '","Address":"', RA_CITY, '"}]') END AS officers, """
        + obj(member("registry_type", "STATE_COUNTRY"))
        + " AS all_attributes"
    ),
    "norm_previous_names": from_reg("COR_NUMBER AS company_number, PRINC2_NAME AS previous_name, COR_STATUS AS status", "WHERE PRINC2_NAME <> ''")
    + " UNION ALL SELECT COR_NUMBER, COR_NAME, COR_STATUS FROM reg WHERE PRINC2_NAME <> ''",
    "norm_agents": from_reg(
        f"""COR_NUMBER AS company_number, RA_NAME AS officer_name, nullif(RA_CITY, '') AS street_address, {NONE} AS locality,
        {NONE} AS region, {NONE} AS postal_code""",
        "WHERE RA_NAME <> ''",
    ),
    "meta_stamp": from_reg(
        f"""COR_NUMBER, CASE WHEN n_nationkey % 3 = 0 THEN concat('s', n_nationkey) ELSE concat(n_name, '.zip') END AS source_name,
        'sftp' AS fetched_by, strftime(TIMESTAMP '2024-10-07 05:00:00' + to_days(n_nationkey), '%Y-%m-%dT%H:%M:%S') AS fetched_at,
        'us_fl_fixed_width_field_def_0.1' AS parsed_by, {NONE} AS cdm_mapped_by""",
        "JOIN nation ON COR_PRINC_CITY = n_name",
    ),
    "json_encode": from_reg(
        "COR_NUMBER, "
        + obj(member("name", "COR_NAME"), member("uid", "COR_FEI_NUMBER"))
        + """ AS record, concat('["', COR_NAME, '","', COR_MAIL_CITY, '"]') AS list"""
    ),
    "add_missing": "SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS BIGINT) AS size FROM orders",
    "meta_backfill": f"""SELECT key AS path, event_id % 3 <> 1 AS named,
        CASE WHEN event_id % 3 = 1 THEN concat('old', event_id) ELSE split_part(key, '/', -1) END AS source_name, 'daily' AS periodicity
        FROM ({EVENT_FILE})""",
    "split_valid": from_reg(pick(SPLIT), f"WHERE {VALID}"),
    "split_invalid": from_reg(pick(SPLIT), f"WHERE NOT {VALID}"),
    "route_counts": from_reg(f"CASE WHEN {VALID} THEN 'stg_us_fl' ELSE 'stg_us_fl_invalid' END AS table, count(*) AS rows", "GROUP BY 1"),
    "route_write": from_reg(pick(FULL) + f", CASE WHEN {VALID} THEN 'valid' ELSE 'invalid' END AS route"),
    "load_routes": from_reg(
        ", ".join(f"CAST({FULL[n]} AS TIMESTAMP) AS {n}" if n in STAMPS else f"{FULL[n]} AS {n}" for n in FULL)
        + f", CASE WHEN COR_PRINC_STATE = 'FL' THEN 'r1' ELSE 'r2' END AS run, CASE WHEN {VALID} THEN 'valid' ELSE 'invalid' END AS route"
    ),
    "source_append": from_reg(f"*, {REG_HASH} AS hash, CASE WHEN COR_PRINC_STATE <> 'FL' THEN 'second' END AS load"),
    "evolve_types": """WITH o AS (
            SELECT *, concat('o', o_orderkey) AS id, o_orderkey % 10 = 3 AS no_units, o_orderkey % 7 = 2 AS no_day FROM orders)
        SELECT 'row' AS kind, concat('n', n_nationkey) AS id, concat('', n_nationkey) AS units, concat(n_regionkey, '.00') AS share, '2024-01-01' AS day,
               'bigint,decimal(38,2),date' AS types, NULL AS text FROM nation
        UNION ALL SELECT 'row', id,
            CASE WHEN no_units THEN NULL WHEN o_orderkey % 10 = 4 THEN concat('90000', lpad(concat('', o_orderkey), 8, '0')) ELSE concat('', o_orderkey) END,
            concat(o_orderkey, '.', lpad(concat('', o_custkey % 100), 2, '0')), CASE WHEN NOT no_day THEN strftime(o_orderdate, '%Y-%m-%d') END,
            'bigint,decimal(38,2),date', NULL FROM o
        UNION ALL SELECT 'cell units', id, NULL, NULL, NULL, 'bigint', concat(o_orderkey, ' units') FROM o WHERE no_units
        UNION ALL SELECT 'cell day', id, NULL, NULL, NULL, 'date', 'soon' FROM o WHERE no_day""",
    "files_diff": "SELECT concat('o', o_orderkey, '.txt') AS name FROM orders WHERE o_orderstatus = 'F'",
    "files_diff_ts": """SELECT concat('o', o_orderkey, '.txt') AS name FROM orders
        WHERE o_orderstatus = 'F' OR o_orderkey % 10 = 7 OR o_orderkey % 4 = 1""",
    "manifest_scan": f"""WITH manifest AS ({MANIFEST}), wanted AS ({WANTED})
        SELECT ingest_config, concat('src/', r_regionkey) AS path, name FROM wanted""",
    "workload_scan": f"""WITH manifest AS ({MANIFEST}), wanted AS ({WANTED})
        SELECT jurisdiction, concat('src/', r_regionkey, '/', name) AS object_key, periodicity,
        CASE WHEN check_timestamp THEN c_custkey * 1000 ELSE 0 END AS timestamp, 'NEW' AS status, ingest_config FROM wanted
        WHERE c_acctbal >= 5000 OR (check_timestamp AND c_custkey % 2 = 1)""",
    "group_paths": """SELECT event_type AS object_key, CASE WHEN value < 1 THEN 'stg_us_fl_invalid' ELSE 'stg_us_fl' END AS target,
        true AS bounded, true AS ordered, concat('lake/', lpad(concat('', event_id), 12, '0')) AS path FROM events""",
    "size_minmax": """WITH s AS (SELECT l_orderkey * 7 % 100003 AS size FROM lineitem)
        SELECT min(size) FILTER (size <> 0) AS min_size, max(size) FILTER (size <> 0) AS max_size FROM s""",
    "ledger_filter": f"""SELECT object_key, status, timestamp FROM ({TASKS}) WHERE starts_with(object_key, 'click/') AND status = 'PREPARING'
        ORDER BY object_key LIMIT 99""",
    "ledger_new": f"SELECT object_key, status FROM ({TASKS}) WHERE status IS NULL OR status = 'NEW'",
    "ledger_transition": f"""WITH t AS (SELECT *, event_type <> 'error' AS asked,
        event_type <> 'error' AND (event_id % 3 = 0 OR coalesce(status = 'NEW', false)) AS takes,
        event_type <> 'error' AND event_id % 6 = 0 AS again FROM ({TASKS}))
        SELECT object_key, CASE WHEN again THEN 'PROCESSED' WHEN takes THEN CASE WHEN event_id % 2 = 0 THEN 'PREPARING' ELSE 'ERROR' END
            ELSE status END AS status,
        CASE WHEN again THEN '2024-10-08T00:00:00' WHEN takes THEN '2024-10-07T00:00:00' ELSE timestamp END AS timestamp,
        CASE WHEN asked THEN takes END AS applied FROM t""",
    "ledger_transition_hot": """WITH asked AS (
            SELECT CASE WHEN event_id % 3 = 0 THEN 'busy' ELSE concat('t', event_id % 50) END AS object_key, event_id,
            {'s': concat('S', event_id * 7 % 11 % 5), 'f': CASE WHEN event_id % 101 <> 7 THEN concat('S', event_id * 5 % 13 % 5) END,
             'at': concat('at', event_id)} AS c FROM events),
        done AS (
            SELECT object_key, list_reduce(list_prepend({'s': 'S1', 'f': NULL, 'at': 'none'}, list(c ORDER BY event_id)),
                lambda x, y: CASE WHEN y.f IS NULL OR y.f = x.s THEN y ELSE x END) AS e FROM asked GROUP BY object_key)
        SELECT object_key, e.s AS status, e.at AS timestamp, e.at <> 'none' AS applied FROM done""",
    "ledger_upsert": f"""SELECT object_key, coalesce(status, 'NEW') AS status, timestamp FROM ({TASKS})
        UNION ALL SELECT concat('nation/', n_name), 'NEW', '' FROM nation""",
    "head_samples": """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
        SELECT o_orderkey, CAST(s AS BIGINT) AS sample FROM r, (SELECT unnest([1000, 2000, 5000, 10000, 20000, 50000, 100000,
            200000, 500000, 1000000]) AS s) WHERE n <= s""",
    "sample_files": """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
        SELECT concat('orders_', s, '.csv') AS file, concat('', o_orderkey) AS o_orderkey, o_orderpriority FROM r, (SELECT unnest([1000, 2000, 5000, 10000,
            20000, 50000, 100000, 200000, 500000, 1000000]) AS s) WHERE n <= s""",
    "rule_versions": REG + """, f AS (SELECT *, CAST(substring(COR_NUMBER, 2) AS BIGINT) % 3 = 0 AS im, CAST(substring(COR_NUMBER, 2) AS BIGINT) % 5 AS v FROM reg),
        r AS (SELECT *, v <> 3 AS known, v <> 3 AND v <> 0 AS newer FROM f)
        SELECT CASE WHEN known THEN 'record' ELSE 'quarantine' END AS route, CASE WHEN known THEN COR_NUMBER END AS company_number,
            CASE WHEN known THEN COR_NAME END AS name, CASE WHEN NOT im AND known THEN 'us_fl' WHEN im AND newer THEN 'im' END AS jurisdiction_code,
            CASE WHEN NOT im AND newer THEN COR_STATUS END AS current_status, CASE WHEN im AND newer THEN nullif(STATE_COUNTRY, '') END AS company_type,
            CASE WHEN NOT im AND newer AND COR_FEI_NUMBER <> '' THEN concat('{"uid":"', COR_FEI_NUMBER, '"}') END AS company_identifiers,
            CASE WHEN newer THEN 'mapping:2' WHEN known THEN 'mapping:1' WHEN im THEN 'cdm_mapping_rules/im/jsonlines/v9/cdm_mapping_im.json'
                ELSE 'cdm_mapping_rules/us_fl/csv/v9/cdm_mapping_us_fl.json' END AS cdm_mapping_rules,
            concat('in/', COR_NUMBER) AS path FROM r""",
    "norm_company": from_reg(
        f"""COR_NUMBER AS company_number, COR_NAME AS name, 'us_fl' AS jurisdiction_code, COR_STATUS AS current_status,
        COR_FILING_TYPE AS company_type, {mdy_date()} AS incorporation_date, CAST(NULL AS DATE) AS dissolution_date,
        {NONE} AS registry_url, {NONE} AS registered_address, TIMESTAMP '2024-10-07 05:00:00' AS retrieved_at"""
    ),
    "norm_officer": registry_officers(False),
    "norm_officer_address": registry_officers(True),
    "norm_address": REG + address_rows("COR_MAIL", "mailing") + " UNION ALL " + address_rows("COR_PRINC", "headquarters"),
    "norm_identifier": from_reg("COR_NUMBER AS company_number, 'us_fein' AS identifier_system_code, COR_FEI_NUMBER AS uid", "WHERE COR_FEI_NUMBER <> ''"),
    "norm_attributes": from_reg(
        f"""COR_NUMBER AS company_number, nullif(STATE_COUNTRY, '') AS jurisdiction_of_origin, {NONE} AS registry_type,
        {NONE} AS presence_of_charges, {NONE} AS is_in_liquidation, {NONE} AS receiver_appointed, {NONE} AS documents,
        {NONE} AS liquidator, {NONE} AS receiver"""
    ),
    "join_address": from_reg(
        """COR_NUMBER, nullif(concat_ws(', ', nullif(COR_MAIL_ADD_1, ''), nullif(COR_MAIL_ADD_2, '')), '') AS street_address,
        nullif(concat_ws('-', nullif(RA_ZIP5, ''), nullif(RA_ZIP4, '')), '') AS postal_code"""
    ),
    "share_view": from_reg(pick(SHARED), "WHERE COR_FILING_TYPE = 'FLAL'"),
    "stream_ingest": from_reg(
        pick([n for n in FULL if n != "source_name"]) + f", CASE WHEN {VALID} THEN 'valid' ELSE 'invalid' END AS route"
    ),
    "stream_redelivered": from_reg(
        pick(["company_number", "name", "hash"])
        + f", CASE WHEN {VALID} THEN 'valid' ELSE 'invalid' END AS route, CAST(2 * (SELECT count(*) FROM reg WHERE COR_PRINC_STATE = 'FL') AS BIGINT) AS left_out"
    ),
}
