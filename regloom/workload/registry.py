"""A registry file derived from the customer, nation and supplier tables.

Every column is one SQL expression that Spark and DuckDB read alike, so a query
and the SQL it is checked against start from the same rows.  Dates come in every
state a registry has them in: padded, unpadded, impossible, cut short, empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regloom.jurisdictions import layout_for
from regloom.session import spread

KEY = "c_custkey"
APOSTROPHE = "chr(39)"


def text(number: str) -> str:
    return f"concat('', {number})"


def padded(number: str, width: int) -> str:
    return f"lpad({text(number)}, {width}, '0')"


def blank_when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN '' ELSE {value} END"


YEAR, MONTH, DAY = f"1950 + {KEY} % 70", f"{KEY} % 12 + 1", f"{KEY} % 28 + 1"
FILE_DATE = f"""CASE {KEY} % 7
    WHEN 0 THEN concat({padded(MONTH, 2)}, {padded(DAY, 2)}, {text(YEAR)})
    WHEN 1 THEN concat({text(MONTH)}, {text(DAY)}, {text(YEAR)})
    WHEN 2 THEN '02302020'
    WHEN 3 THEN {text(YEAR)}
    WHEN 4 THEN ''
    WHEN 5 THEN concat({padded(MONTH, 2)}, {text(DAY)}, {text(YEAR)})
    ELSE concat({padded(MONTH, 2)}, '31', {text(YEAR)}) END"""
STATE = "CASE WHEN c_nationkey % 2 = 0 THEN 'FL' ELSE 'GA' END"
NO_MAIL, NO_AGENT = f"{KEY} % 4 = 1", f"{KEY} % 5 = 2"
NO_SECOND, NO_THIRD = f"{KEY} % 2 = 1", f"{KEY} % 10 <> 3"
SUITE = f"CASE WHEN {KEY} % 3 = 0 THEN concat('SUITE ', {text(f'{KEY} % 50')}) ELSE '' END"

FILLED = {
    "COR_NUMBER": f"concat('C', {padded(KEY, 11)})",
    "COR_NAME": f"""concat(c_name, CASE WHEN {KEY} % 5 = 0 THEN concat(' O', {APOSTROPHE}, 'NEIL')
        WHEN {KEY} % 11 = 3 THEN concat(' CAF', chr(201)) ELSE ' LLC' END)""",
    "COR_STATUS": "CASE WHEN c_acctbal < 0 THEN 'I' ELSE 'A' END",
    "COR_FILING_TYPE": f"CASE WHEN {KEY} % 4 = 0 THEN 'FLAL' ELSE c_mktsegment END",
    "COR_PRINC_ADD_1": f"concat({text(f'{KEY} % 997 + 1')}, ' MARKET STREET')",
    "COR_PRINC_ADD_2": SUITE,
    "COR_PRINC_CITY": "n_name",
    "COR_PRINC_STATE": STATE,
    "COR_PRINC_ZIP": padded(f"{KEY} % 99999", 5),
    "COR_PRINC_COUNTRY": "'US'",
    "COR_MAIL_ADD_1": blank_when(NO_MAIL, f"concat('PO BOX ', {text(KEY)})"),
    "COR_MAIL_ADD_2": blank_when(NO_MAIL, SUITE),
    "COR_MAIL_CITY": blank_when(NO_MAIL, "n_name"),
    "COR_MAIL_STATE": blank_when(NO_MAIL, STATE),
    "COR_FILE_DATE": FILE_DATE,
    "COR_FEI_NUMBER": blank_when(f"{KEY} % 6 = 0", padded(f"{KEY} * 7 + 1", 9)),
    "MORE_THAN_SIX_OFF_FLAG": "'N'",
    "STATE_COUNTRY": blank_when(f"{KEY} % 8 = 0", STATE),
    "REPORT_YEAR_1": text(f"2000 + {KEY} % 25"),
    "RA_NAME": blank_when(NO_AGENT, "coalesce(s_name, '')"),
    "RA_NAME_TYPE": blank_when(NO_AGENT, "'C'"),
    "RA_ADD_1": blank_when(NO_AGENT, f"concat({text(f'{KEY} % 89 + 1')}, ' AGENT ROAD')"),
    "RA_CITY": blank_when(NO_AGENT, "n_name"),
    "RA_STATE": blank_when(NO_AGENT, STATE),
    "RA_ZIP5": blank_when(NO_AGENT, padded(f"{KEY} % 90000", 5)),
    "RA_ZIP4": blank_when(f"{NO_AGENT} OR {KEY} % 3 <> 1", "'0001'"),
    "PRINC1_TITLE": "'MGR'",
    "PRINC1_NAME_TYPE": "'P'",
    "PRINC1_NAME": blank_when(f"{KEY} % 9 = 0", "concat('FIRST ', c_name)"),
    "PRINC1_CITY": "n_name",
    "PRINC1_ZIP5": padded(f"{KEY} % 80000", 5),
    "PRINC2_NAME_TYPE": blank_when(NO_SECOND, "'P'"),
    "PRINC2_NAME": blank_when(NO_SECOND, "concat('SECOND ', c_name)"),
    "PRINC2_ADD_1": blank_when(NO_SECOND, f"concat({text(f'{KEY} % 53 + 1')}, ' SIDE STREET')"),
    "PRINC3_NAME": blank_when(NO_THIRD, "concat('THIRD ', c_name)"),
    "PRINC4_TITLE": blank_when(f"{KEY} % 13 <> 4", "'SEC'"),
    "PRINC4_NAME_TYPE": blank_when(f"{KEY} % 13 <> 4", "'C'"),
    "PRINC4_NAME": blank_when(f"{KEY} % 26 <> 4", "concat('FOURTH ', c_name)"),
    "PRINC5_NAME": blank_when(f"{KEY} % 17 <> 5", f"concat('FIFTH O', {APOSTROPHE}, c_name)"),
    "PRINC5_ZIP5": blank_when(f"{KEY} % 17 <> 5", padded(f"{KEY} % 70000", 5)),
    "PRINC5_ZIP4": blank_when(f"{KEY} % 34 <> 5", "'0005'"),
    "PRINC6_CITY": blank_when(f"{KEY} % 19 <> 6", "n_name"),
    "PRINC6_STATE": blank_when(f"{KEY} % 19 <> 6", STATE),
    "COR_MAIL_ZIP": blank_when(NO_MAIL, padded(f"{KEY} % 88888", 5)),
    "COR_MAIL_COUNTRY": blank_when(NO_MAIL, "'US'"),
    "LAST_TRX_DATE": blank_when(f"{KEY} % 3 = 0", f"concat({padded(MONTH, 2)}, {padded(DAY, 2)}, {text(YEAR)})"),
    "HOUSE_FLAG_1": "'N'",
    "REPORT_DATE_1": f"concat({padded(MONTH, 2)}, {padded(DAY, 2)}, {text(YEAR)})",
    "REPORT_YEAR_2": blank_when(f"{KEY} % 2 = 0", text(f"2001 + {KEY} % 25")),
    "HOUSE_FLAG_2": blank_when(f"{KEY} % 2 = 0", "'Y'"),
    "REPORT_DATE_3": blank_when(f"{KEY} % 5 <> 1", "'01312024'"),
}


def columns() -> dict[str, str]:
    """All layout columns, in file order, with their expressions."""
    return {name: FILLED.get(name, "''") for name in layout_for("us_fl").names}


# A supplier agent serves 15 neighbouring customers, so no agent is a hot key.
AGENT_KEY = f"CAST(({KEY} - {KEY} % 15) / 15 AS BIGINT)"

REGISTRY_SQL = "SELECT {columns} FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_suppkey = " + AGENT_KEY


def registry_sql() -> str:
    return REGISTRY_SQL.format(columns=",\n".join(f"{e} AS {n}" for n, e in columns().items()))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession, sf_dir: str, wanted: list[str] | None = None) -> DataFrame:
    """The registry rows as text columns."""
    customer = spread(read_table(spark, sf_dir, "customer"))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    keyed = customer.selectExpr("*", f"{AGENT_KEY} AS agent_key")
    joined = keyed.join(nation, keyed["c_nationkey"] == nation["n_nationkey"])
    joined = joined.join(supplier, joined["agent_key"] == supplier["s_suppkey"], "left")
    return joined.selectExpr(*[f"{e} AS {n}" for n, e in columns().items() if wanted is None or n in wanted])
