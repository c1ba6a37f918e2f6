"""Port tables derived from the given tables, one SELECT per table.

Every row of the source table yields one row of the derived table. The text is
plain SQL that both Spark and the oracle's engine read; ``{lineitem}`` and the
like stand for the given tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

CUSTOMERS = [
    "DARDANEL", "IOT", "AMIRANTE", "OCEAN BASKET", "ISLAND CATCH",
    "INPESCA S.A", "ALBACORA SA", "CFTO S.A.", "SAPMER", "PRINCESS TUNA",
]

# Base price of each service.
BASE_PRICES = {
    "CCCS Movement in/out": "3.500",
    "Loading (Quay to Ship)": "12.250",
    "Loading @ Zone 14": "9.750",
    "Tipping Truck": "7.100",
    "Loading to Cargo": "8.400",
    "Loading to Cargo - Brine": "21.000",
    "Loading to Cargo - Dry": "23.000",
    "Transfer of by-catch": "6.300",
    "Cross Stuffing": "14.000",
    "Unstuffing by Hand": "16.500",
    "Unstuffing to Cargo": "15.250",
    "Unstuffing to CCCS": "13.750",
    "CCCS (By-Catch)": "18.000",
    "Shore Crane & Fishloader": "11.000",
    "Shore Crane & Fishloader (by catch)": "10.500",
    "Static Loader": "5.200",
    "Container Stuffing by Hand": "19.000",
    "Container Stuffing with Forklift": "17.000",
    "Shore Crane": "85.000",
    "Shifting": "45.000",
    "Plugin": "25.000",
    "PTI S Freezer": "90.000",
    "PTI Magnum": "80.000",
    "PTI Standard": "60.000",
    "Electricity Price Standard": "70.000",
    "Electricity Price S Freezer": "110.000",
    "Electricity Price Magnum": "100.000",
    "Container Cleaning": "35.000",
    "Stuffing": "20.000",
    "Monitoring": "30.000",
    "Pallets": "6.000",
    "Pallets(+ Wedges) Usage": "7.500",
    "Plastic Liner Installation": "55.000",
    "Haulage FEU": "120.000",
    "Haulage TEU": "95.000",
    "Rental of Calibration": "50.000",
    "Tare Calibration": "75.000",
    "Well to Well Transfer": "17.000",
    "Transhipment - Brine": "26.000",
    "Transhipment - Dry": "27.000",
    "Unload to CCCS - Brine": "22.000",
    "Unload to CCCS - Dry": "24.000",
    "Unload to Quay - Brine": "18.000",
    "Unload to Quay - Dry": "19.000",
    "Container Stuffing - Brine": "28.000",
    "Container Stuffing - Dry": "29.000",
    "Full OSS - Brine": "31.000",
    "Full OSS - Dry": "32.000",
    "Basic OSS - Brine": "33.000",
    "Basic OSS - Dry": "34.000",
}
# Services whose first price starts after some of the rows that ask for it.
LATE_PRICES = {"Extra Men": "2.500", "Additional Overtime": "14.000"}


def pick(number: str, names: list[str]) -> str:
    """One of the names by a number that is taken modulo their count."""
    cases = " ".join(f"WHEN {i} THEN '" + n.replace("'", "''") + "'" for i, n in enumerate(names))
    return f"CASE ({number}) % {len(names)} {cases} END"


def day_number(column: str) -> str:
    """Days from 2025-06-01, 0 to 330, in the order of the source dates."""
    number = f"(year({column}) - 1995) * 372 + (month({column}) - 1) * 31 + day({column}) - 1"
    return f"CAST(floor(({number}) / 8) AS INT)"


def day(column: str) -> str:
    """A date between 2025-06-01 and 2026-04-30 that keeps the order of the source dates."""
    return f"(DATE '2025-06-01' + {day_number(column)})"


def clock(number: str) -> str:
    """A time of day within a few seconds of a quarter of an hour, in seconds."""
    return f"greatest(0, CAST(({number}) % 96 AS INT) * 900 + CAST(({number}) % 5 AS INT) - 1)"


def tonnes(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,3))"


def tonnes_text(expression: str) -> str:
    return f"CAST({tonnes(expression)} AS STRING)"


def container(key: str) -> str:
    """A container number with a right check digit."""
    digits = " + ".join(
        f"CAST(floor(({key}) / {10 ** (5 - i)}) AS BIGINT) % 10 * {2 ** (4 + i)}" for i in range(6)
    )
    # What each prefix adds to the check sum.
    start = f"CASE ({key}) % 4 WHEN 0 THEN 378 WHEN 1 THEN 406 WHEN 2 THEN 449 ELSE 391 END"
    prefix = pick(key, ["MNBU", "SUDU", "TTNU", "CNIU"])
    return (
        f"({prefix} || lpad(CAST(({key}) % 1000000 AS STRING), 6, '0') || "
        f"CAST(CAST(({start} + {digits}) % 11 % 10 AS INT) AS STRING))"
    )


# What each later date of a price list adds to the base price.
PRICE_RISES = {"2024-01-01": "0.000", "2025-11-10": "0.500", "2026-02-01": "1.000"}


def dated_prices(base: dict[str, str], rises: dict[str, str]) -> str:
    """A price list as VALUES: every base price on every date, with that date's rise."""
    rows = ", ".join(
        f"('{service}', {Decimal(price) + Decimal(rise)}, DATE '{since}')"
        for service, price in base.items()
        for since, rise in rises.items()
    )
    return f"""
        SELECT service, CAST(price AS DECIMAL(12,3)) AS price, date
        FROM (VALUES {rows}) AS p(service, price, date)"""


def _prices() -> str:
    return f"""
        SELECT service, price, date, CAST(NULL AS DATE) AS end_date,
               CASE WHEN service LIKE '% - %' THEN 'Net List' ELSE 'Other' END AS class
        FROM ({dated_prices(BASE_PRICES, PRICE_RISES)}
              UNION ALL {dated_prices(LATE_PRICES, {"2025-09-15": "0.000"})}) q
    """


# The given tables with the values that several derived columns are made of.
LINES = f"""(
    SELECT *, {day("l_shipdate")} AS line_day, {day_number("l_shipdate")} AS line_day_number,
           {clock("l_orderkey * 37 + l_partkey * 11 + l_linenumber")} AS line_clock,
           {container("l_partkey")} AS line_box, 'Vessel ' || CAST(l_suppkey % 12 AS STRING) AS line_vessel,
           {pick("l_suppkey * 7 + l_partkey", CUSTOMERS)} AS line_customer,
           (l_orderkey + l_partkey) % 10 AS line_kind, CAST(l_quantity * 137 AS BIGINT) AS line_kilos
    FROM {{lineitem}}) l"""
ORDERS = f"""(
    SELECT *, {day("o_orderdate")} AS order_day, {clock("o_orderkey * 7 + o_custkey")} AS order_clock,
           {container("o_custkey")} AS order_box,
           'VESSEL ' || CAST(o_orderkey % 12 AS STRING) AS order_vessel,
           {pick("o_custkey + o_orderkey", CUSTOMERS)} AS order_customer
    FROM {{orders}}) o"""
LINE_DAY, ORDER_DAY = "line_day", "order_day"
LINE_VESSEL, ORDER_VESSEL = "line_vessel", "order_vessel"
LINE_CUSTOMER, ORDER_CUSTOMER = "line_customer", "order_customer"
LINE_CLOCK, ORDER_CLOCK = "line_clock", "order_clock"
LINE_BOX, ORDER_BOX = "line_box", "order_box"
KIND, KILOS = "line_kind", "line_kilos"
STORAGE = "CASE WHEN l_returnflag = 'A' THEN 'Brine' ELSE 'Dry' END"
SHORT = ["DARDANEL", "IOT", "AMIRANTE", "OCEAN BASKET", "ISLAND CATCH", "INPESCA", "ALBACORA",
         "CFTO", "SAPMER", "PRINCESS TUNA"]
DESTINATION = f"""CASE {KIND}
    WHEN 4 THEN 'IOT' WHEN 5 THEN 'DARDANEL FACTORY' WHEN 6 THEN 'Asian Marine Reefer'
    WHEN 7 THEN 'Vessel 8' WHEN 8 THEN {LINE_BOX} WHEN 9 THEN {LINE_BOX}
    ELSE 'CCCS (' || {pick("l_suppkey * 7 + l_partkey", SHORT)} || ')' END"""
LABEL = pick("l_orderkey + l_linenumber", ["normal hours", "overtime 150%", "overtime 200%", "pending"])
COLD_SERVICE = pick(
    "l_orderkey + l_partkey",
    ["Sorting from Unloading", "Sorting from Unloading", "Unsorted from Unloading",
     "Unsorted from Unloading", "Bin Dispatch to IOT", "Bin Dispatch from IOT",
     "Dispatch to Cargo Vessel", "Dispatch from Cargo Vessel", "From CCCS to Vessel",
     "Salt Storage"],
)
WEEK = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun", "PH"]
END_CLOCK = "least(86399, {0} + CAST({1} % 40 AS INT) * 900)"

TABLES = {
    "price": _prices(),
    "client": f"""
        SELECT 'VESSEL ' || CAST(s_suppkey % 12 AS STRING) AS vessel_client,
               CASE WHEN s_suppkey % 12 = 8 THEN 'CARGO' WHEN s_suppkey % 12 = 9 THEN 'LONGLINER'
                    ELSE 'THONIER' END AS type,
               {pick("s_suppkey", CUSTOMERS)} AS customer
        FROM {{supplier}}
        UNION ALL SELECT 'AMIRANTE', 'BYCATCH', 'AMIRANTE'
        UNION ALL SELECT 'OCEAN BASKET', 'BYCATCH', 'OCEAN BASKET'
        UNION ALL SELECT 'ISLAND CATCH', 'BYCATCH', 'ISLAND CATCH'
    """,
    "unloading_raw": f"""
        SELECT {pick("l_orderkey", WEEK)} AS day, {LINE_DAY} AS date, {LINE_CLOCK} AS time,
               {LINE_VESSEL} AS vessel,
               {pick("l_partkey", ["Skipjack - Frozen", "Yellowfin - 10kg - up", "Mixed"])} AS species,
               'well ' || CAST(l_linenumber AS STRING) AS details,
               CASE WHEN {KILOS} >= 1000
                    THEN CAST(CAST(floor({KILOS} / 1000) AS BIGINT) AS STRING) || ','
                         || lpad(CAST({KILOS} % 1000 AS STRING), 3, '0')
                    ELSE CAST({KILOS} AS STRING) END AS scale_reading,
               {STORAGE} AS storage, {DESTINATION} AS destination, {LABEL} AS overtime,
               CASE WHEN day({LINE_DAY}) = 11 THEN CAST(NULL AS STRING)
                    ELSE {pick("l_linenumber + l_orderkey", ["Port", "Starboard", "Port, aft"])} END AS side_working
        FROM {LINES}
    """,
    "unloading_summary": f"""
        SELECT {LINE_DAY} AS date, {LINE_VESSEL} AS vessel, {LINE_CLOCK} AS start_time,
               {END_CLOCK.format(LINE_CLOCK, "l_partkey")} AS end_time,
               {DESTINATION} AS destination, {LABEL} AS overtime, {STORAGE} AS storage_type,
               {tonnes("l_quantity * 0.137")} AS total_tonnage
        FROM {LINES}
    """,
    "unloading_sheet": f"""
        SELECT CASE l_orderkey % 211 WHEN 0 THEN 'tbc' WHEN 1 THEN ' ' ELSE CAST({LINE_DAY} AS STRING) END AS date,
               {LINE_VESSEL} AS vessel,
               CASE WHEN l_linenumber = 7 AND l_partkey % 5 = 0 THEN 'noon' ELSE CAST({LINE_CLOCK} AS STRING) END AS start_time,
               CAST({END_CLOCK.format(LINE_CLOCK, "l_partkey")} AS STRING) AS end_time,
               {DESTINATION} AS destination, {LABEL} AS overtime, {STORAGE} AS storage_type,
               CASE l_suppkey % 97 WHEN 0 THEN '12;5' WHEN 1 THEN '' ELSE ' ' || {tonnes_text("l_quantity * 0.137")} END
                   AS total_tonnage
        FROM {LINES}
    """,
    "cold_store": f"""
        SELECT {pick("line_day_number", WEEK)} AS day, {LINE_DAY} AS date,
               CASE WHEN l_linestatus = 'O' THEN 'OUT' ELSE 'IN' END AS movement_type,
               {LINE_CUSTOMER} AS customer,
               'hatch ' || CAST(l_linenumber AS STRING) AS origin, upper({LINE_VESSEL}) AS vessel,
               {STORAGE} AS storage_type, {COLD_SERVICE} AS operation_type,
               CASE WHEN {KIND} >= 4 THEN '-' ELSE ' ' END || {tonnes_text("l_quantity * 0.129")}
                   AS total_tonnage,
               CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_linenumber AS STRING) END AS bins_in,
               CASE WHEN l_linenumber = 2 THEN '' ELSE '-' || CAST(l_linenumber AS STRING) END
                   AS bins_out,
               CASE WHEN l_linenumber > 4 THEN {tonnes_text("l_quantity * 0.031")} ELSE '' END
                   AS static_loader,
               CASE WHEN l_linenumber % 3 = 0 THEN '' WHEN l_linenumber = 7 THEN 'n/a'
                    ELSE {tonnes_text("l_quantity * 0.025")} || ' ' END AS overtime_tonnage
        FROM {LINES}
    """,
    "cross_stuffing": f"""
        SELECT {pick("l_orderkey + l_partkey", WEEK)} AS day, {LINE_CUSTOMER} AS vessel_client,
               {LINE_DAY} AS date, {LINE_BOX} AS origin,
               {container("l_suppkey")} AS destination, {LINE_CLOCK} AS start_time,
               {END_CLOCK.format(LINE_CLOCK, "l_partkey")} AS end_time,
               {tonnes_text("l_quantity * 0.111")} AS total_tonnage,
               CASE WHEN l_linenumber = 3 THEN '' ELSE {tonnes_text("l_quantity * 0.043")} END
                   AS overtime_tonnage,
               CASE WHEN l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS is_origin_empty,
               {pick("l_linenumber", ["Cross Stuffing", "Unstuffing by Hand", "Unstuffing to Cargo",
                                      "Unstuffing to CCCS"])} AS service,
               {LINE_CUSTOMER} AS charged
        FROM {LINES}
    """,
    "by_catch_transfer": f"""
        SELECT {ORDER_DAY} AS date,
               CASE WHEN o_orderkey % 2 = 0 THEN 'OUT' ELSE 'IN' END AS movement_type,
               {pick("o_custkey", ["AMIRANTE", "OCEAN BASKET", "ISLAND CATCH"])} AS customer,
               {ORDER_VESSEL} AS vessel,
               CASE WHEN o_orderstatus = 'F' THEN 'CCCS (By-Catch)' ELSE 'Transfer of by-catch' END
                   AS service,
               CASE WHEN o_orderstatus = 'P' THEN 'Brine' ELSE 'Dry' END AS storage_type,
               {tonnes_text("(o_custkey % 40 + 1) * 0.129")} AS total_tonnage,
               CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE {tonnes_text("(o_custkey % 40 + 1) * 0.025")}
                    END AS overtime_tonnage
        FROM {ORDERS}
    """,
    "cccs_stuffing": f"""
        SELECT {LINE_DAY} AS date, {LINE_BOX} AS container_number,
               {LINE_CUSTOMER} AS customer,
               {pick("l_linenumber + l_orderkey", ["Shore Crane & Fishloader",
                     "Shore Crane & Fishloader (by catch)", "Static Loader",
                     "Container Stuffing by Hand", "Container Stuffing with Forklift"])} AS service,
               {tonnes_text("l_quantity * 0.207")} AS total_tonnage,
               CASE WHEN l_linenumber = 4 THEN ' ' ELSE {tonnes_text("l_quantity * 0.051")} END
                   AS overtime_tonnage,
               {LINE_CUSTOMER} AS charged
        FROM {LINES}
    """,
    "container_ops": f"""
        SELECT CASE WHEN l_orderkey % 10 = 3 THEN 'Ocean Basket' ELSE {LINE_VESSEL} END
                   AS vessel_client,
               {pick("l_partkey + l_orderkey", ["IOT", "MAERSKLINE", "CMA CGM", "AMIRANTE"])} AS customer,
               {LINE_DAY} + CAST(l_linenumber % 3 AS INT) AS date_plugged, {LINE_CLOCK} AS time_plugged,
               {LINE_BOX} AS container_number,
               {pick("l_orderkey", ["Full OSS", "Container Stuffing", "Basic OSS", "Basic OSS",
                                    "CCCS Stuffing", "Direct Transfer", "Exchange of Hands",
                                    "Stuffing"])} AS operation_type,
               {pick("l_orderkey + l_partkey", ["IOT", "MAERSK", "CMA CGM"])} AS shipping_line,
               {pick("l_partkey", ["Full", "Partial", "Completed"])} AS plugged_status,
               {tonnes("(l_partkey % 300) * 0.087")} AS tonnage,
               CASE l_orderkey % 4 WHEN 0 THEN -60 WHEN 1 THEN -35 WHEN 2 THEN -25 ELSE -18 END
                   AS set_point,
               CASE WHEN l_orderkey % 11 = 0 THEN CAST(NULL AS DATE)
                    ELSE {LINE_DAY} + CAST(l_linenumber % 3 + l_partkey % 20 AS INT) END AS date_out,
               {pick("l_orderkey * 3 + l_partkey", ["LML", "For Completion", "On Plug", "Plugin Only",
                     "IOT", "Fishing Port", "Exchange of Hands"])} AS location
        FROM {LINES}
    """,
    "liner_pallet": f"""
        SELECT {ORDER_DAY} AS date, {ORDER_BOX} AS container_number,
               {pick("o_orderkey", ["IOT", "MAERSK", "CMA CGM", "SAPMER"])} AS shipping_line,
               lower({ORDER_CUSTOMER}) AS assigned_to,
               {pick("o_custkey", ["Pallet", "Liner & Pallet", "Liner"])} AS remarks
        FROM {ORDERS}
    """,
    "container_shifting": f"""
        SELECT {ORDER_DAY} AS date, {ORDER_BOX} AS container_number,
               {pick("o_orderkey", ["IOT", "MAERSKLINE", "INVALID", "CMA CGM"])} AS billed_to,
               o_orderpriority AS service_remarks
        FROM {ORDERS}
    """,
    "pti": f"""
        SELECT ts AS datetime_start,
               ts + INTERVAL '1' MINUTE * CAST(floor(value * 9) AS INT) AS datetime_end,
               {container("user_id")} AS container_number,
               {pick("event_id", ["-25", "-35", "-60"])} AS set_point,
               {pick("event_id + user_id", ["Carrier", "Daikin", "Thermo King"])} AS unit_manufacturer,
               {pick("event_id", ["PASSED", "FAILED"])} AS status,
               {pick("event_id + user_id", ["MAERSKLINE", "IOT", "INVALID", "CMA CGM"])} AS billed_to,
               event_type AS plugged_on
        FROM {{events}}
    """,
    "washing": f"""
        SELECT {ORDER_DAY} AS date, {ORDER_BOX} AS container_number,
               {pick("o_orderkey + o_custkey", ["CMA CGM", "IOT", "INVALID", "IPHS", "SAPMER"])}
                   AS billed_to,
               o_orderpriority AS service_remarks
        FROM {ORDERS}
    """,
    "shore_crane": f"""
        SELECT {pick("o_orderkey", WEEK)} AS day, {ORDER_DAY} AS date, {ORDER_CLOCK} AS start_time,
               {END_CLOCK.format(ORDER_CLOCK, "o_custkey")} AS end_time,
               CAST(o_custkey % 12 AS INT) * 3600 + CAST(o_orderkey % 60 AS INT) * 60 AS hours,
               CAST(o_custkey % 5 AS INT) * 1800 AS overtime_hours,
               {ORDER_CUSTOMER} AS customer, 'Quay ' || CAST(o_orderkey % 4 AS STRING) AS location,
               o_orderpriority AS operation_type, o_orderstatus AS remarks,
               {ORDER_CUSTOMER} AS charged_to
        FROM {ORDERS}
    """,
    "transfer": f"""
        SELECT {LINE_DAY} AS date, {LINE_BOX} AS container_number,
               CASE WHEN l_partkey % 3 = 0 THEN 'IOT' WHEN l_partkey % 3 = 1 THEN 'MAERSK'
                    ELSE 'CMA CGM' END AS line,
               {pick("l_linenumber", ["Collection", "Shifting", "Delivery"])} AS movement_type,
               {pick("l_orderkey + l_suppkey", ["NA", "IPHS", "THIRD PARTY", "IPHS (Third Party)"])}
                   AS driver,
               {pick("l_orderkey", ["FISHING PORT", "IPHS", "IOT", "HD YARD", "JHL", "LML", "CCCS"])}
                   AS origin,
               {LINE_CLOCK} AS time_out,
               {pick("l_partkey", ["FISHING PORT", "IPHS", "IOT", "HD YARD", "JHL", "LML", "CCCS"])}
                   AS destination,
               {clock("l_orderkey * 5 + l_suppkey * 3 + l_linenumber")} AS time_in,
               CASE WHEN l_linestatus = 'O' THEN 'Full' ELSE 'Empty' END AS status,
               CASE WHEN l_returnflag = 'R' THEN 'Dry Box' ELSE 'Reefer' END AS type,
               {pick("l_suppkey + l_linenumber", ["40''", "20''", "45''"]).replace("''''", "''")} AS size,
               {pick("l_orderkey + l_linenumber", ["IOT", "CCCS", "", "Other"])} AS remarks,
               {LINE_CUSTOMER} AS billed_to
        FROM {LINES}
    """,
    "scow_transfer": f"""
        SELECT {ORDER_DAY} AS date,
               {pick("o_orderkey", ["STDU6536343", "STDU6536338"])} AS container_number,
               {ORDER_CUSTOMER} AS customer,
               {pick("o_orderkey + o_custkey", ["Delivery", "Collection"])} AS movement_type,
               {pick("o_custkey", ["NA", "IPHS"])} AS driver, 'CCCS' AS "from",
               {ORDER_CLOCK} AS time_out, 'IOT' AS destination,
               {clock("o_orderkey * 3 + o_custkey * 5")} AS time_in,
               CASE WHEN o_orderstatus = 'F' THEN 'Empty' ELSE 'Full' END AS status,
               o_orderpriority AS remarks, CAST(o_custkey % 9 AS INT) AS num_of_scows
        FROM {ORDERS}
    """,
    "forklift": f"""
        SELECT {pick("l_orderkey", WEEK)} AS day, {LINE_DAY} AS date, {LINE_CLOCK} AS start_time,
               {END_CLOCK.format(LINE_CLOCK, "l_partkey")} AS end_time,
               {END_CLOCK.format(LINE_CLOCK, "l_partkey")} - {LINE_CLOCK} AS duration,
               {LINE_CUSTOMER} AS customer,
               {pick("l_suppkey", ["STO", "Vessel"])} AS charged_in,
               {pick("l_linenumber + l_suppkey", ["Net Repair", "Salt Loading", "Provision",
                                                  "Gangway", "Spare Parts"])} AS service_type
        FROM {LINES}
    """,
    "salt": f"""
        SELECT {ORDER_DAY} AS date, {ORDER_VESSEL} AS vessel, ' ' || {ORDER_CUSTOMER} AS customer,
               {ORDER_CLOCK} AS start_time,
               CASE WHEN {ORDER_CLOCK} + (o_custkey % 28 + 1) * 900 < 86400
                    THEN {ORDER_CLOCK} + CAST(o_custkey % 28 + 1 AS INT) * 900
                    ELSE {ORDER_CLOCK} + CAST(o_custkey % 28 + 1 AS INT) * 900 - 86400 END AS end_time,
               CAST(o_custkey % 28 + 1 AS INT) * 900 AS duration,
               {pick("o_orderkey", ["Loading (Quay to Ship)", "Loading @ Zone 14"])} AS operation_type,
               {tonnes("(o_custkey % 97 + 1) * 0.731")} AS tonnage
        FROM {ORDERS}
    """,
    "bin_tipping": f"""
        SELECT {ORDER_DAY} AS date, {ORDER_CUSTOMER} AS customer,
               CASE WHEN o_orderkey % 2 = 0 THEN 'OUT' ELSE 'IN' END AS movement_type,
               CAST(o_custkey % 14 AS INT) AS scows_tipped,
               {tonnes("(o_custkey % 14) * 1.213")} AS tonnage_tipped,
               {tonnes("(o_custkey % 14) * 0.317")} AS overtime
        FROM {ORDERS}
    """,
    "berth": f"""
        SELECT {ORDER_VESSEL} AS vessel,
               {pick("o_custkey", ["ECHEBASTAR FLEET SLU", "HARTSWATER LIMITED", "PRINCESS TUNA",
                                   "SAPMER", "INPESCA S.A"])} AS customer,
               {pick("o_custkey + o_orderkey", ["FISHING VESSEL", "CARGO REEFER", "SUPPLY BOAT",
                     "MILITARY VESSEL", "LONGLINER", "YACHT"])} AS vessel_type,
               {ORDER_DAY} AS date_in, {ORDER_CLOCK} AS time_in,
               CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS DATE)
                    ELSE {ORDER_DAY} + CAST(o_custkey % 9 AS INT) END AS date_out,
               {clock("o_orderkey * 11 + o_custkey * 3")} AS time_out,
               CASE WHEN o_orderkey % 3 = 0 THEN CAST(NULL AS DECIMAL(12,3))
                    ELSE CAST(o_custkey % 3 * -100 AS DECIMAL(12,3)) END AS discount
        FROM {ORDERS}
    """,
    "report_status": f"""
        SELECT {ORDER_CUSTOMER} AS vessel_client,
               CASE WHEN o_orderstatus = 'F' THEN 'OSS' ELSE 'STO' END AS report_type,
               {ORDER_DAY} AS start_date,
               CASE WHEN o_orderkey % 17 = 0 THEN 'open'
                    ELSE lpad(CAST(day({ORDER_DAY} + CAST(o_custkey % 30 AS INT)) AS STRING), 2, '0')
                      || '/' || lpad(CAST(month({ORDER_DAY} + CAST(o_custkey % 30 AS INT)) AS STRING), 2, '0')
                      || '/' || CAST(year({ORDER_DAY} + CAST(o_custkey % 30 AS INT)) AS STRING)
                    END AS end_date
        FROM {ORDERS}
    """,
    "statement_register": f"""
        SELECT CAST(month({ORDER_DAY}) AS STRING) AS month,
               'STO-' || CAST(o_orderkey AS STRING) AS sub_type, {ORDER_VESSEL} AS report_name,
               {ORDER_CUSTOMER} AS customer, {ORDER_DAY} AS starting_date,
               {ORDER_DAY} + CAST(o_custkey % 9 AS INT) AS ending_date,
               CASE WHEN o_orderstatus = 'F' THEN 'oss' ELSE 'sto' END AS report_type
        FROM {ORDERS}
    """,
    "gate_in": f"""
        SELECT {LINE_DAY} AS date, l_returnflag AS type,
               {pick("l_suppkey", ["Carrier", "Daikin", "Thermo King"])} AS unit_manufacturer,
               {LINE_BOX} AS container_number
        FROM {LINES}
    """,
    "pti_log": f"""
        SELECT {ORDER_DAY} AS date_plugin, {ORDER_BOX} AS container_number,
               {pick("o_orderkey", ["-25", "-35", "-60"])} AS set_point,
               {pick("o_custkey", ["Carrier", "Daikin", "Thermo King"])} AS unit_manufacturer,
               {pick("o_orderkey", ["CMA CGM", "MAERSKLINE", "IOT"])} AS shipping_line
        FROM {ORDERS}
    """,
    "activity": f"""
        SELECT {ORDER_DAY} AS date, {ORDER_VESSEL} AS vessel,
               {tonnes("(o_custkey % 211 + 1) * 0.457")} AS total_tonnage,
               CAST(o_custkey % 6 AS INT) AS extra_men, CAST(o_orderkey % 8 + 46 AS INT) AS stevedores,
               CASE WHEN o_orderkey % 4 = 0 THEN {tonnes("(o_custkey % 17) * 0.250")} END AS well_to_well,
               {pick("o_orderkey", ["OPEX/ OT 18:00 / two extra men", "OPEX/ rain", "no remark",
                                    "a/ OT only"])} AS remarks
        FROM {ORDERS}
    """,
    "additional_overtime": f"""
        SELECT {ORDER_DAY} AS date, lower({ORDER_VESSEL}) AS vessel,
               {tonnes("(o_custkey % 50) * 0.333")} AS overtime_tonnage, {ORDER_CLOCK} AS start_time,
               {END_CLOCK.format(ORDER_CLOCK, "o_custkey")} AS end_time,
               CAST(o_orderkey % 30 AS INT) AS number_of_stevedores
        FROM {ORDERS}
    """,
    "stuffing_lines": f"""
        SELECT {pick("l_orderkey + l_partkey", WEEK)} AS day, {LINE_DAY} AS date,
               {LINE_BOX} AS container_number,
               {pick("l_linenumber + l_orderkey", ["Shore Crane & Fishloader", "Static Loader",
                     "Container Stuffing by Hand"])} AS service,
               {LINE_CUSTOMER} AS customer,
               CAST(11 + l_linenumber * 0.5 AS DECIMAL(12,3)) AS price,
               {tonnes("l_quantity * 0.207")} AS total_tonnage,
               CASE WHEN l_linenumber = 4 THEN CAST(NULL AS DECIMAL(18,3))
                    WHEN l_linenumber = 5 THEN {tonnes("l_quantity * 0.207")}
                    ELSE {tonnes("l_quantity * 0.051")} END AS overtime_tonnage
        FROM {LINES}
    """,
    "forklift_usage": f"""
        SELECT {ORDER_DAY} AS date_of_service, lower(replace(o_orderpriority, '-', ' ')) AS driver,
               'F' || CAST(o_custkey % 9 AS STRING) AS forklift_number, {ORDER_CLOCK} AS time_out,
               {END_CLOCK.format(ORDER_CLOCK, "o_custkey")} AS time_in,
               {ORDER_CUSTOMER} AS vessel_client, o_orderstatus AS purpose
        FROM {ORDERS}
    """,
    "container_codes": f"""
        SELECT CASE l_linenumber
                    WHEN 2 THEN ' ' || {LINE_BOX}
                    WHEN 3 THEN lower({LINE_BOX})
                    WHEN 4 THEN substring({LINE_BOX}, 1, 10)
                    WHEN 5 THEN substring({LINE_BOX}, 1, 10)
                                || CAST((l_partkey + l_suppkey) % 10 AS STRING)
                    WHEN 6 THEN {pick("l_suppkey", ["HLXU", "ZIMU", "KLVW", "OOLU"])}
                                || substring({LINE_BOX}, 5, 7)
                    ELSE {LINE_BOX} END AS container_number
        FROM {LINES}
    """,
}


class DerivedInputs(Mapping[str, DataFrame]):
    """The derived tables as DataFrames over the parquet files of a directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def given(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        text = TABLES[name].replace('"from"', "`from`")
        used = {g: self.given(g) for g in GIVEN if "{" + g + "}" in text}
        return self._spark.sql(text, **used)

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def oracle_table(name: str) -> str:
    """The SELECT of a derived table over the oracle's views."""
    return TABLES[name].format(**{g: g for g in GIVEN})
