"""Named inputs: schemas, renames and the files they are read from.

Times of day are integer seconds. Hand-typed numbers stay text until a plan
casts them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.numbers import unreadable
from ..operators.quality import require_name, split_valid

SCHEMAS = {
    "price": "service string, price decimal(12,3), date date, end_date date, class string",
    "client": "vessel_client string, type string, customer string",
    "unloading_raw": (
        "day string, date date, time int, vessel string, species string, details string, "
        "scale_reading string, storage string, destination string, overtime string, "
        "side_working string"
    ),
    "unloading_summary": (
        "date date, vessel string, start_time int, end_time int, destination string, "
        "overtime string, storage_type string, total_tonnage decimal(18,3)"
    ),
    "cold_store": (
        "day string, date date, movement_type string, customer string, origin string, "
        "vessel string, storage_type string, operation_type string, total_tonnage string, "
        "bins_in string, bins_out string, static_loader string, overtime_tonnage string"
    ),
    "cross_stuffing": (
        "day string, vessel_client string, date date, origin string, destination string, "
        "start_time int, end_time int, total_tonnage string, overtime_tonnage string, "
        "is_origin_empty string, service string, charged string"
    ),
    "by_catch_transfer": (
        "date date, movement_type string, customer string, vessel string, service string, "
        "storage_type string, total_tonnage string, overtime_tonnage string"
    ),
    "cccs_stuffing": (
        "date date, container_number string, customer string, service string, "
        "total_tonnage string, overtime_tonnage string, charged string"
    ),
    "container_ops": (
        "vessel_client string, customer string, date_plugged date, time_plugged int, "
        "container_number string, operation_type string, shipping_line string, "
        "plugged_status string, tonnage decimal(18,3), set_point int, date_out date, "
        "location string"
    ),
    "liner_pallet": (
        "date date, container_number string, shipping_line string, assigned_to string, "
        "remarks string"
    ),
    "container_shifting": (
        "date date, container_number string, billed_to string, service_remarks string"
    ),
    "pti": (
        "datetime_start timestamp_ntz, datetime_end timestamp_ntz, container_number string, "
        "set_point string, unit_manufacturer string, status string, billed_to string, "
        "plugged_on string"
    ),
    "washing": "date date, container_number string, billed_to string, service_remarks string",
    "shore_crane": (
        "day string, date date, start_time int, end_time int, hours int, overtime_hours int, "
        "customer string, location string, operation_type string, remarks string, "
        "charged_to string"
    ),
    "transfer": (
        "date date, container_number string, line string, movement_type string, driver string, "
        "origin string, time_out int, destination string, time_in int, status string, "
        "type string, size string, remarks string, billed_to string"
    ),
    "scow_transfer": (
        "date date, container_number string, customer string, movement_type string, "
        "driver string, `from` string, time_out int, destination string, time_in int, "
        "status string, remarks string, num_of_scows int"
    ),
    "forklift": (
        "day string, date date, start_time int, end_time int, duration int, customer string, "
        "charged_in string, service_type string"
    ),
    "salt": (
        "date date, vessel string, customer string, start_time int, end_time int, "
        "duration int, operation_type string, tonnage decimal(18,3)"
    ),
    "bin_tipping": (
        "date date, customer string, movement_type string, scows_tipped int, "
        "tonnage_tipped decimal(18,3), overtime decimal(18,3)"
    ),
    "berth": (
        "vessel string, customer string, vessel_type string, date_in date, time_in int, "
        "date_out date, time_out int, discount decimal(12,3)"
    ),
    "report_status": (
        "vessel_client string, report_type string, start_date date, end_date string"
    ),
    "statement_register": (
        "month string, sub_type string, report_name string, customer string, "
        "starting_date date, ending_date date, report_type string"
    ),
    "gate_in": (
        "date date, type string, unit_manufacturer string, container_number string"
    ),
    "pti_log": (
        "date_plugin date, container_number string, set_point string, "
        "unit_manufacturer string, shipping_line string"
    ),
    "activity": (
        "date date, vessel string, total_tonnage decimal(18,3), extra_men int, stevedores int, "
        "well_to_well decimal(18,3), remarks string"
    ),
    "additional_overtime": (
        "date date, vessel string, overtime_tonnage decimal(18,3), start_time int, "
        "end_time int, number_of_stevedores int"
    ),
    "stuffing_lines": (
        "day string, date date, container_number string, service string, customer string, "
        "price decimal(12,3), total_tonnage decimal(18,3), overtime_tonnage decimal(18,3)"
    ),
    "forklift_usage": (
        "date_of_service date, driver string, forklift_number string, time_out int, "
        "time_in int, vessel_client string, purpose string"
    ),
}

# Headers of the exported sheets that differ from the names used here.
HEADERS = {
    "price": {"Service": "service", "Price": "price", "StartingDate": "date",
              "EndingDate": "end_date", "Class": "class"},
    "client": {"Vessel/Client": "vessel_client", "Type": "type", "Customer": "customer"},
    "unloading_raw": {"Day": "day", "Date": "date", "Time": "time", "Vessel": "vessel",
                      "Species": "species", "Details": "details", "Storage": "storage",
                      "Scale Reading(-Fish Net) (Cal)": "scale_reading",
                      "Container (Destination)": "destination", "Side Working": "side_working"},
    "unloading_summary": {"Date": "date", "Vessel": "vessel", "startTime": "start_time",
                          "endTime": "end_time", "Container (Destination)": "destination",
                          "Storage": "storage_type", "Total Tonnage": "total_tonnage"},
    "bin_tipping": {"Date": "date", "Customer": "customer",
                    "IOT Scows (Tipping)": "scows_tipped", "Tonnage Tipped": "tonnage_tipped",
                    "Overtime": "overtime"},
    "berth": {"VESSEL NAME": "vessel", "DATE IN": "date_in", "TIME IN": "time_in",
              "DATE OUT": "date_out", "TIME OUT": "time_out", "DISCOUNT": "discount",
              "VESSEL TYPE": "vessel_type"},
    "activity": {"DATE": "date", "VESSEL NAME": "vessel", "TOTAL TONNAGE": "total_tonnage"},
    "gate_in": {"Date": "date", "Type": "type", "Unit Manufacturer": "unit_manufacturer",
                "Container Number": "container_number"},
    "pti_log": {"Date Plugin": "date_plugin", "Container Number": "container_number",
                "Set Point": "set_point", "Unit Manufacturer": "unit_manufacturer",
                "Shipping Line": "shipping_line"},
}


# Columns whose values must be on a list.
LISTED = {
    "unloading_raw": {"storage": V.STORAGE_TYPES},
    "unloading_summary": {"overtime": list(V.MULTIPLIERS), "storage_type": V.STORAGE_TYPES},
    "cold_store": {"day": V.DAY_NAMES},
    "cross_stuffing": {"day": V.DAY_NAMES},
    "container_ops": {"plugged_status": V.PLUGGED_STATUSES},
    "liner_pallet": {
        "shipping_line": [*V.SHIPPING_LINES, "SAPMER"],
        "remarks": V.PALLET_TYPES,
    },
    "pti": {
        "set_point": V.SET_POINTS,
        "status": V.PTI_STATUSES,
        "billed_to": V.PTI_PAYERS,
    },
    "shore_crane": {"day": V.DAY_NAMES},
    "transfer": {
        "line": V.SHIPPING_LINES,
        "movement_type": V.TRANSFER_MOVEMENTS,
        "driver": V.TRANSFER_DRIVERS,
        "origin": V.TRANSFER_LOCATIONS,
        "destination": V.TRANSFER_LOCATIONS,
        "status": V.STATUSES,
    },
    "scow_transfer": {"container_number": V.SCOW_CONTAINERS, "status": V.STATUSES},
    "forklift": {"day": V.DAY_NAMES},
    "bin_tipping": {"movement_type": V.MOVEMENT_TYPES},
}


# Text columns that hold hand-typed numbers, and how a plan reads them.
NUMBERS = {
    "unloading_raw": {"scale_reading": "kilos"},
    "cold_store": {
        "total_tonnage": "tonnes",
        "overtime_tonnage": "tonnes",
        "static_loader": "tonnes",
        "bins_in": "count",
        "bins_out": "outgoing",
    },
    "cross_stuffing": {"total_tonnage": "tonnes", "overtime_tonnage": "tonnes"},
    "by_catch_transfer": {"total_tonnage": "tonnes", "overtime_tonnage": "tonnes"},
    "cccs_stuffing": {"total_tonnage": "tonnes", "overtime_tonnage": "tonnes"},
}

#: The column of rescued cells: an array of (column, text).
RESCUED = "_rescued"


def require_listed(df: DataFrame, name: str) -> DataFrame:
    """The table itself; the query fails on a value that is not on its column's list."""
    return df.withColumns({c: require_name(F.col(c), v) for c, v in LISTED.get(name, {}).items()})


def split_listed_rows(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose listed columns are null or on their lists, and the others with the columns at fault."""
    rules = {c: F.col(c).isNull() | F.col(c).isin(v) for c, v in LISTED.get(name, {}).items()}
    return split_valid(df, rules)


def bad_cells(df: DataFrame, name: str, typed: Mapping[str, str] | None = None) -> Column:
    """Cells of a row that can't be read, as an array of (column, text).

    ``typed`` maps text columns to the types they are to be cast to; the table's hand-typed numbers are looked at besides.
    """
    wrong = {c: unreadable(F.col(c), kind) for c, kind in NUMBERS.get(name, {}).items()}
    for c, kind in (typed or {}).items():
        text = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        wrong[c] = text.isNotNull() & text.try_cast(kind).isNull()
    cells = [F.when(bad, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"))) for c, bad in wrong.items()]
    return F.array_compact(F.array(*cells)) if cells else F.array().cast("array<struct<column:string,text:string>>")


def refused_cells(df: DataFrame, name: str) -> DataFrame:
    """Each unreadable text of a table with its column and how many rows hold it. ``df`` may have a column of rescued cells."""
    cells = F.col(RESCUED) if RESCUED in df.columns else bad_cells(df, name)
    cell = df.select(F.explode(cells).alias("_cell"))
    return cell.groupBy(F.lit(name).alias("table"), F.col("_cell.column").alias("column"), F.col("_cell.text").alias("text")).agg(
        F.count(F.lit(1)).alias("rows")
    )


class Inputs(Mapping[str, DataFrame]):
    """Tables by name, read on first use from ``root/<name>``, by column name and never by place.

    A file's columns may stand in any order and carry the sheet's headers. A missing column, or one that
    neither the schema nor ``extra`` (more columns by table, left out) names, is an error. ``unlisted``
    tells what happens to rows off a column's list: "keep" them, "fail" the query, or "drop" them from
    the table, when ``refused`` gives them with the columns at fault. ``cells`` tells what happens to a cell
    that is not of its column's type: "fail" the query, or "rescue" the row with a null in its place, when
    ``rescued`` gives the rows with such cells beside them, and ``refused_cells`` counts the texts.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        fmt: str = "parquet",
        suffix: str = "",
        unlisted: str = "keep",
        extra: Mapping[str, Sequence[str]] | None = None,
        cells: str = "fail",
    ):
        if unlisted not in ("keep", "fail", "drop"):
            raise ValueError(f"unlisted: {unlisted}")
        if cells not in ("fail", "rescue"):
            raise ValueError(f"cells: {cells}")
        self._spark, self._root, self._fmt, self._suffix = spark, root, fmt, suffix
        self._unlisted, self._extra, self._cells = unlisted, extra or {}, cells

    def _load(self, name: str, cells: str) -> DataFrame:
        path = f"{self._root}/{name}{self._suffix}"
        reader = self._spark.read
        if self._fmt == "csv":
            reader = reader.option("header", True)
        return with_schema(reader.format(self._fmt).load(path), name, self._extra.get(name, ()), cells)

    def _read(self, name: str) -> DataFrame:
        return self._load(name, self._cells).drop(RESCUED)

    def __getitem__(self, name: str) -> DataFrame:
        df = self._read(name)
        if self._unlisted == "fail":
            return require_listed(df, name)
        return split_listed_rows(df, name)[0] if self._unlisted == "drop" else df

    def refused(self, name: str) -> DataFrame:
        """Rows of a table that are off their lists, with the columns at fault."""
        return split_listed_rows(self._read(name), name)[1]

    def rescued(self, name: str) -> DataFrame:
        """Rows of a table with cells that can't be read, those cells beside them."""
        return self._load(name, "rescue").filter(F.size(RESCUED) > 0)

    def refused_cells(self, name: str) -> DataFrame:
        """The texts that can't be read, by column."""
        return refused_cells(self._load(name, "rescue"), name)

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)


def with_sheet_headers(df: DataFrame, name: str) -> DataFrame:
    """Rename the headers of an exported sheet to the names used here."""
    return df.withColumnsRenamed(HEADERS.get(name, {}))


def with_schema(df: DataFrame, name: str, extra: Sequence[str] = (), cells: str = "fail") -> DataFrame:
    """The table's columns by name, renamed from sheet headers and cast; an error on a missing or unknown one.

    With ``cells`` "rescue" a cell that is not of its type becomes null and stands in the column RESCUED.
    """
    df = with_sheet_headers(df, name)
    columns = dict(c.strip().rsplit(" ", 1) for c in re.split(r",\s*(?![^()]*\))", SCHEMAS[name]))
    missing, unknown = set(columns) - set(df.columns), set(df.columns) - set(columns) - set(extra)
    if missing or unknown or len(set(df.columns)) < len(df.columns):
        raise ValueError(f"{name}: missing {sorted(missing)}, unknown {sorted(unknown)}, of {df.columns}")
    if cells == "fail":
        return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns.items()])
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    typed = {c: kind for c, kind in columns.items() if kind != "string" and c in texts}
    read = [F.trim(c).try_cast(kind).alias(c) if c in typed else F.col(c).cast(kind).alias(c) for c, kind in columns.items()]
    return df.select(*read, bad_cells(df, name, typed).alias(RESCUED))
