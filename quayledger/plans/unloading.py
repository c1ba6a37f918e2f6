"""Unloading: scale readings, cold-store adjustment, the net list and what is priced from it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.numbers import kilos_to_tonnes
from ..functions.rates import as_double, multiplier
from ..functions.text import cold_store_destination, species_name
from ..functions.timeband import is_special, label_by_clock
from ..functions.values import TONNES
from ..operators.asof import asof_join
from ..operators.calendar import in_range, with_day_name
from .cold_store import cold_store_log
from .pricing import with_price, with_prices

Period = tuple[date | None, date | None] | None

LINE_COLUMNS = [
    "day_name",
    "date",
    "vessel",
    "start_time",
    "destination",
    "overtime",
    "storage_type",
    "end_time",
    "total_tonnage",
]


def classified_readings(unloading_raw: DataFrame, period: Period = None) -> DataFrame:
    """Scale readings in tonnes with day name and overtime label."""
    readings = unloading_raw.filter(in_range(F.col("date"), period)).select(
        "species",
        kilos_to_tonnes(F.col("scale_reading")).alias("tonnage"),
        F.col("storage").alias("storage_type"),
        "date",
        "time",
        "destination",
        F.upper("vessel").alias("vessel"),
        "side_working",
    )
    return with_day_name(readings).withColumn(
        "overtime", label_by_clock(F.col("day_name"), F.col("time"))
    )


def sheet_readings(unloading_raw: DataFrame, period: Period = None) -> DataFrame:
    """Scale readings in tonnes with the day name and overtime label written on the sheet."""
    return unloading_raw.filter(in_range(F.col("date"), period)).select(
        F.col("day").alias("day_name"),
        kilos_to_tonnes(F.col("scale_reading")).alias("tonnage"),
        F.col("storage").alias("storage_type"),
        "date",
        "time",
        "destination",
        F.upper("vessel").alias("vessel"),
        "overtime",
    )


def operations_log(unloading_raw: DataFrame, period: Period = None) -> DataFrame:
    """Typed scale readings as kept by the operations department."""
    return unloading_raw.filter(in_range(F.col("date"), period)).select(
        "day",
        "date",
        "time",
        F.upper("vessel").alias("vessel"),
        species_name(F.col("species")).alias("species"),
        F.upper("details").alias("details"),
        kilos_to_tonnes(F.col("scale_reading")).alias("tonnage"),
        "storage",
        "destination",
        "overtime",
        "side_working",
    )


def reading_groups(classified: DataFrame) -> DataFrame:
    """Readings summed per day, vessel, destination, overtime label and storage."""
    return (
        classified.groupBy("day_name", "date", "overtime", "vessel", "destination", "storage_type")
        .agg(
            F.min("time").alias("start_time"),
            F.max("time").alias("end_time"),
            F.sum("tonnage").cast(TONNES).alias("total_tonnage"),
        )
        .select(*LINE_COLUMNS)
    )


def unloading_lines(unloading_summary: DataFrame, period: Period = None) -> DataFrame:
    """Lines of the unloading summary sheet outside the cold store."""
    lines = unloading_summary.filter(in_range(F.col("date"), period)).filter(
        ~F.col("destination").contains("CCCS")
    )
    return (
        with_day_name(lines)
        .withColumn("vessel", F.upper("vessel"))
        .withColumn("total_tonnage", F.col("total_tonnage").cast(TONNES))
        .select(*LINE_COLUMNS)
    )


def cold_store_records(cold_store: DataFrame, period: Period = None) -> DataFrame:
    """Official tonnes unloaded into the cold store, by-catch companies apart."""
    return (
        cold_store_log(cold_store, period)
        .filter(
            F.col("operation_type").isin(V.UNLOADING_SERVICES)
            & ~F.col("customer").isin(V.BY_CATCH_COMPANIES)
        )
        .withColumn("destination", cold_store_destination(F.col("customer")))
        .groupBy("date", "destination", "vessel", "storage_type")
        .agg(
            F.sum("total_tonnage").cast(TONNES).alias("official_tonnage"),
            F.sum("overtime_tonnage").cast(TONNES).alias("official_overtime"),
        )
    )


def settled_lines(groups: DataFrame, records: DataFrame, by_sheet_day: bool = False) -> DataFrame:
    """Reading groups with the cold-store ones scaled to the official tonnes.

    A cold-store reading counts ``official / readings of its group`` of its own
    weight. All readings of a group share that factor, so the group's sum is
    its part of the official record: no window over the readings is needed, and
    one aggregation of the readings serves both kinds of destination. A day
    written on the sheet may differ between readings of one date; with
    ``by_sheet_day`` its groups (a handful a label) share the record by weight.
    """
    takes_normal = (is_special(F.col("day_name")) & (F.col("overtime") == V.OVERTIME_150)) | (
        F.col("overtime") == V.NORMAL
    )
    official = F.when(
        takes_normal, F.col("official_tonnage") - F.col("official_overtime")
    ).otherwise(F.col("official_overtime"))
    # One shuffle on the record's keys serves the shares within a label and the join.
    groups = groups.repartition("date", "destination", "vessel", "storage_type")
    if by_sheet_day:
        label = Window.partitionBy("date", "vessel", "destination", "overtime", "storage_type")
        groups = groups.withColumn("_all", F.sum("total_tonnage").over(label))
        official = official.cast("double") * F.col("total_tonnage").cast("double") / F.nullif(F.col("_all").cast("double"), F.lit(0.0))
    adjusted = F.when(F.col("total_tonnage") != 0, official.cast(TONNES))
    return (
        groups.join(records, ["date", "destination", "vessel", "storage_type"], "left")
        .withColumn(
            "total_tonnage",
            F.when(F.col("destination").contains("CCCS"), adjusted).otherwise(
                F.col("total_tonnage")
            ),
        )
        .select(*LINE_COLUMNS)
    )


def adjusted_cold_store(classified: DataFrame, records: DataFrame, by_sheet_day: bool = False) -> DataFrame:
    """The cold-store lines alone."""
    groups = reading_groups(classified.filter(F.col("destination").contains("CCCS")))
    return settled_lines(groups, records, by_sheet_day)


def stuffings(container_ops: DataFrame) -> DataFrame:
    """Stuffings of plugged containers outside the cold store, a row per entry of the log."""
    operation = F.col("operation_type")
    kind = (
        F.when(operation.contains("Full"), "Full OSS")
        .when(operation.contains("Basic"), "Basic OSS")
        .otherwise("Container Stuffing")
    )
    return (
        container_ops.filter(~operation.contains("CCCS") & operation.rlike("Full|Basic|Stuffing"))
        .select(
            F.upper("vessel_client").alias("vessel_client"),
            "customer",
            "date_plugged",
            "container_number",
            kind.alias("stuffing"),
        )
        .filter(F.col("container_number").isNotNull() & F.col("date_plugged").isNotNull())
    )


def stuffing_types(container_ops: DataFrame) -> DataFrame:
    """Kind of stuffing of each plugged container outside the cold store."""
    return stuffings(container_ops).distinct()


def _service(reefer_for_iot: tuple[date, date], fallback: Column) -> Column:
    """Service of a net-list line; the first rule that holds decides."""
    destination, day = F.col("destination"), F.col("date")
    to_quay = (
        destination.contains("IOT")
        | (destination.contains("DARDANEL") & (day < V.DARDANEL_TERMS_END))
        | (destination.contains("Asian Marine Reefer") & day.between(*reefer_for_iot))
        | destination.contains("Unload to Quay")
        | (F.col("owned") & (F.col("customer") == "IOT"))
    )
    return (
        F.when(to_quay, "Unload to Quay")
        .when(F.col("to_cargo"), "Transhipment")
        .when(destination.contains("CCCS"), "Unload to CCCS")
        .otherwise(fallback)
    )


def _with_places(lines: DataFrame, stuffing: DataFrame, owned: DataFrame, cargo_vessels: DataFrame) -> DataFrame:
    """Lines with what their destination is: a container that was ever stuffed, an owned one, a cargo vessel.

    The three lists become one table with a row per upper-case name, so the lines are looked up once. Its sets hold the
    spellings of a name; a vessel is found in any case. A name is listed once before its spellings are gathered, because lists
    are gathered by sorting.
    """
    kinds = {"_stuffed": (stuffing, "container_number"), "owned": (owned, "container_number"), "to_cargo": (cargo_vessels, "vessel_client")}
    names = None
    for kind, (listed, column) in kinds.items():
        rows = listed.select(F.col(column).alias("_name"), F.lit(kind).alias("_kind"))
        names = rows if names is None else names.unionByName(rows)
    spelt = lambda kind: F.collect_list(F.when(F.col("_kind") == kind, F.col("_name"))).alias(f"_{kind}")
    places = names.dropna().distinct().groupBy(F.upper("_name").alias("_place")).agg(*[spelt(kind) for kind in kinds])
    listed_as = {"_stuffed": F.col("destination"), "owned": F.col("destination"), "to_cargo": F.col("_place")}
    return (
        lines.join(places, F.upper("destination") == F.col("_place"), "left")
        .withColumns({kind: F.coalesce(F.array_contains(f"_{kind}", name), F.lit(False)) for kind, name in listed_as.items()})
        .drop("_place", *[f"_{kind}" for kind in kinds])
    )


def _with_stuffing(lines: DataFrame, stuffing: DataFrame, same_day: DataFrame) -> DataFrame:
    """Lines with their container's next stuffing for the vessel, and one stuffing of the day itself.

    Only lines to a container that was ever stuffed carry its number as a key; the many lines to
    other places have a null key, so no destination gathers them. Of a container's stuffings on the
    day, at most a few by vessel and kind, the line's own vessel comes first: every line stays one line with its
    tonnes, and ``duplicate_stuffing`` lists the days with several.
    """
    matched = asof_join(
        lines.withColumn("_container", F.when(F.col("_stuffed"), F.col("destination"))),
        stuffing,
        "date",
        ["_container", "vessel"],
        ["customer", "stuffing"],
        right_on="date_plugged",
        right_by=["container_number", "vessel_client"],
        direction="forward",
        part_rows=None,
        spread=["date", "vessel", "destination", "overtime", "storage_type", "total_tonnage"],
    )
    of_day = same_day.groupBy(F.col("container_number").alias("_container"), F.col("date_plugged").alias("date")).agg(
        F.collect_set(F.struct("vessel_client", "stuffing")).alias("_day")
    )
    own = F.array_min(F.filter("_day", lambda x: x["vessel_client"] == F.col("vessel")))
    return (
        matched.join(of_day, ["_container", "date"], "left")
        .withColumn("_one", F.coalesce(own, F.array_min("_day")))
        .withColumn("exact_stuffing", F.col("_one.stuffing"))
        .withColumn("vessel_client", F.col("_one.vessel_client"))
        .drop("_day", "_one", "_container", "_stuffed")
    )


def _priced(listed: DataFrame, price: DataFrame, service: Column, remarks: Column) -> DataFrame:
    priced = with_price(
        listed.withColumn("service", service), price, F.concat("service", F.lit(" - "), "storage_type")
    )
    unit = (F.col("price") * multiplier(F.col("overtime"))).cast(V.PRICE)
    return priced.withColumn("price", unit).select(
        "date",
        "vessel",
        "start_time",
        "destination",
        "overtime",
        "storage_type",
        "end_time",
        "total_tonnage",
        "service",
        "price",
        as_double(F.col("price") * F.col("total_tonnage"), 3).alias("line_value"),
        remarks.alias("remarks"),
    )


def net_list(
    lines: DataFrame,
    stuffing: DataFrame,
    owned: DataFrame,
    cargo_vessels: DataFrame,
    price: DataFrame,
    reefer_for_iot: tuple[date, date] = V.REEFER_FOR_IOT,
) -> DataFrame:
    """The net list: every landed line with its service and price.

    The service of a container line comes from the container's next stuffing for
    the vessel, on or after the line's date. A Basic OSS of the day by a by-catch
    client comes before the other rules.
    """
    listed = _with_stuffing(_with_places(lines.drop("day_name"), stuffing, owned, cargo_vessels), stuffing, stuffing)
    basic = (F.col("exact_stuffing") == "Basic OSS") & F.col("vessel_client").isin("OCEAN BASKET", "AMIRANTE")
    service = F.when(basic, F.col("exact_stuffing")).otherwise(_service(reefer_for_iot, F.col("stuffing")))
    remarks = F.when(F.col("vessel_client") != F.col("vessel"), F.col("vessel_client"))
    return _priced(listed, price, service, remarks)


def net_list_from_readings(
    lines: DataFrame,
    stuffing: DataFrame,
    owned: DataFrame,
    cargo_vessels: DataFrame,
    price: DataFrame,
    reefer_for_iot: tuple[date, date] = V.REEFER_FOR_IOT_READINGS,
) -> DataFrame:
    """The net list over lines labelled by the clock, with that list's own rules.

    A container without a next stuffing takes the by-catch companies' stuffing of
    the day, whose client is the remark.
    """
    by_catch = stuffing.filter(F.col("vessel_client").isin(V.BY_CATCH_COMPANIES))
    listed = _with_stuffing(_with_places(lines.drop("day_name"), stuffing, owned, cargo_vessels), stuffing, by_catch)
    service = _service(reefer_for_iot, F.coalesce("stuffing", "exact_stuffing"))
    return _priced(listed, price, service, F.col("vessel_client"))


def oss_stuffing(net: DataFrame, price: DataFrame) -> DataFrame:
    """Lines stuffed on a shipping line's account, at the stuffing price."""
    service = F.when(
        F.col("service") == "Full OSS", F.concat(F.lit("Container Stuffing - "), "storage_type")
    ).otherwise("Stuffing")
    lines = (
        net.filter(F.col("service").contains("OSS"))
        .drop("price", "line_value")
        .withColumn("vessel", F.coalesce("remarks", "vessel"))
    )
    unit = (F.col("price") * multiplier(F.col("overtime"))).cast(V.PRICE)
    return (
        with_price(lines, price, service)
        .withColumn("price", unit)
        .withColumn("line_value", as_double(F.col("price") * F.col("total_tonnage"), 3))
        .drop("remarks", "date")
    )


def iot_stuffing_records(container_ops: DataFrame) -> DataFrame:
    """Stuffings of IOT's own containers."""
    return container_ops.filter(
        (F.col("shipping_line") == "IOT") & F.col("operation_type").contains("Stuffing")
    ).select(
        F.upper("vessel_client").alias("vessel_client"),
        "customer",
        "date_plugged",
        "container_number",
    )


def _labelled_total() -> Column:
    return F.col("total_tonnage") * F.col("price") * multiplier(F.col("overtime"), "0.0")


def iot_cargo(unloading_summary: DataFrame, price: DataFrame) -> DataFrame:
    """Loads to IOT's reefer vessel."""
    lines = with_day_name(
        unloading_summary.filter(
            (F.col("destination") == "Asian Marine Reefer") & (F.col("date") >= V.IOT_CARGO_START)
        )
    ).withColumn("total_tonnage", F.col("total_tonnage").cast(TONNES))
    priced = with_price(lines, price, F.concat(F.lit("Loading to Cargo - "), "storage_type"))
    return priced.select(
        F.upper("vessel").alias("vessel"),
        "day_name",
        "date",
        "start_time",
        "destination",
        "end_time",
        "overtime",
        "total_tonnage",
        F.col("storage_type").alias("storage"),
        F.col("price").alias("unit_price"),
        as_double(_labelled_total(), 3).alias("total_price"),
    )


def iot_stuffing(
    unloading_summary: DataFrame, owned: DataFrame, container_ops: DataFrame, price: DataFrame
) -> DataFrame:
    """Stuffings of IOT's own containers on IOT's account."""
    records = (
        iot_stuffing_records(container_ops)
        .filter(F.col("customer") == "IOT")
        .select("container_number", F.col("date_plugged").alias("date"), F.col("vessel_client").alias("vessel"))
        .join(owned, "container_number", "left_semi")
    )
    # Lines meet them by day, vessel and place at once, so that no frequent destination gathers the lines in one task.
    lines = (
        unloading_summary.withColumnRenamed("destination", "container_number")
        .withColumn("vessel", F.upper("vessel"))
        .withColumn("total_tonnage", F.col("total_tonnage").cast(TONNES))
        .join(records, ["date", "vessel", "container_number"])
    )
    return with_price(with_day_name(lines), price, "Stuffing").select(
        "vessel",
        "day_name",
        "date",
        "start_time",
        "container_number",
        "end_time",
        "overtime",
        "total_tonnage",
        F.col("storage_type").alias("storage"),
        "price",
        as_double(_labelled_total()).alias("total_price"),
    )


def tare_calibration(unloading_raw: DataFrame, price: DataFrame, period: Period = None) -> DataFrame:
    """Scale calibration per day and vessel: one rental, one calibration per working side."""
    # Distinct sides first, so that a day's readings are reduced to its few sides before they are listed.
    readings = unloading_raw.filter(in_range(F.col("date"), period))
    worked = readings.groupBy("date", F.upper("vessel").alias("vessel"), "side_working").agg(F.count(F.lit(1)).alias("_readings"))
    sides = (
        worked.groupBy("date", "vessel")
        .agg(F.sort_array(F.collect_list("side_working")).alias("_sides"))
        .withColumn("side_working", F.array_join("_sides", ", "))
        .withColumn("rental_of_weight", F.lit(1).cast("bigint"))
        .withColumn("number_of_sides", F.size("_sides").cast("bigint"))
        .drop("_sides")
    )
    sides = with_prices(
        sides, price, {"rental": "Rental of Calibration", "calibration": "Tare Calibration"}
    )
    return (
        sides.withColumn("price_per_rental", F.col("rental") * F.col("rental_of_weight"))
        .withColumn("price_per_calibrations", F.col("calibration") * F.col("number_of_sides"))
        .withColumn("price_per_rental", as_double(F.col("price_per_rental")))
        .withColumn("price_per_calibrations", as_double(F.col("price_per_calibrations")))
        .withColumn("total_price", F.col("price_per_rental") + F.col("price_per_calibrations"))
        .drop("rental", "calibration")
    )


def scan_times(unloading_raw: DataFrame, destinations: list[str] | None = None) -> DataFrame:
    """First and last scan per container and day."""
    scans = unloading_raw
    if destinations is not None:
        scans = scans.filter(F.col("destination").isin(destinations))
    return scans.groupBy("destination", "date").agg(
        F.min("time").alias("start_time"), F.max("time").alias("end_time")
    )
