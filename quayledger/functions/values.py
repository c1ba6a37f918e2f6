"""Fixed values of the billing domain: labels, cut-offs, name lists and rates."""

from __future__ import annotations

from datetime import date

# Overtime labels and their multipliers.
NORMAL = "normal hours"
OVERTIME_150 = "overtime 150%"
OVERTIME_200 = "overtime 200%"
MULTIPLIERS = {NORMAL: "1.0", OVERTIME_150: "1.5", OVERTIME_200: "2.0"}

# Day labels. Sundays and public holidays are the special days.
DAY_NAMES = ["PH", "Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
SPECIAL_DAYS = ["PH", "Sun"]

# Times of day in seconds since midnight.
H07 = 7 * 3600
H16 = 16 * 3600
H17 = 17 * 3600
EARLY_END = 8 * 3600 - 1  # 07:59:59
DAY_SECONDS = 24 * 3600

# Column types. Tonnes are kept to the kilogram.
TONNES = "decimal(18,3)"
PRICE = "decimal(12,3)"
FACTOR = "decimal(3,2)"

# Name lists.
BY_CATCH_COMPANIES = ["AMIRANTE", "OCEAN BASKET", "ISLAND CATCH"]
SHORE_COST_CLIENTS = ["DARDANEL", "IOT"]
UNLOADING_SERVICES = ["Sorting from Unloading", "Unsorted from Unloading"]
BIN_DISPATCH_SERVICES = ["Bin Dispatch to IOT", "Bin Dispatch from IOT"]
CARGO_DISPATCH_SERVICES = ["Dispatch to Cargo Vessel", "Dispatch from Cargo Vessel"]
FORKLIFT_EXCLUDED_SERVICES = ["Salt Loading", "Gangway", "Invalid"]
PALLET_TYPES = ["Pallet", "Liner & Pallet", "Liner"]
SHIPPING_LINES = ["MAERSK", "CMA CGM", "IOT"]
TRANSFER_LOCATIONS = ["FISHING PORT", "IPHS", "IOT", "HD YARD", "JHL", "LML", "CCCS"]
TRANSFER_MOVEMENTS = ["Collection", "Shifting", "Delivery"]
TRANSFER_DRIVERS = ["NA", "IPHS", "THIRD PARTY", "IPHS (Third Party)"]
MOVEMENT_TYPES = ["Delivery", "Collection", "Shifting", "External", "IN", "OUT", "INTERNAL"]
STATUSES = ["Full", "Empty"]
STORAGE_TYPES = ["Brine", "Dry"]
PLUGGED_STATUSES = ["Full", "Partial", "Completed"]
SET_POINTS = ["-25", "-35", "-60"]
PTI_STATUSES = ["PASSED", "FAILED"]
PTI_PAYERS = ["MAERSKLINE", "IOT", "INVALID", "CMA CGM"]
SCOW_CONTAINERS = ["STDU6536343", "STDU6536338"]

# Dated contract terms.
DARDANEL_TERMS_END = date(2025, 9, 1)
DARDANEL_DISCOUNT = "4.000"
DARDANEL_TRUCK_DISCOUNT = "1.000"
DARDANEL_CARGO_DISCOUNT = "3.000"
REEFER_FOR_IOT = (date(2025, 11, 3), date(2025, 11, 15))
# The same terms in the list over the scale readings.
REEFER_FOR_IOT_READINGS = (date(2025, 11, 3), date(2025, 11, 19))
IOT_CARGO_START = date(2025, 11, 1)
CRANE_WEEKDAY_INCREASE_START = date(2026, 1, 1)
CRANE_SPECIAL_INCREASE_START = date(2026, 3, 1)
CRANE_INCREASE = "1.10"
UNSTUFFING_DISCOUNT = "3.500"

# Berth fees (type, first four days, each further day) and client day rates.
BERTH_FEES = [
    ("FISHING VESSEL", "5000.00", "1500.00"),
    ("CARGO REEFER", "1000.00", "300.00"),
    ("SUPPLY BOAT", "800.00", "200.00"),
    ("MILITARY VESSEL", "12000.00", "3000.00"),
    ("LONGLINER", "800.00", "300.00"),
]
BERTH_CLIENT_RATES = [("ECHEBASTAR FLEET SLU", "1250.00"), ("HARTSWATER LIMITED", "1250.00")]
BERTH_FREE_CLIENT = "PRINCESS TUNA"

# Statement rates.
FORKLIFT_HOURLY_RATE = 30
STATEMENT_MONITORING = 30
STATEMENT_PLUGIN = 25
STATEMENT_ELECTRICITY = {-25: 70, -35: 100, -60: 110}
DISPATCH_FLAT_RATE = "3.500"
STANDARD_CREW = 47
