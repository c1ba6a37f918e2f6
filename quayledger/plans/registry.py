"""The result datasets by group and name."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from ..sources.sinks import SaveResult, save_group
from . import cold_store, emr, scows, shore, stuffing, transport, unloading
from .pricing import clients_of_type, owned_containers

Tables = Mapping[str, DataFrame]


def landed_lines(t: Tables, period: unloading.Period = None) -> DataFrame:
    """All landed lines: the summary sheet's outside the cold store, and the cold-store readings
    under the sheet's own day and label, scaled to the official tonnes."""
    readings = unloading.sheet_readings(t["unloading_raw"], period)
    records = unloading.cold_store_records(t["cold_store"], period)
    port = unloading.unloading_lines(t["unloading_summary"], period)
    return port.unionByName(unloading.adjusted_cold_store(readings, records, by_sheet_day=True))


def landed_readings(t: Tables) -> DataFrame:
    """All landed lines from the scale readings, labelled by the clock."""
    groups = unloading.reading_groups(unloading.classified_readings(t["unloading_raw"]))
    return unloading.settled_lines(groups, unloading.cold_store_records(t["cold_store"]))


def _listed(t: Tables, lines: DataFrame, make: Callable[..., DataFrame]) -> DataFrame:
    return make(
        lines,
        unloading.stuffings(t["container_ops"]),
        owned_containers(t["transfer"], distinct=False),
        clients_of_type(t["client"], "CARGO", distinct=False),
        t["price"],
    )


def net_list(t: Tables, period: unloading.Period = None) -> DataFrame:
    """The net list over the summary sheet and the sheet-labelled cold-store readings, of all days or of a period."""
    return _listed(t, landed_lines(t, period), unloading.net_list)


def net_list_from_readings(t: Tables) -> DataFrame:
    """The net list over the scale readings."""
    return _listed(t, landed_readings(t), unloading.net_list_from_readings)


def _by_catch(t: Tables) -> DataFrame:
    return cold_store.by_catch(
        t["cold_store"],
        t["by_catch_transfer"],
        clients_of_type(t["client"], "BYCATCH"),
        t["price"],
    )


DATASETS: dict[str, dict[str, Callable[[Tables], DataFrame]]] = {
    "emr": {
        "shifting": lambda t: emr.shifting(t["container_shifting"], t["price"]),
        "washing": lambda t: emr.washing(t["washing"], t["price"]),
        "pti": lambda t: emr.pti(t["pti"], t["price"]),
    },
    "operations": {
        "ops": lambda t: unloading.operations_log(t["unloading_raw"]),
        "tare_calibration": lambda t: unloading.tare_calibration(t["unloading_raw"], t["price"]),
    },
    "netlist": {
        "net_list": net_list,
        "iot_container_stuffing": lambda t: unloading.iot_stuffing(
            t["unloading_summary"], owned_containers(t["transfer"]), t["container_ops"], t["price"]
        ),
        "oss_stuffing": lambda t: unloading.oss_stuffing(t["net_list"], t["price"]),
        "iot_cargo_discharge": lambda t: unloading.iot_cargo(t["unloading_summary"], t["price"]),
    },
    "bin_dispatch": {
        "full_scows_transfer": lambda t: scows.full_scows(
            t["scow_transfer"], t["cold_store"], t["price"]
        ),
        "empty_scows_transfer": lambda t: scows.empty_scows(t["scow_transfer"], t["price"]),
    },
    "shore_handling": {
        "salt": lambda t: shore.salt(t["salt"], t["price"]),
        "bin_tipping": lambda t: shore.bin_tipping(t["bin_tipping"], t["price"]),
        "forklift_salt": lambda t: shore.forklift_salt(t["salt"]),
    },
    "stuffing": {
        "pallet_liner": lambda t: stuffing.pallet_liner(t["liner_pallet"], t["price"]),
        "container_plugin": lambda t: stuffing.container_plugin(t["container_ops"], t["price"]),
    },
    "transport": {
        "shore_crane": lambda t: transport.shore_crane(t["shore_crane"], t["price"]),
        "transfer": lambda t: transport.haulage(t["transfer"], t["price"]),
        "scow_transfer": lambda t: scows.scow_transfers(t["scow_transfer"]),
        "forklift": lambda t: transport.forklift(t["forklift"]),
    },
    "miscellaneous": {
        "static_loader": lambda t: cold_store.static_loader(t["cold_store"], t["price"]),
        "dispatch_to_cargo": lambda t: cold_store.dispatch_to_cargo(t["cold_store"], t["price"]),
        "truck_to_cccs": lambda t: cold_store.truck_to_cccs(t["cold_store"], t["price"]),
        "cross_stuffing": lambda t: cold_store.cross_stuffing(t["cross_stuffing"], t["price"]),
        "cccs_stuffing": lambda t: cold_store.cccs_stuffing(t["cccs_stuffing"], t["price"]),
        "bycatch": _by_catch,
        "from_cccs_to_vessel": lambda t: cold_store.from_cccs_to_vessel(
            t["cold_store"], t["price"]
        ),
    },
}


#: Datasets that are made from the results of others, which their builders find among the tables.
NEEDS: dict[str, tuple[str, ...]] = {"oss_stuffing": ("net_list",)}


def rules() -> dict[str, dict[str, Column]]:
    """Row rules by dataset, counted while it is written."""
    return {"full_scows_transfer": scows.trip_rules()}


def _builder(name: str) -> Callable[[Tables], DataFrame]:
    for group in DATASETS.values():
        if name in group:
            return group[name]
    raise KeyError(name)


def build(name: str, tables: Tables) -> DataFrame:
    """One dataset by name, made from the results it needs."""
    needed = {n: build(n, tables) for n in NEEDS.get(name, ())}
    return _builder(name)(ChainMap(needed, tables) if needed else tables)


def save(group: str, tables: Tables, root: str) -> list[SaveResult]:
    """Write one group, or 'all' of them, as CSV under ``root``; results that others are made from are made once."""
    if group != "all" and group not in DATASETS:
        raise KeyError(f"{group}: not one of {[*DATASETS, 'all']}")
    wanted = [n for name, datasets in DATASETS.items() if group in (name, "all") for n in datasets]
    builders = {n: (lambda made, n=n: _builder(n)(ChainMap(made, tables) if made else tables)) for g in DATASETS.values() for n in g}
    return save_group(builders, root, NEEDS, wanted, rules())
