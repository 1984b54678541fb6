"""Tables of the market domain: schema, key and partitioning of each.

Spark enforces no keys; upserts take them from here. Decimals round half up where values are cast
to them, so a layer that is written with these types cascades the rounding to the next.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    keys: list[str]
    partition: list[str] = field(default_factory=list)

    def conform(self, df: DataFrame, **derived) -> DataFrame:
        """df's columns cast to the table's types; columns that it lacks are null."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema])

    def write(self, df: DataFrame, path: str, mode: str = "overwrite") -> None:
        """Partitioned, and sorted by key within files, so statistics prune on it."""
        out = self.conform(df).repartition(*[F.col(c) for c in self.partition]) if self.partition else self.conform(df)
        writer = out.sortWithinPartitions(*self.keys).write.mode(mode)
        (writer.partitionBy(*self.partition) if self.partition else writer).parquet(path)


def _table(keys: str, fixed: str, decimals: dict[str, str], partition: str = "") -> Table:
    """decimals: "p,s" -> column names."""
    columns = [fixed] + [f"{c} decimal({kind})" for kind, names in decimals.items() for c in names.split()]
    return Table(T.StructType.fromDDL(", ".join(c for c in columns if c)), keys.split(), partition.split())


_QUARTER = "trade_date date, time_interval string"
_AREA = "trade_date date, period int, time_interval string, area_id int, country_code string"
_STATS = "mean median last"


def _spread(names: str) -> str:
    return " ".join(f"{n}_{s}" for n in names.split() for s in _STATS.split())


TABLES: dict[str, Table] = {
    "re_price_1min": _table("delivery_timestamp", "delivery_timestamp timestamp_ntz", {"15,3": "price_afrr_plus_eur_mwh price_afrr_minus_eur_mwh price_mfrr_plus_eur_mwh price_mfrr_minus_eur_mwh price_mfrr_5_eur_mwh"}),
    "imbalance_1min": _table("delivery_timestamp", "delivery_timestamp timestamp_ntz", {"12,5": "system_imbalance_mw"}),
    "svr_activation_1min": _table("delivery_timestamp", "delivery_timestamp timestamp_ntz", {"15,3": "afrr_plus_mw afrr_minus_mw mfrr_plus_mw mfrr_minus_mw mfrr_5_mw"}),
    "export_import_svr_1min": _table("delivery_timestamp", "delivery_timestamp timestamp_ntz", {"15,5": "imbalance_netting_mw mari_mfrr_mw picasso_afrr_mw sum_exchange_european_platforms_mw"}),
    "generation_res_1min": _table("delivery_timestamp", "delivery_timestamp timestamp_ntz", {"12,3": "wind_mw solar_mw"}),
    "imbalance_15min": _table("trade_date time_interval", _QUARTER, {"12,5": _spread("imbalance")}),
    "derived_15min": _table("trade_date time_interval", _QUARTER, {"12,5": "imb_roll_2h imb_roll_4h", "15,5": "imb_integral_4h", "12,3": "solar_error_mw wind_error_mw gen_total_error_mw"}),
    "da_price": _table("trade_date time_interval", f"{_QUARTER}, period int", {"10,2": "price_15min_eur_mwh price_60min_ref_eur_mwh", "12,3": "volume_mwh saldo_mwh export_mwh import_mwh"}),
    "ida": _table("trade_date time_interval ida_idx", f"{_QUARTER}, period int, ida_idx int", {"10,2": "price_eur_mwh", "12,3": "volume_mwh saldo_mwh export_mwh import_mwh"}),
    "load": _table("trade_date period area_id country_code", _AREA, {"12,3": "actual_load_mw forecast_load_mw"}, "country_code"),
    "generation_actual": _table("trade_date period area_id country_code", _AREA, {"12,3": "gen_biomass_mw gen_coal_mw gen_gas_mw gen_hydro_other_mw gen_hydro_pumped_mw gen_nuclear_mw gen_solar_mw gen_wind_mw"}, "country_code"),
    "cross_border_flows": _table("delivery_datetime area_id country_code", f"{_AREA}, delivery_datetime timestamp_ntz", {"12,3": "flow_de_mw flow_at_mw flow_pl_mw flow_sk_mw flow_total_net_mw"}, "country_code"),
    "bid": _table("delivery_date period side price order_resolution", "delivery_date date, period int, time_interval string, side string, order_resolution string", {"10,2": "price", "12,3": "volume_bid volume_matched"}),
    "outages_15min": _table("trade_date period area_id country_code", _AREA + ", n_units int", {"12,3": "total_out_mw planned_out_mw forced_out_mw"}, "country_code"),
    "fx": _table("rate_date", "rate_date date", {"10,6": "czk_eur"}),
}
