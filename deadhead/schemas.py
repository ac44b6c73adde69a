"""Declared schemas of the source tables and a conform step for stage boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "l": T.LongType(),
    "d": T.DoubleType(),
    "date": T.DateType(),
    "ts": T.TimestampType(),
}


def struct(spec: str) -> T.StructType:
    """``"o_id:s dist:d"`` -> StructType."""
    fields = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SOURCES = {
    "invoice_lines": struct(
        "invoice_id:s orig_fac_als_id:s orig_fac_typ_ind:s orig_pstl_cd:s dest_fac_als_id:s "
        "dest_fac_typ_ind:s dest_pstl_cd:s mile_cnt:d shp_dt:date arvl_ts:ts dprt_ts:ts ond_shp_typ_cd:l"
    ),
    "invoices": struct("invoice_id:s dc_nbr:s"),
    "calendar": struct("cal_dt:date"),
    "dc_transitions": struct("old_bdc_nbr:s new_bdc_nbr:s"),
    "campus_map": struct("campus:l campus_nbr_nm:s campus_name:s scac:s"),
    "locations": struct("loc_nbr:s city_nm:s st_cd:s pstl_cd:s"),
    "partner_lanes": struct(
        "origin_id:s dest_id:s origin_zip:s destination_zip:s origin_city:s origin_state:s "
        "destination_city:s destination_state:s truckload_volume:l distance:d low_allin_cost:d"
    ),
    "distance_table": struct("o_zip:s d_zip:s dist:d"),
    "postal_codes": struct("postal_code:s longitude:d latitude:d"),
    "manual_distances": struct("o_id:s d_id:s o_zip:s d_zip:s dist:d"),
    "partner_rates": struct("ozip:s dzip:s bsl_rate:d"),
    "dedicated_costs": struct("dc_nbr:s variable_cpm:d stop_charge:d fixed_cost_per_hour:d"),
}

LEG_FACILITIES = "o_id:s o_type:s o_zip:s o_city:s o_state:s d_id:s d_type:s d_zip:s d_city:s d_state:s"
EMPTY_DEMAND = struct(
    f"region:l campus_nbr_nm:s dc_nbr:s scac:s {LEG_FACILITIES} leg:s dist:d loads:l ow_cost_per_load:l"
)
INPUT_LEGS = struct(
    f"region:l campus_nbr_nm:s dc_nbr:s scac:s {LEG_FACILITIES} leg:s dist:d loads:d "
    "ow_cost_per_load:d loaded_ind:l"
)
LABELLED_LEGS = struct(
    f"region:l campus_nbr_nm:s dc_nbr:s scac:s {LEG_FACILITIES} leg:s loads:d ow_cost_per_load:d "
    "loaded_ind:l leg_dtl:s side:s dist:d"
)
EDGES = struct("o_id:s o_type:s o_zip:s d_id:s d_type:s d_zip:s leg:s leg_dtl:s loaded_ind:l dist:d")
LANES = struct("o_id:s d_id:s o_zip:s d_zip:s pair_number:l")
DEMAND = struct(
    "side:s o_id:s o_type:s o_zip:s o_city:s o_state:s d_id:s d_type:s d_zip:s d_city:s d_state:s "
    "pair_number:l ow_cost_per_load:d leg:s dist:d loads:d majority_mode:s"
)


def _as_text(column, kind: T.DataType):
    # whole numbers kept as doubles would otherwise read "12.0"
    return F.when(column == F.floor(column), column.cast("long").cast("string")).otherwise(column.cast("string"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types; a missing column is an analysis error."""
    have = {f.name.lower(): f.dataType for f in df.schema}
    missing = [f.name for f in schema if f.name not in have]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    out = []
    for field in schema:
        column = F.col(field.name)
        kind = have[field.name]
        if isinstance(field.dataType, T.StringType) and isinstance(kind, (T.DoubleType, T.FloatType)):
            column = _as_text(column, kind)
        elif kind != field.dataType:
            column = column.cast(field.dataType)
        out.append(column.alias(field.name))
    return df.select(*out)
