"""Declared schemas of the entity tables and the operator that makes a frame fit one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The entity tables, column by column.
_DDL = {
    "province": "name string, code smallint, population int",
    "province_data": """date date, name string, cases int, new_cases int, active int, recovered int,
        deaths int, quarantined int, hospitalized_infectious_diseases int,
        hospitalized_high_intensity int, hospitalized_intensive_care int, discharged int,
        active_rsa int, active_nursing_homes int, active_int_struct int, active_rsa_total int""",
    "municipality": """code smallint, name string, province string, lat double, lon double,
        population int""",
    "municipality_data": """date date, code smallint, cases int, recovered int, deaths int,
        discharged int""",
    "region_risk": "date date, region string, risk string",
    "holiday": "holiday string, start date, end date",
    "vaccines_administration": """date date, region string, supplier string, age_group string,
        male int, female int, first_dose int, second_dose int""",
    "vaccines_delivery": "date date, region string, supplier string, n_doses int",
    "weather_station": """station_id string, name string, lat double, lon double, elev smallint,
        mun_code smallint, n_sensors smallint, precipitation_available boolean,
        temperature_available boolean, humidity_available boolean, wind_speed_available boolean,
        atmospheric_pressure_available boolean, solar_rad_available boolean""",
    "weather_data": """station_id string, date date, precipitation_total double,
        temperature_mean double, humidity_mean double, wind_speed_mean double,
        atmospheric_pressure_mean double, solar_rad_total double""",
    "municipality_station_link": "municipality_code smallint, station_id string",
    "stringency_index": "date date, value double",
    "curated": """region string, date date, cases int, new_cases int, deaths int, new_deaths int,
        active int, recovered int, quarantined int, hospitalized int,
        hospitalized_high_intensity int, hospitalized_intensive_care int, discharged int,
        active_rsa_total int, holiday boolean, risk string, stringency_index double,
        new_first_doses_ag0 bigint, new_first_doses_ag1 bigint, new_first_doses_ag2 bigint,
        new_second_doses_ag0 bigint, new_second_doses_ag1 bigint, new_second_doses_ag2 bigint,
        new_first_doses bigint, new_second_doses bigint,
        first_doses_ag0 bigint, first_doses_ag1 bigint, first_doses_ag2 bigint,
        second_doses_ag0 bigint, second_doses_ag1 bigint, second_doses_ag2 bigint,
        first_doses bigint, second_doses bigint,
        vaccinated_population double, fully_vaccinated_population double""",
    "hyperparameters": """log struct<timestamp: timestamp, date_range: array<timestamp>,
            splits_train_size_min: int, splits_train_size_max: int, splits_test_size: int,
            elapsed_time: string>,
        configuration struct<outputs: array<string>, regressors: array<string>, date_from: string,
            p_values: array<int>, d_values: array<int>, q_values: array<int>,
            sp_values: array<int>, sd_values: array<int>, sq_values: array<int>,
            m_values: array<int>, t_values: array<string>, performance_measure: string,
            cv_n_splits: int, cv_max_test_size: int, parallel: boolean, debug: boolean>,
        results array<struct<cfg: struct<arima_order: array<int>, seasonal_order: array<int>,
            trend: string>, score_mean: double, score_se: double>>""",
    "forecasts": """output_variable string, date date, forecast double, se double,
        lower_ci double, upper_ci double""",
}

# Declared keys, and references as (child columns, parent table, parent columns). Tables
# by day are kept for many provinces or regions here, so these are part of their keys.
KEYS = {
    "province": ["name"],
    "province_data": ["name", "date"],
    "municipality": ["code"],
    "region_risk": ["region", "date"],
    "weather_station": ["station_id"],
}
REFERENCES = {
    "province_data": [(["name"], "province", ["name"])],
    "municipality": [(["province"], "province", ["name"])],
    "municipality_data": [(["code"], "municipality", ["code"])],
    "region_risk": [(["region"], "province", ["name"])],
    "vaccines_administration": [(["region"], "province", ["name"])],
    "vaccines_delivery": [(["region"], "province", ["name"])],
    "weather_data": [(["station_id"], "weather_station", ["station_id"])],
    "municipality_station_link": [(["municipality_code"], "municipality", ["code"]),
                                  (["station_id"], "weather_station", ["station_id"])],
}

# Names of the landed columns and what they are called here.
RENAMES = {
    "province_data": {
        "giorno": "date", "domicilio": "quarantined",
        "infettive": "hospitalized_infectious_diseases",
        "alta_int": "hospitalized_high_intensity", "terapia_in": "hospitalized_intensive_care",
        "guariti": "recovered", "deceduti": "deaths", "totale_pos": "cases", "pos_att": "active",
        "rsa": "active_rsa", "incremento": "new_cases", "casa_cura": "active_nursing_homes",
        "strut_int": "active_int_struct", "tot_rsa": "active_rsa_total",
        "dimessi": "discharged",
    },
    "municipality_data": {
        "aggiornamento": "date", "codice": "code", "contagi": "cases", "guariti": "recovered",
        "decessi": "deaths", "dimessi": "discharged",
    },
    "municipality": {"codice": "code", "comune": "name", "abitanti": "population"},
    "region_risk": {"data": "date", "denominazione_regione": "region", "colore": "risk"},
    "vaccines_administration": {
        "data_somministrazione": "date", "area": "region", "fornitore": "supplier",
        "fascia_anagrafica": "age_group", "sesso_maschile": "male", "sesso_femminile": "female",
        "prima_dose": "first_dose", "seconda_dose": "second_dose",
    },
    "vaccines_delivery": {
        "data_consegna": "date", "area": "region", "fornitore": "supplier",
        "numero_dosi": "n_doses",
    },
    "weather_station": {"id": "station_id", "nome": "name"},
}

ENTITIES = tuple(_DDL)


def schema_of(entity: str) -> StructType:
    return StructType.fromDDL(_DDL[entity])


def empty_table(spark, entity: str) -> DataFrame:
    """An entity table before its first load."""
    return spark.createDataFrame([], schema_of(entity))


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Exactly the columns of ``schema``: cast, NaN made NULL, absent ones NULL, others gone."""
    schema = schema_of(schema) if isinstance(schema, str) else schema
    have = dict(df.dtypes)
    out = []
    for field in schema.fields:
        if field.name not in have:
            value = F.lit(None).cast(field.dataType)
        else:
            value = F.col(field.name)
            if have[field.name] in ("double", "float"):
                value = F.when(~F.isnan(value), value)
            if have[field.name] != field.dataType.simpleString():
                value = value.try_cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)
