"""The city declaration: three open datasets, their lookup, the master table, two models.

Fixed values: folder, column, indicator, experiment and model names, file patterns,
feature lists, parameter grids, fold counts and thresholds are given by the data and
by the tables and models to be produced.
"""

from __future__ import annotations

from yearloom.specs import (
    DatasetSpec,
    FactSpec,
    Family,
    LookupSpec,
    Measure,
    ModelSpec,
    PanelSpec,
    PeriodSpec,
)

INCOME_INDEX = "Índex RFD Barcelona = 100"

LISTINGS = DatasetSpec(
    name="idealista",
    format="json",
    glob="idealista/*.json",
    schema="""
        address string, bathrooms bigint, country string,
        detailedType struct<subTypology: string, typology: string>,
        distance string, district string, exterior boolean, externalReference string,
        floor string, has360 boolean, has3DTour boolean, hasLift boolean, hasPlan boolean,
        hasStaging boolean, hasVideo boolean, latitude double, longitude double,
        municipality string, neighborhood string, newDevelopment boolean, numPhotos bigint,
        operation string,
        parkingSpace struct<hasParkingSpace: boolean, isParkingSpaceIncludedInPrice: boolean,
                            parkingSpacePrice: double>,
        price double, priceByArea double, propertyCode string, propertyType string,
        province string, rooms bigint, showAddress boolean, size double, status string,
        suggestedTexts struct<subtitle: string, title: string>,
        thumbnail string, topNewDevelopment boolean, url string""",
    name_column="district",
    period=PeriodSpec("filename", pattern=r"(\d{4})_\d{2}_\d{2}_idealista\.json"),
)

INCIDENTS = DatasetSpec(
    name="incidences",
    format="csv",
    glob="incidences/*.csv",
    schema="""
        CODI_DISTRICTE int, DISTRICTE string, ANY_DATA_TANCAMENT int, DETALL string,
        BARRI string, FITXA_ID int, LATITUD double, AREA string, COORDENADA_Y double,
        COORDENADA_X double, LONGITUD double, DIA_DATA_ALTA int, CANALS_RESPOSTA string,
        NUMERO int, ELEMENT string, SECCIO_CENSAL int, MES_DATA_TANCAMENT int,
        TIPUS_VIA string, ANY_DATA_ALTA int, MES_DATA_ALTA int, SUPORT string,
        CARRER string, CODI_BARRI int, _id int, TIPUS string, DIA_DATA_TANCAMENT int""",
    name_column="DISTRICTE",
    period=PeriodSpec("parts", ("ANY_DATA_ALTA", "MES_DATA_ALTA", "DIA_DATA_ALTA")),
)

INCOME = DatasetSpec(
    name="income",
    format="csv",
    glob="income/*.csv",
    schema=f"""
        Any int, Codi_Districte int, Nom_Districte string, Codi_Barri int,
        Nom_Barri string, `Població` int, `{INCOME_INDEX}` string""",
    name_column="Nom_Districte",
    period=PeriodSpec("column", ("Any",)),
)

DATASETS = (LISTINGS, INCIDENTS, INCOME)

LOOKUP = LookupSpec(
    file="Income OpenDataBCN Extended.csv",
    name_column="district",
    id_column="district_id",
    schema="""
        district string, neighborhood string, district_n_reconciled string,
        district_n string, district_id string, neighborhood_n_reconciled string,
        neighborhood_n string, neighborhood_id string""",
)

MASTER = "district_kpis"
PANEL = PanelSpec(
    entity="district_id",
    period="year",
    facts=(
        FactSpec(
            "idealista",
            (
                Measure("avg_price", "avg", "price"),
                Measure("avg_size", "avg", "size"),
                Measure("avg_price_per_sqm", "avg", "priceByArea"),
                Measure("property_count", "count"),
            ),
            in_spine=False,
            gap_fill=True,
        ),
        FactSpec("incidences", (Measure("incidence_count", "count"),)),
        FactSpec("income", (Measure("avg_income_index", "avg", INCOME_INDEX),)),
    ),
)

FOREST = Family(
    "RandomForestRegressor", "forest", (("numTrees", (10, 20)), ("maxDepth", (5, 10)))
)
LINEAR = Family("LinearRegression", "linear", (("regParam", (0.1, 0.01)),))
ELASTIC = Family(
    "LinearRegression",
    "linear",
    (("regParam", (0.1, 0.01)), ("elasticNetParam", (0.5, 0.8))),
)

INCIDENT_MODEL = ModelSpec(
    experiment="District_Incidence_Prediction",
    model_name="DistrictIncidencePredictor",
    label="incidence_count",
    features=(
        "avg_income_index",
        "avg_price",
        "avg_size",
        "avg_price_per_sqm",
        "property_count",
    ),
    required=("incidence_count", "avg_income_index"),
    keys=("district_id", "year"),
    families=(ELASTIC, FOREST),
    folds=3,
    min_rows=50,
)

INCOME_MODEL = ModelSpec(
    experiment="District_Income_Prediction",
    model_name="DistrictIncomePredictor",
    label="avg_income_index",
    features=(
        "incidence_count",
        "avg_price",
        "avg_size",
        "avg_price_per_sqm",
        "property_count",
        "year",
    ),
    required=("avg_income_index", "incidence_count", "avg_price"),
    keys=("district_id", "year"),
    families=(LINEAR, FOREST),
    folds=2,
    min_rows=20,
)

MODELS = {"incident": INCIDENT_MODEL, "income": INCOME_MODEL}
