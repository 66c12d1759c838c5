"""Fixed lookup tables for tax IDs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# CIF letter, description, legal forms.
ENTITY_LETTERS = [
    ("a", "Sociedades anónimas", "s.a.,s.a.l.,s.a.u.,s.a.d.,s.a.e."),
    ("b", "Sociedades de responsabilidad limitada", "s.l.,s.l.l.,s.l.u.,s.l.p.,s.r.l.,s.l.n.e."),
    ("c", "Sociedades colectivas", "s.r.c."),
    ("d", "Sociedades comanditarias", "s.e.n.c."),
    ("e", "Comunidades de bienes", "c.b."),
    ("f", "Sociedades cooperativas", "coop.,s.c.a.,s.c.l.,s.c.i."),
    ("g", "Asociaciones y fundaciones", None),
    ("h", "Comunidades de propietarios en régimen de propiedad horizontal", None),
    ("j", "Sociedades civiles", "s.c.,s.c.p."),
    ("n", "Entidades no residentes", None),
    ("p", "Corporaciones locales", None),
    ("q", "Organismos autónomos, estatales o no, y asimilados, y congregaciones e instituciones religiosas", None),
    ("r", "Congregaciones e instituciones religiosas", None),
    ("s", "Órganos de la Administración del Estado y comunidades autónomas", None),
    ("u", "Uniones Temporales de Empresas", "u.t.e."),
    ("v", "Sociedad Agraria de Transformación", "s.a.t."),
    ("w", "Establecimientos permanentes de entidades no residentes en España", None),
]

# Province codes, province.
PROVINCE_CODES = [
    ("00", "No Residente"),
    ("01", "Álava"),
    ("02", "Albacete"),
    ("03,53,54", "Alicante"),
    ("04", "Almería"),
    ("05", "Ávila"),
    ("06", "Badajoz"),
    ("07,57", "Islas Baleares"),
    ("08,58,59,60,61,62,63,64,65,66,68", "Barcelona"),
    ("09", "Burgos"),
    ("10", "Cáceres"),
    ("11,72", "Cádiz"),
    ("12", "Castellón"),
    ("13", "Ciudad Real"),
    ("14,56", "Córdoba"),
    ("15,70", "La Coruña"),
    ("16", "Cuenca"),
    ("17,55,67", "Gerona"),
    ("18", "Granada"),
    ("19", "Guadalajara"),
    ("20,71", "Guipúzcoa"),
    ("21", "Huelva"),
    ("22", "Huesca"),
    ("23", "Jaén"),
    ("24", "León"),
    ("25", "Lérida"),
    ("26", "La Rioja"),
    ("27", "Lugo"),
    ("28,78,79,80,81,82,83,84,85,86,87,88", "Madrid"),
    ("29,92,93", "Málaga"),
    ("30,73", "Murcia"),
    ("31", "Navarra"),
    ("32", "Orense"),
    ("33,74", "Asturias"),
    ("34", "Palencia"),
    ("35,75", "Las Palmas"),
    ("36,94", "Pontevedra"),
    ("37", "Salamanca"),
    ("38,76", "Santa Cruz de Tenerife"),
    ("39", "Cantabria"),
    ("40", "Segovia"),
    ("41,90,91", "Sevilla"),
    ("42", "Soria"),
    ("43,77", "Tarragona"),
    ("44", "Teruel"),
    ("45", "Toledo"),
    ("46,96,97,98", "Valencia"),
    ("47", "Valladolid"),
    ("48,95", "Vizcaya"),
    ("49", "Zamora"),
    ("50,99", "Zaragoza"),
    ("51", "Ceuta"),
    ("52", "Melilla"),
]

# Two-letter VAT prefixes, country.
COUNTRIES = [
    ("at", "Austria"),
    ("be", "Belgium"),
    ("bg", "Bulgaria"),
    ("cy", "Cyprus"),
    ("cz", "Czechia"),
    ("de", "Germany"),
    ("dk", "Denmark"),
    ("ee", "Estonia"),
    ("el", "Greece"),
    ("es", "Spain"),
    ("fi", "Finland"),
    ("fr", "France"),
    ("hr", "Croatia"),
    ("hu", "Hungary"),
    ("ie", "Ireland"),
    ("it", "Italy"),
    ("lt", "Lithuania"),
    ("lu", "Luxembourg"),
    ("lv", "Latvia"),
    ("mt", "Malta"),
    ("nl", "The Netherlands"),
    ("pl", "Poland"),
    ("pt", "Portugal"),
    ("ro", "Romania"),
    ("se", "Sweden"),
    ("si", "Slovenia"),
    ("sk", "Slovakia"),
    ("xi", "Northern Ireland"),
]


def entity_letters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ENTITY_LETTERS, "letter string, description string, forms string")


def provinces(spark: SparkSession) -> DataFrame:
    raw = spark.createDataFrame(PROVINCE_CODES, "codes string, province string")
    return expand_codes(raw, "codes", "code")


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRIES, "prefix string, country string")


def expand_codes(df: DataFrame, codes: str, code: str) -> DataFrame:
    """One row per code of a comma list."""
    return df.withColumn(code, F.explode(F.split(codes, ","))).drop(codes)
