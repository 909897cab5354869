"""Every published source as a step list, on rows in the publishers' shapes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harmoniq.operators import catalogue as C
from harmoniq.operators import steps as S
from harmoniq.operators.registry import RECORD, run_registry
from harmoniq.operators.snapshots import read_snapshot
from harmoniq.schema import CRIME_AGGREGATES

MAP = "native_code string, native_name string, nuts_code string, notes string"


@pytest.fixture(scope="module")
def regions(spark):
    rows = [(c, 100_000) for c in ("UKI", "UKK", "DE", "DE1", "IT", "ITC1", "ITH1", "ES421", "ES611", "SE", "DK01", "DK02",
                                   "NL11", "IE", "AT", "FRK21")] + [("FRE21", None), ("DE2", 0)]
    return spark.createDataFrame(rows, "code string, population_latest long")


def run(spark, source, rows, schema, regions, tally=None):
    df = spark.createDataFrame(rows, schema)
    out = S.harmonise_source(spark, df, source, regions, as_of="2026-01-01 00:00:00", tally=tally)
    return {(r["region_code"], r["crime_category"], r["suspect_dim"], r["period_end"].year): r for r in out.collect()}


def counts(got):
    return {k: r["count"] for k, r in got.items()}


def test_uk(spark, regions):
    m = spark.createDataFrame([("metropolitan", "Metropolitan Police", "UKI", ""), ("city-of-london", "City of London", "UKI", ""),
                               ("avon", "Avon and Somerset", "UKK", "")], MAP)
    f = "pfatables-yearending-september-2025.xlsx"
    rows = [("E23000001", "Metropolitan Police", "Homicide", "100", f), ("E23000034", "City of LONDON [note 3]", "Homicide", "2", f),
            ("E23000001", "Metropolitan Police", "Robbery", "[x]", f), ("E12000007", "London", "Homicide", "102", f),
            ("W15000001", "Avon and Somerset ", "Violence with injury", "7.0", f), ("E23000009", "Elsewhere", "Homicide", "5", f),
            ("E23000001", "Metropolitan Police", "Shoplifting", "9", f), (None, None, None, None, f),
            ("E23000001", "Metropolitan Police", "Robbery", "4", "tables.xlsx")]
    tally = S.Tally()
    got = run(spark, C.uk(m), rows, "area_code string, force_native string, offence_native string, count string, file string",
              regions, tally)
    assert counts(got) == {("UKI", "homicide", "total", 2025): 102, ("UKK", "assault_serious", "total", 2025): 7}
    r = got["UKI", "homicide", "total", 2025]
    assert (r["period_start"], r["period_end"], r["period_type"]) == (dt.date(2024, 10, 1), dt.date(2025, 9, 30), "year")
    assert r["region_level"] == 1 and r["rate_per_100k"] == pytest.approx(102.0)
    told = tally.get()
    assert {k: told[k] for k in ("rows_in", "filtered", "no_count", "unmapped_region", "unmapped_category", "no_period",
                                 "rows_kept")} == dict(rows_in=9, filtered=2, no_count=1, unmapped_region=1,
                                                       unmapped_category=1, no_period=1, rows_kept=3)


def test_fr(spark, regions):
    m = spark.createDataFrame([("01", "Ain", "FRK21", ""), ("02", "Aisne", "FRE21", "")], MAP)
    rows = [("01", str(y), "Homicides", u, n, "600000") for y in (2010, 2020) for u, n in
            (("Victime", "5"), ("Infraction", "9"), ("Mis en cause", "3"))]
    rows += [("02", "2020", "Vols avec armes", "Infraction", "8", "500000"), ("02", "2020", "Vols violents sans arme", "Infraction", "n.d.", "510000.0"),
             ("2A", "2020", "Homicides", "Victime", "1", "1"), ("01", "2020", "Cambriolages de logement", "Victime", "1", "1"),
             ("01", "zz", "Homicides", "Victime", "1", "1")]
    tally = S.Tally()
    got = run(spark, C.fr(m), rows, "Code_departement string, annee string, indicateur string, unite_de_compte string, "
                                    "nombre string, insee_pop string", regions, tally)
    assert counts(got) == {("FRK21", "homicide", "total", 2020): 5, ("FRE21", "robbery_violent", "total", 2020): 8}
    own, dim = got["FRE21", "robbery_violent", "total", 2020], got["FRK21", "homicide", "total", 2020]
    assert (own["denominator_population"], own["denominator_source"]) == (510_000, "INSEE recensement")
    assert (dim["denominator_population"], dim["denominator_source"]) == (100_000, "Eurostat NUTS 2021")
    assert own["crime_category_native"] == "Vols avec armes, Vols violents sans arme"
    told = tally.get()
    lost = sum(told[k] for k in ("filtered", "no_period", "unmapped_category", "unmapped_region", "other_unit", "old_periods"))
    assert told["rows_in"] == lost + told["rows_kept"] and told["coerced"] == 1 and told["old_periods"] == 1


def test_de_federal_and_states(spark, regions):
    rows = [(k, "Mord", y, n, f) for f, n in (("t50-nichtdeutsch.xlsx", "3"), ("t40-DEUTSCH.xlsx", "4"), ("t20.xlsx", "7"))
            for k in ("010000", "020000", "999999", "Summe") for y in ("2023", "2024")]
    got = run(spark, C.de_federal(), rows, "schluessel string, straftat string, jahr string, count string, file string", regions)
    assert counts(got) == {("DE", "homicide", d, 2024): 2 * n for d, n in (("foreign", 3), ("national", 4), ("total", 7))}
    assert got["DE", "homicide", "total", 2024]["region_level"] == 0
    m = spark.createDataFrame([("bw", " Baden-Württemberg", "DE1", ""), ("by", "Bayern", "DE2", "")], MAP)
    made = dt.datetime(2025, 3, 1)
    rows = [("010000", "Mord", "Baden-Württemberg ", str(n), "la-tv-05-nichtdeutsch.xlsx", made) for n in (3, 4)]     # both sexes
    rows += [("010000", "Mord", "Bund echte Zählung", "99", "x", made), ("020000", "Totschlag", "Bayern", "-", "x", made),
             ("010000", "Mord", "Bayern", "5", "x", None)]
    got = run(spark, C.de_states(m), rows, "schluessel string, straftat string, bundesland string, count string, file string, "
                                           "modified timestamp_ntz", regions)
    assert counts(got) == {("DE1", "homicide", "foreign", 2024): 7, ("DE2", "homicide", "total", 2024): 0}
    assert got["DE2", "homicide", "total", 2024]["rate_per_100k"] is None          # a population of 0 is none


SDMX = "REF_AREA string, DATA_TYPE string, AGE string, CITIZENSHIP string, COUNTRY_CITIZEN string, TYPE_CRIME string, " \
       "TIME_PERIOD string, OBS_VALUE string"


def test_it_regional_and_citizenship(spark, regions):
    m = spark.createDataFrame([("ITC1", "Piemonte", "ITC1", ""), ("ITD1", "Bolzano", "ITH1", "")], MAP)
    rows = [(a, "VICTIM", "TOTAL", c, "WORLD", "INTENHOM", y, "2") for a in ("ITC1", "ITD1", "ITX") for c in ("TOTAL", "ITL")
            for y in ("2010", "2022") for _sex in (1, 2)]
    rows += [("ITC1", "OFFEND", "TOTAL", "TOTAL", "WORLD", "RAPE", "2022", "9"), ("ITC1", "VICTIM", "Y18", "TOTAL", "WORLD", "RAPE", "2022", "9")]
    got = run(spark, C.it_regional(m), rows, SDMX, regions)
    assert counts(got) == {("ITC1", "homicide", "total", 2022): 4, ("ITH1", "homicide", "total", 2022): 4}
    rows = [("IT", "VICTIM", age, c, "WORLD", "RAPE", y, "5") for age in ("Y1", "Y2") for c in ("TOTAL", "ITL", "FRG", "X")
            for y in ("2021", "2022")] + [("ITC1", "VICTIM", "Y1", "TOTAL", "WORLD", "RAPE", "2023", "5")]
    got = run(spark, C.it_citizenship(), rows, SDMX, regions)
    assert counts(got) == {("IT", "sexual_assault", d, 2022): 10 for d in ("total", "national", "foreign")}


def test_es_names_in_two_passes(spark, regions):
    m = spark.createDataFrame([("02", "Albacete", "ES421", ""), ("04", "Almería", "ES611", "")], MAP)
    rows = [("ALBACETE", "1.2.-Lesiones", 2024, 5), ("Almeria ", "1.2.-Lesiones", 2024, 6), ("Provincia de Almería", "3.1.-Agresión sexual", 2024, 1),
            ("Almería", "3.2.-Agresión sexual con penetración", 2024, 2), ("TOTAL NACIONAL", "1.2.-Lesiones", 2024, 11),
            ("Albacete", "1.2.-Lesiones", 2014, 9), ("Albacete", "1.2.-Lesiones", 2015, None)]
    got = run(spark, C.es(m, [("provincia de almeria", "almería")]), rows, "province string, category_native string, year int, count long", regions)
    assert counts(got) == {("ES421", "assault_serious", "total", 2024): 5, ("ES611", "assault_serious", "total", 2024): 6,
                           ("ES611", "sexual_assault", "total", 2024): 3}


def test_se_takes_the_newest_column_even_without_numbers(spark, regions):
    rows = [(label, y, n) for label, _ in C.SE_CATEGORIES for y, n in ((2023, "10"), (2024, "12"))]
    rows[1] = (rows[1][0], 2024, "..")
    rows += [("Andra brott", 2025, "9")]
    schema = "brottstyp string, year int, count string"
    got = run(spark, C.se(), rows[:-1], schema, regions)
    assert counts(got) == {("SE", c, "total", 2024): 12 for c in ("assault_serious", "sexual_assault", "robbery_violent")}
    assert got["SE", "robbery_violent", "total", 2024]["crime_category_native"] == "Rån, totalt"
    assert run(spark, C.se(), rows, schema, regions) == {}


def test_dk_complete_years(spark, regions):
    m = spark.createDataFrame([("Region Hovedstaden", "Region Hovedstaden", "DK01", ""), ("Region Sjælland", "", "DK02", "")], MAP)
    rows = [(a, "Manddrab", f"{y}K{q}", "3") for a in ("Region Hovedstaden", "Region Sjælland", "Uoplyst") for y in range(2010, 2025)
            for q in (1, 2, 3, 4) if (y, q) != (2024, 4)] + [("Region Sjælland", "Manddrab", "2024X", "9"), ("Region Sjælland", "Røveri", "2023K1", "..")]
    got = run(spark, C.dk(m), rows, "`OMRÅDE` string, `OVERTRÆD` string, TID string, INDHOLD string", regions)
    assert counts(got) == {(a, "homicide", "total", y): 12 for a in ("DK01", "DK02") for y in range(2014, 2024)} | {
        ("DK02", "robbery_violent", "total", 2023): 0}


def test_nl_and_ie(spark, regions):
    m = spark.createDataFrame([("PV20", "Groningen", "NL11", "")], MAP)
    rows = [("PV20  ", c, f"{y}JJ00", n) for c, n in (("CRI3100 ", 5), ("CRI3400 ", 7), ("CRI1110", None)) for y in (2012, 2024)]
    got = run(spark, C.nl(m), rows, "RegioS string, SoortMisdrijf string, Perioden string, TotaalGeregistreerdeMisdrijven_1 long", regions)
    assert counts(got) == {("NL11", "assault_serious", "total", 2024): 5, ("NL11", "robbery_violent", "total", 2024): 0}
    rows = [("Murder (0111)", 2024, 3), ("Manslaughter (0112)", 2024, 4), ("Murder (0111)", 2014, 9), ("Burglary (071)", 2025, 1)]
    got = run(spark, C.ie(), rows, "offence string, year int, count long", regions)
    assert counts(got) == {("IE", "homicide", "total", 2024): 7}


def test_eurostat_and_supplement(spark, regions):
    rows = [("AT", "ICCS0101", "NR", "2023", "60"), ("AT", "ICCS0401", "P_HTHAB", "2023", "1"), ("AT", "ICCS0101", "NR", "2013", "60"),
            ("BE", "ICCS0101", "NR", "2023", "70"), ("AT", "ICCS0301", "NR", "2022", ":")]
    schema = "geo string, iccs string, unit string, TIME_PERIOD string, OBS_VALUE string"
    got = run(spark, C.eurostat("AT"), rows, schema, regions)
    assert counts(got) == {("AT", "homicide", "total", 2023): 60, ("AT", "sexual_assault", "total", 2022): 0}
    assert got["AT", "homicide", "total", 2023]["crime_category_native"] == "Eurostat ICCS0101"
    got = run(spark, C.eurostat("AT", supplement=True), rows, schema, regions)
    assert got["AT", "homicide", "total", 2023]["crime_category_native"] == "Eurostat ICCS0101 (NUTS-0)"
    assert run(spark, C.eurostat("UK", supplement=True), rows, schema, regions) == {}      # absent: no rows, no error


def test_step_lists_are_checked():
    with pytest.raises(ValueError, match="exactly one of Count"):
        S.check_steps(S.Source("X", "a", "u", (S.CalendarYear("y"), S.Nation("X"), S.Sum("c"))))
    with pytest.raises(ValueError, match="zero or dropped"):
        S.Count("n", "ignore")


def test_registry_records_and_refuses(spark, scratch, regions):
    schema = "geo string, iccs string, unit string, TIME_PERIOD string, OBS_VALUE string"
    good = spark.createDataFrame([("AT", "ICCS0101", "NR", str(y), "6") for y in range(2010, 2024)], schema)
    twice = spark.createDataFrame([("IE", "ICCS0101", "NR", "2023", "6")] * 2, schema)
    negative = spark.createDataFrame([("SE", "ICCS0101", "NR", "2023", "-6"), ("SE", "ICCS0401", "NR", "2023", "6")], schema)
    newer = spark.createDataFrame([("AT", "ICCS0101", "NR", "2023", "9")], schema)
    root = scratch("registry")
    runs = run_registry(spark, [("at", good, C.eurostat("AT")), ("twice", twice, C.eurostat("IE")),
                                ("negative", negative, C.eurostat("SE")), ("broken", good.drop("unit"), C.eurostat("DK")),
                                ("none", good.limit(0), C.eurostat("NL")), ("absent", good, C.eurostat("PT")), ("again", newer, C.eurostat("AT"))], regions, root)
    assert runs.schema == RECORD
    got = {r["source"]: r for r in runs.collect()}
    assert [got[s]["status"] for s in ("at", "twice", "negative", "broken", "none", "absent", "again")] == \
        ["ok", "failed", "failed", "failed", "ok", "ok", "ok"]
    at = got["at"]
    assert (at["rows_in"], at["old_periods"], at["rows_kept"], at["n_rows"], at["n_regions"]) == (14, 4, 10, 10, 1)
    assert (at["min_period"], at["max_period"]) == (dt.date(2014, 1, 1), dt.date(2023, 12, 31))
    assert "repeated keys: 1" in got["twice"]["error"] and "count_non_negative: 1 rows" in got["negative"]["error"]
    assert (got["absent"]["rows_in"], got["absent"]["filtered"], got["absent"]["n_rows"]) == (14, 14, 0)
    assert got["none"]["n_rows"] == got["none"]["rows_in"] == 0
    table = read_snapshot(spark, root, CRIME_AGGREGATES)
    assert sorted((r["source_country"], r["period_start"].year, r["count"]) for r in table.collect()) == \
        [("AT", y, 6) for y in range(2014, 2023)] + [("AT", 2023, 9)]


def test_retention_must_be_stated():
    from harmoniq.operators.harmonise import SourceSpec
    with pytest.raises((TypeError, ValueError), match="retention"):
        SourceSpec(country="FR", authority="a", url="u", category_map=[], native_category="c", count="n", year="y")


def test_no_release_is_an_error(spark):
    from harmoniq.sources.shapes import pick_release
    landed = spark.createDataFrame([("tables-yearending-march-2019.xlsx",), ("tables-yearending-june-2020.xlsx",)], "name string")
    with pytest.raises(Exception, match="2019-03-31, 2020-06-30"):
        pick_release(landed, "2026-01-01").collect()
    got = pick_release(landed, "2020-08-01").collect()
    assert [r["name"] for r in got] == ["tables-yearending-june-2020.xlsx"]
    assert pick_release(landed.limit(0), "2026-01-01").count() == 0
