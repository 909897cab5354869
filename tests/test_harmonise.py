"""Source-shaped fixtures (own values) through the generic operators:
a wide sheet with rollups, a ';' CSV with BOM and decimal comma, a keyed
sheet with sentinel rows."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.functions.codes import label_by_rules, level_of
from harmoniq.functions.text import lenient_long
from harmoniq.operators import harmonise as H
from harmoniq.operators import quality as Q
from harmoniq.session import to_local_path
from harmoniq.sources import files as S
from harmoniq.sources.shapes import CELL_TABLE, sheet_records

REGIONS = T.StructType([T.StructField("code", T.StringType()), T.StructField("population_latest", T.LongType())])


def _uk_cells(spark):
    cells = [(r, 0, t) for r, t in enumerate(["Police recorded crime", "Year ending March 2025", "",
                                               "Source: own fixture", "Notes: see end", ""], start=1)]
    header = ["Area Code", "Area Name", "Homicide", "Violence with\ninjury [note 2]", "Robbery",
              "Sexual offences", "Knife crime", "Firearms", "Other theft"]
    cells += [(7, c, h) for c, h in enumerate(header)]
    areas = [("K04000001", "England and Wales", [700, 9000, 800, 700, 400, 90, 5000]),
             ("E92000001", "England", [650, 8000, 700, 650, 380, 80, 4500]),
             ("E12000001", "North East", [20, 300, 30, 25, 10, 3, 200]),
             ("E23000001", "Metropolitan Police", [137, 5000, 600, 300, 250, 40, 2000]),
             ("E23000002", "City of London", [0, 50, 5, 3, 2, "x", 30]),
             ("W92000004", "Wales", [40, 700, 50, 40, 20, 5, 300]),
             ("E23000003", "Kent", [15, 900, 40, 60, 30, 4, 400]),
             ("W15000001", "Dyfed-Powys", [2, 100, 3, 9, 2, 0, 50]),
             ("E12000007", "London", [137, 5050, 605, 303, 252, 40, 2030]),
             ("E23000004", "Surrey", [5, 400, 10, 20, 8, 1, 150]),
             ("W15000002", "Gwent", [4, 300, 8, 15, 6, 2, 120])]
    for i, (code, name, vals) in enumerate(areas):
        r = 8 + i
        cells += [(r, 0, code), (r, 1, name)] + [(r, 2 + j, str(v)) for j, v in enumerate(vals)]
    rows = [("uk.xlsx", "Table P1", r, c, v) for r, c, v in cells]
    rows += [("uk.xlsx", "Cover", 1, 0, "Area Code")]       # another sheet is ignored
    return spark.createDataFrame(rows, CELL_TABLE)


UK_FORCES = [("metropolitan police", "UKI"), ("city of london", "UKI"), ("kent", "UKJ"), ("surrey", "UKJ"),
             ("dyfed-powys", "UKL"), ("gwent", "UKL")]
UK_CATEGORIES = [("Homicide", "homicide"), ("Violence with injury", "assault_serious"),
                 ("Robbery", "robbery_violent"), ("Sexual offences", "sexual_assault"),
                 ("Knife crime", "knife_offence"), ("Firearms", "firearm_offence")]


def test_uk_wide_sheet(spark):
    rec = sheet_records(_uk_cells(spark), "Table", "area code", 2)
    leaf = rec.filter(F.col("key_1").startswith("E23") | F.col("key_1").startswith("W15"))      # P3
    assert leaf.select("key_1").distinct().count() == 6
    long = leaf.select(F.col("key_2").alias("force"), F.col("measure").alias("offence"),
                       lenient_long("value", "null").alias("count")).filter(F.col("count").isNotNull())
    forces = H.literal_map(spark, UK_FORCES, "name", "code")
    long = H.map_values(long, "force", forces, "name", "code", "region_code",
                        key_fn=lambda c: F.lower(F.trim(c)))
    cats = H.literal_map(spark, UK_CATEGORIES, "native", "crime_category")
    long = H.map_values(long, "offence", cats, "native", "crime_category", "crime_category")
    agg = H.sum_counts(long, ["region_code", "crime_category"], "count", native="offence")
    dims = spark.createDataFrame([("UKI", 9_000_000), ("UKJ", 3_300_000), ("UKL", 1_100_000)], REGIONS)
    facts = H.with_rate(H.attach_population(agg, dims))
    canon = H.canonicalise(facts, source_country="UK", source_authority="own", source_url="fixture",
                           source_file_hash="", retrieved_at=F.lit("2025-06-01 00:00:00").cast("timestamp_ntz"),
                           period_start=F.lit("2024-04-01").cast("date"), period_end=F.lit("2025-03-31").cast("date"),
                           period_type="year", region_level=level_of("region_code"), suspect_dim="total")
    rows = {(r["region_code"], r["crime_category"]): r for r in canon.collect()}
    assert rows[("UKI", "homicide")]["count"] == 137            # 137 + 0, two forces -> one region
    assert ("UKI", "firearm_offence") in rows                    # 'x' cell dropped, Met's 40 kept
    assert rows[("UKI", "firearm_offence")]["count"] == 40
    assert not [k for k in rows if k[1] not in dict(UK_CATEGORIES).values()]  # 'Other theft' unmapped
    assert all(r["rate_per_100k"] > 0 for r in rows.values() if r["count"] > 0)
    assert Q.duplicate_keys(canon, ["source_country", "period_start", "region_code", "crime_category",
                                    "suspect_dim", "suspect_dim_value"]).count() == 0
    assert {r["rule"]: r["n_violations"] for r in Q.rule_counts(canon, Q.aggregate_rules()).collect()} == \
        {n: 0 for n, _ in Q.aggregate_rules()}


FR_COLS = ["Code_departement", "Code_region", "annee", "indicateur", "unite_de_compte", "nombre",
           "taux_pour_mille", "insee_pop", "insee_pop_millesime", "insee_log", "insee_log_millesime"]


def test_fr_semicolon_bom_decimal_comma(spark, scratch):
    lines = [";".join(FR_COLS)]
    data = [("01", "84", "2023", "Coups et blessures volontaires", "Victime", "1200", "1,8"),
            ("01", "84", "2024", "Coups et blessures volontaires", "Victime", "1300", "1,9"),
            ("13", "93", "2024", "Vols violents sans arme", "Victime", "9000", "4,4"),
            ("13", "93", "2024", "Vols avec armes", "Victime", "5000", "2,4"),
            ("13", "93", "2023", "Vols avec armes", "Victime", "4000", "2,0"),
            ("75", "11", "2024", "Homicides", "Victime", "90", "0,0135"),
            ("75", "11", "2023", "Homicides", "Victime", "85", "0,0127"),
            ("75", "11", "2024", "Violences sexuelles", "Victime", "7000", "3,2"),
            ("75", "11", "2024", "Coups et blessures volontaires", "Victime", "15000", "6,9"),
            ("75", "11", "2024", "Vols de véhicules", "Véhicule", "20000", "9,1")]
    for d in data:
        lines.append(";".join(list(d) + ["650000", "2021", "300000", "2021"]))
    path = scratch("fr")
    os.makedirs(to_local_path(path), exist_ok=True)
    with open(os.path.join(to_local_path(path), "delinquance.csv"), "w", encoding="utf-8-sig") as f:
        f.write("\n".join(lines) + "\n")
    df = S.read_delimited(spark, path, FR_COLS, sep=";", decimal_comma_cols=("taux_pour_mille",))
    assert df.columns[0] == "Code_departement"
    kept = df.filter(F.col("unite_de_compte").isin("Victime", "Infraction"))                      # P1
    assert kept.count() == 9
    assert kept.filter(F.col("nombre") == "90").first()["taux_pour_mille"] == 0.0135
    cats = H.literal_map(spark, [("Vols violents sans arme", "robbery_violent"), ("Vols avec armes", "robbery_violent"),
                                 ("Homicides", "homicide"), ("Coups et blessures volontaires", "assault_serious"),
                                 ("Violences sexuelles", "sexual_assault")], "native", "crime_category")
    m = H.map_values(kept, "indicateur", cats, "native", "crime_category", "crime_category")
    m = H.keep_recent(m.withColumn("year", F.col("annee").cast("int")), "year", 10)
    agg = H.sum_counts(m.withColumn("n", F.col("nombre").cast("bigint")),
                       ["Code_departement", "crime_category", "year"], "n", native="indicateur")
    row = agg.filter((F.col("Code_departement") == "13") & (F.col("year") == 2024)).first()
    assert row["count"] == 14000 and row["crime_category_native"] == "Vols avec armes, Vols violents sans arme"


def test_de_keyed_sheet_with_sentinels(spark):
    rows = [(6, 0, "Schlüssel"), (6, 1, "Straftat"), (6, 2, "Jahr"), (6, 3, "Fälle")]
    data = [("892500", "Mord", 2024, 800), ("892000", "Totschlag", 2024, 1500), ("222000", "Körperverletzung", 2024, 300),
            ("------", "Summe", 2024, 99999), ("999999", "Unbekannt", 2024, 7), ("892500", "Mord", 2023, 790)]
    for i, (k, name, y, n) in enumerate(data):
        r = 11 + i
        rows += [(r, 0, k), (r, 1, name), (r, 2, str(y)), (r, 3, str(n))]
    cells = spark.createDataFrame([("tatverdaechtige_nichtdeutsch.xlsx", "T01", r, c, v) for r, c, v in rows],
                                  CELL_TABLE)
    rec = sheet_records(cells, "T0", "Schlüssel", 1)
    wide = rec.groupBy("file", "row", "key_1").pivot("measure", ["Straftat", "Jahr", "Fälle"]).agg(F.first("value"))
    parsed = wide.filter(F.col("key_1").rlike(r"^\d{6}$"))                                        # P4
    assert parsed.filter(F.col("key_1") == "------").count() == 0
    keys = H.literal_map(spark, [("892500", "homicide"), ("892000", "homicide"), ("222000", "assault_serious")],
                         "k", "crime_category")
    m = H.map_values(parsed, "key_1", keys, "k", "crime_category", "crime_category")
    m = H.keep_latest(m.withColumn("year", F.col("Jahr").cast("int")), "year")
    m = m.withColumn("dim", label_by_rules("file", [("nichtdeutsch", "foreign"), ("deutsch", "national")], "total"))
    agg = H.sum_counts(m.withColumn("n", F.col("Fälle").cast("bigint")), ["crime_category", "year", "dim"], "n")
    got = {r["crime_category"]: (r["count"], r["year"], r["dim"]) for r in agg.collect()}
    assert got == {"homicide": (2300, 2024, "foreign"), "assault_serious": (300, 2024, "foreign")}
    assert spark.range(1).select(level_of(F.lit("DE")).alias("l")).first()["l"] == 0


def test_alias_lookup_and_denominator_fallback(spark):
    direct = spark.createDataFrame([("Castellón", "ES523"), ("Álava", "ES211")], "name string, code string")
    aliases = H.literal_map(spark, [("Araba", "ES211"), ("Castelló", "ES523")], "alias", "code")
    src = spark.createDataFrame([("CASTELLON ",), ("araba",), ("Castello",), ("Nowhere",)], "prov string")
    from harmoniq.functions.text import fold_key
    got = [r["code"] for r in H.two_pass_lookup(src, "prov", direct, aliases, "code", fold_key)
           .orderBy("prov").collect()]
    assert got == ["ES523", "ES523", None, "ES211"]       # sorted: CASTELLON, Castello, Nowhere, araba
    df = spark.createDataFrame([(100, 5), (0, 7), (None, 9), (None, None)], "d long, s long")
    v, lab = H.denominator_fallback("d", "s", "dim", "src")
    assert [(r["v"], r["l"]) for r in df.select(v.alias("v"), lab.alias("l")).collect()] == \
        [(100, "dim"), (7, "src"), (9, "src"), (None, None)]


def test_complete_years_and_unit_preference(spark):
    q = spark.createDataFrame([("A", y, qt, 1) for y in (2019, 2020) for qt in (1, 2, 3, 4)]
                              + [("A", 2021, 1, 1), ("A", 2021, 2, 1), ("B", 2018, 1, 5)],
                              "g string, year int, quarter int, count long")
    annual = H.quarters_to_years(q, ["g"], "year", "quarter")
    kept = {(r["g"], r["year"]) for r in H.keep_complete_years(annual).collect()}
    assert kept == {("A", 2019), ("A", 2020), ("B", 2018)}        # 2021 incomplete, older incomplete kept
    u = spark.createDataFrame([("i1", "Victime"), ("i1", "Infraction"), ("i2", "Infraction")], "ind string, unit string")
    got = sorted((r["ind"], r["unit"]) for r in H.prefer_unit(u, "ind", "unit", "Victime", "Infraction").collect())
    assert got == [("i1", "Victime"), ("i2", "Infraction")]


def test_run_sources_order_and_isolation(spark, scratch):
    """Later sources replace earlier rows on the natural key (NULL == ''),
    a broken source is recorded and skipped, others still land."""
    rows = spark.createDataFrame([("A", "DE1", 2024, 5), ("A", "DE2", 2024, 7), ("B", "DE1", 2023, 1)],
                                 "label string, area string, year int, n long")
    dims = spark.createDataFrame([("DE1", 1000), ("DE2", 2000)], REGIONS)
    areas = H.literal_map(spark, [("DE1", "DE1"), ("DE2", "DE2")], "native", "code")
    base = dict(country="DE", url="u", category_map=[("A", "homicide"), ("B", "robbery_violent")],
                native_category="label", count="n", year="year", region="area", region_map=areas, retention="all")
    supplement = rows.filter(F.col("area") == "DE1").withColumn("n", F.col("n") * 10)
    sources = [("native", rows, H.SourceSpec(authority="native", **base)),
               ("broken", rows, H.SourceSpec(authority="x", **{**base, "count": "missing_col"})),
               ("supplement", supplement, H.SourceSpec(authority="supplement", **base))]
    path = scratch("canon")
    runs = {r["source"]: r for r in H.run_sources(spark, sources, dims, path, as_of="2025-01-01 00:00:00").collect()}
    assert runs["native"]["status"] == "ok" and runs["native"]["n_rows"] == 3
    assert runs["broken"]["status"] == "failed" and runs["broken"]["error"]
    out = {(r["region_code"], r["crime_category"], r["period_start"].year): (r["count"], r["source_authority"])
           for r in spark.read.parquet(path).collect()}
    assert out == {("DE1", "homicide", 2024): (50, "supplement"), ("DE2", "homicide", 2024): (7, "native"),
                   ("DE1", "robbery_violent", 2023): (10, "supplement")}


def test_conform_strict_schema(spark):
    import pytest
    from harmoniq.schema import CRIME_AGGREGATES
    df = spark.createDataFrame([("FR", "x")], "source_country string, extra string")
    with pytest.raises(Q.SchemaMismatch):
        Q.conform(df, CRIME_AGGREGATES)
    loose = Q.conform(df.drop("extra"), CRIME_AGGREGATES, strict=False)
    assert loose.schema.names == CRIME_AGGREGATES.names
    bad = spark.createDataFrame([("FR", "notanumber")], "source_country string, count string")
    typed = Q.conform(bad, T.StructType([T.StructField("source_country", T.StringType()),
                                         T.StructField("count", T.LongType())]))
    assert typed.first()["count"] is None


def test_harmonise_with_mapping_file(spark, scratch):
    """A region map read from a mapping CSV ('#' comments, four columns) maps
    native codes to the nuts_code column, not to the name."""
    path = to_local_path(scratch("maps"))
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "region_map.csv"), "w") as f:
        f.write("native_code,native_name,nuts_code,notes\n# comment line\n01,Ain,FRK21,\n13,Bouches,FRL04,\n")
    rm = S.read_mapping(spark, path)
    rows = spark.createDataFrame([("A", "01", 2024, 5), ("A", "13", 2024, 7), ("A", "99", 2024, 1)],
                                 "label string, dep string, year int, n long")
    dims = spark.createDataFrame([("FRK21", 650000), ("FRL04", 2000000)], REGIONS)
    spec = H.SourceSpec(country="FR", authority="a", url="u", category_map=[("A", "homicide")],
                        native_category="label", count="n", year="year", region="dep", region_map=rm,
                        retention="all")
    got = {r["region_code"]: r["count"] for r in H.harmonise(spark, rows, spec, dims).collect()}
    assert got == {"FRK21": 5, "FRL04": 7}


def test_run_sources_merges_into_existing_table(spark, scratch):
    rows = spark.createDataFrame([("A", "DE1", 2024, 5)], "label string, area string, year int, n long")
    dims = spark.createDataFrame([("DE1", 1000)], REGIONS)
    areas = H.literal_map(spark, [("DE1", "DE1")], "native", "code")
    base = dict(url="u", category_map=[("A", "homicide")], native_category="label", count="n", year="year",
                region="area", region_map=areas, retention="all")
    path = scratch("canon2")
    H.run_sources(spark, [("de", rows, H.SourceSpec(country="DE", authority="de", **base))], dims, path,
                  as_of="2025-01-01 00:00:00")
    H.run_sources(spark, [("at", rows, H.SourceSpec(country="AT", authority="at", **base))], dims, path,
                  as_of="2025-01-01 00:00:00")
    got = sorted((r["source_country"], r["count"]) for r in spark.read.parquet(path).collect())
    assert got == [("AT", 5), ("DE", 5)]                    # the second run did not replace the table
