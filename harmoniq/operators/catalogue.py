"""The published sources as step lists.

Category labels, dimension codes and filters are fixed values: they must equal
the publishers' own.  Region tables are landed mapping files (native_code,
native_name, nuts_code) and are passed in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from harmoniq.operators.steps import (CalendarYear, Category, CodeYear, CompleteYears, Count, Dimension, EachRow,
                                      FileYear, Keep, Latest, NamedDimension, Nation, Population, PreferUnit, Quarter,
                                      Recent, Region, RollingYear, Source, Sum)

# ---- fixed values: native label -> category ------------------------------------------------
UK_CATEGORIES = (
    ("Homicide", "homicide"),
    ("Violence with injury", "assault_serious"),
    ("Sexual offences", "sexual_assault"),
    ("Robbery", "robbery_violent"),
    ("Violence against the person", "violent_total"),
)
FR_CATEGORIES = (
    ("Homicides", "homicide"),
    ("Tentatives d'homicide", "attempted_homicide"),
    ("Violences physiques hors cadre familial", "assault_serious"),
    ("Violences physiques intrafamiliales", "assault_serious"),
    ("Violences sexuelles", "sexual_assault"),
    ("Vols violents sans arme", "robbery_violent"),
    ("Vols avec armes", "robbery_violent"),
)
DE_CATEGORIES = (
    ("892000", "violent_total"),
    ("010000", "homicide"),
    ("020000", "homicide"),
    ("110000", "sexual_assault"),
    ("210000", "robbery_violent"),
    ("222000", "assault_serious"),
)
IT_CATEGORIES = (
    ("INTENHOM", "homicide"),
    ("BLOWS", "assault_serious"),
    ("RAPE", "sexual_assault"),
)
IT_CITIZENSHIP = (("TOTAL", "total"), ("ITL", "national"), ("FRG", "foreign"))
ES_CATEGORIES = (
    ("1.1.1.-Homicidios dolosos/asesinatos consumados", "homicide"),
    ("1.2.-Lesiones", "assault_serious"),
    ("3.1.-Agresión sexual", "sexual_assault"),
    ("3.2.-Agresión sexual con penetración", "sexual_assault"),
    ("5.3.-Robos con violencia o intimidación", "robbery_violent"),
)
SE_CATEGORIES = (
    ("Fullbordat mord och dråp samt misshandel med dödlig utgång, totalt", "homicide"),
    ("Misshandel, ej med dödlig utgång, totalt", "assault_serious"),
    ("Våldtäkt, våldtäkt mot barn, oaktsam våldtäkt, totalt", "sexual_assault"),
    ("Rån, totalt", "robbery_violent"),
)
DK_CATEGORIES = (
    ("Manddrab", "homicide"),
    ("Forsøg på manddrab", "attempted_homicide"),
    ("Voldtægt mv.", "sexual_assault"),
    ("Røveri", "robbery_violent"),
    ("Alvorligere vold", "assault_serious"),
    ("Særlig alvorlig vold", "assault_serious"),
    ("Voldsforbrydelser i alt", "violent_total"),
)
NL_CATEGORIES = (
    ("CRI3100", "assault_serious"),
    ("CRI3300", "sexual_assault"),
    ("CRI1110", "robbery_violent"),
    ("CRI3000", "violent_total"),
)
IE_CATEGORIES = (
    ("Murder (0111)", "homicide"),
    ("Manslaughter (0112)", "homicide"),
    ("Infanticide (0113)", "homicide"),
    ("Assault causing harm, poisoning (034)", "assault_serious"),
    ("Other assault (035)", "assault_serious"),
    ("Rape of a male or female (0211)", "sexual_assault"),
    ("Aggravated sexual assault (0214)", "sexual_assault"),
    ("Sexual assault (not aggravated) (0215)", "sexual_assault"),
    ("Sexual offence involving mentally impaired person (0213)", "sexual_assault"),
    ("Other sexual offences (022)", "sexual_assault"),
    ("Robbery of an establishment or institution (0611)", "robbery_violent"),
    ("Robbery of cash or goods in transit (0612)", "robbery_violent"),
    ("Robbery from the person (0613)", "robbery_violent"),
    ("Carjacking, hijacking/unlawful seizure of aircraft/vessel (0631)", "robbery_violent"),
)
EUROSTAT_CATEGORIES = (
    ("ICCS0101", "homicide"),
    ("ICCS0102", "attempted_homicide"),
    ("ICCS020111", "assault_serious"),
    ("ICCS0301", "sexual_assault"),
    ("ICCS0401", "robbery_violent"),
)
# file-name rules of the federal series: the first that is contained wins
DE_DIMENSIONS = (("nichtdeutsch", "foreign"), ("deutsch", "national"))
KEY_PATTERN = "^[0-9]{6}$"
# ---- end of the fixed values ---------------------------------------------------------------


def labels(pairs) -> tuple:
    return tuple(native for native, _ in pairs)


def uk(region_map: DataFrame, url: str = "", categories=UK_CATEGORIES, prefixes=("E23", "W15")) -> Source:
    """(area_code, force_native, offence_native, count, file): police force areas; rollups have other codes."""
    return Source("UK", "ONS", url, (
        Keep("area_code", prefixes=prefixes), Count("count", "drop"),
        Region("force_native", region_map, key="lower", native_column="native_name"),
        Category("offence_native", categories), RollingYear("file"), Sum("offence_native"),
        Population("ONS mid-2023 estimates")))


def fr(region_map: DataFrame, url: str = "", categories=FR_CATEGORIES) -> Source:
    """(Code_departement, annee, indicateur, unite_de_compte, nombre, insee_pop): victims, else offences."""
    return Source("FR", "SSMSI", url, (
        Keep("unite_de_compte", one_of=("Victime", "Infraction")), CalendarYear("annee"), Count("nombre", "zero"),
        Category("indicateur", categories), Region("Code_departement", region_map),
        PreferUnit("indicateur", "unite_de_compte", "Victime", "Infraction"), Sum("indicateur"), Recent(10),
        Population("Eurostat NUTS 2021", "insee_pop", "INSEE recensement")))


def de_federal(url: str = "", categories=DE_CATEGORIES) -> Source:
    """(schluessel, straftat, jahr, count, file)."""
    return Source("DE", "BKA", url, (
        Keep("schluessel", pattern=KEY_PATTERN), CalendarYear("jahr"), Count("count", "zero"),
        Category("schluessel", categories), NamedDimension("file", DE_DIMENSIONS), Nation("DE"),
        Sum("straftat"), Latest(), Population("Eurostat / hand-curated mid-2024")))


def de_states(region_map: DataFrame, url: str = "", categories=DE_CATEGORIES) -> Source:
    """(schluessel, straftat, bundesland, count, file, modified): the file's year is the one before it was
    made; rows by sex are summed with the others."""
    return Source("DE", "BKA", url, (
        Keep("schluessel", pattern=KEY_PATTERN), FileYear("modified"), Count("count", "zero"),
        Category("schluessel", categories), NamedDimension("file", DE_DIMENSIONS),
        Region("bundesland", region_map, key="trim", native_column="native_name"),
        Sum("straftat"), Latest(), Population("Eurostat / hand-curated mid-2024")))


def it_regional(region_map: DataFrame, url: str = "", categories=IT_CATEGORIES) -> Source:
    """(REF_AREA, DATA_TYPE, AGE, CITIZENSHIP, COUNTRY_CITIZEN, TYPE_CRIME, TIME_PERIOD, OBS_VALUE)."""
    return Source("IT", "ISTAT", url, (
        Keep("DATA_TYPE", one_of=("VICTIM",)), Keep("AGE", one_of=("TOTAL",)), Keep("CITIZENSHIP", one_of=("TOTAL",)),
        Keep("COUNTRY_CITIZEN", one_of=("WORLD",)), CalendarYear("TIME_PERIOD"), Count("OBS_VALUE", "zero"),
        Category("TYPE_CRIME", categories), Region("REF_AREA", region_map), Sum("TYPE_CRIME", ("REF_AREA",)),
        Recent(10), Population("Eurostat NUTS 2021")))


def it_citizenship(url: str = "", categories=IT_CATEGORIES) -> Source:
    """The sibling series by citizenship; all ages are summed."""
    return Source("IT", "ISTAT", url, (
        Keep("DATA_TYPE", one_of=("VICTIM",)), Keep("COUNTRY_CITIZEN", one_of=("WORLD",)),
        Dimension("CITIZENSHIP", IT_CITIZENSHIP), CalendarYear("TIME_PERIOD"), Count("OBS_VALUE", "zero"),
        Category("TYPE_CRIME", categories), Keep("REF_AREA", one_of=("IT",)), Nation("IT"), Sum("TYPE_CRIME"),
        Latest(), Population("Eurostat NUTS 2021")))


def es(region_map: DataFrame, aliases=(), url: str = "", categories=ES_CATEGORIES) -> Source:
    """(province, category_native, year, count): rows of a section scan; province names in two passes."""
    return Source("ES", "Ministerio del Interior", url, (
        Count("count", "drop"), CalendarYear("year"), Category("category_native", categories),
        Region("province", region_map, key="fold", native_column="native_name", aliases=tuple(aliases)),
        Sum("category_native"), Recent(10), Population("Eurostat NUTS 2021")))


def se(url: str = "", categories=SE_CATEGORIES) -> Source:
    """(brottstyp, year, count): unpivoted year columns; the newest column counts, with or without numbers."""
    return Source("SE", "BRÅ", url, (
        CalendarYear("year"), Latest(), Keep("brottstyp", one_of=labels(categories)), Count("count", "drop"),
        Category("brottstyp", categories), Nation("SE"), EachRow("brottstyp"), Population("Eurostat NUTS 2021")))


def dk(region_map: DataFrame, url: str = "", categories=DK_CATEGORIES) -> Source:
    """(OMRÅDE, OVERTRÆD, TID, INDHOLD): quarters summed to complete years."""
    return Source("DK", "Danmarks Statistik", url, (
        Quarter("TID"), Count("INDHOLD", "zero"), Category("OVERTRÆD", categories), Region("OMRÅDE", region_map),
        Sum("OVERTRÆD"), CompleteYears(10), Population("Eurostat NUTS 2021")))


def nl(region_map: DataFrame, url: str = "", categories=NL_CATEGORIES) -> Source:
    """(RegioS, SoortMisdrijf, Perioden, TotaalGeregistreerdeMisdrijven_1)."""
    return Source("NL", "CBS", url, (
        CodeYear("Perioden"), Count("TotaalGeregistreerdeMisdrijven_1", "zero"), Category("SoortMisdrijf", categories),
        Region("RegioS", region_map, key="trim"), Sum("SoortMisdrijf"), Recent(10),
        Population("Eurostat / hand-curated")))


def ie(url: str = "", categories=IE_CATEGORIES) -> Source:
    """(offence, year, count): an unfolded cube; empty cells are no rows."""
    return Source("IE", "CSO", url, (
        CalendarYear("year"), Count("count", "zero"), Category("offence", categories), Nation("IE"), Sum("offence"),
        Recent(10), Population("Eurostat / hand-curated")))


def eurostat(country: str, supplement: bool = False, url: str = "", categories=EUROSTAT_CATEGORIES) -> Source:
    """(geo, iccs, unit, TIME_PERIOD, OBS_VALUE): national rows, published one per key; a country that is
    absent gives no rows."""
    return Source(country, "Eurostat (CRIM_OFF_CAT, NUTS-0 supplement)" if supplement else "Eurostat (CRIM_OFF_CAT)",
                  url, (
        Keep("geo", one_of=(country,)), Keep("unit", one_of=("NR",)), Keep("iccs", one_of=labels(categories)),
        CalendarYear("TIME_PERIOD"), Count("OBS_VALUE", "zero"), Category("iccs", categories), Nation(country),
        EachRow("iccs", "Eurostat %s (NUTS-0)" if supplement else "Eurostat %s"), Recent(10),
        Population("Eurostat / hand-curated")))
