"""Keyword lists for the pre-extraction article filter, per language."""

# fixed values: positive / negative keyword lists, per language code
KEYWORDS = {
    "da": (
        ["knivstik", "knivstukket", "knivoverfald", "skudt", "skyderi", "skuddrab",
         "drab", "drabsforsøg", "mord", "dræbt"],
        ["film", "roman", "tv-serie", "historisk"],
    ),
    "de": (
        ["Messerangriff", "Messerstecher", "Messerattacke", "erstochen", "Schießerei",
         "erschossen", "tödlich verletzt", "getötet", "Tötung", "Mord", "Totschlag",
         "Schwerverletzte", "Schwerverletzter", "Messerstich"],
        ["Film", "Roman", "Krimi", "historisch"],
    ),
    "en": (
        ["stabbing", "stabbed", "knifed", "knife attack", "shooting", "shot dead", "gunman",
         "fatally wounded", "beaten to death", "rammed", "attack", "homicide", "murder",
         "manslaughter"],
        ["film", "movie", "novel", "tv series", "in fiction", "historical", "centuries ago",
         "in the 19th century"],
    ),
    "es": (
        ["apuñalado", "apuñalada", "apuñalamiento", "cuchillada", "navajazo", "arma blanca",
         "tiroteo", "disparo", "asesinato", "homicidio", "apaleado", "apaleada"],
        ["película", "novela", "serie", "histórico"],
    ),
    "fr": (
        ["coup de couteau", "poignardé", "poignardée", "attaque au couteau", "tué par balle",
         "fusillade", "tirs", "homicide", "meurtre", "mort dans une rixe", "violemment agressé"],
        ["film", "roman", "polar", "historique"],
    ),
    "it": (
        ["accoltellato", "accoltellata", "accoltellamento", "coltellata", "sparatoria",
         "colpi di pistola", "omicidio", "ucciso", "uccisa", "aggressione", "pestato a morte"],
        ["film", "romanzo", "serie tv", "storico"],
    ),
    "sv": (
        ["knivskuren", "knivhuggen", "knivattack", "skjuten", "skottlossning", "mord", "dråp",
         "misshandel med dödlig utgång", "dödad", "allvarligt skadad"],
        ["film", "roman", "tv-serie", "historisk"],
    ),
}
