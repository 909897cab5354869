"""A source as a list of steps - data, composed into one plan.

A ``Source`` says who publishes and what happens to the rows, in order:
filters, count and period kinds, category, region and dimension rules, unit
preference, grouping, retention, population.  ``apply_steps`` turns the list
into one lazy plan over the landed rows; ``harmonise_source`` adds the rate and
projects onto the canonical columns.

With a ``Tally`` every step that loses or changes rows counts them while they
pass (Spark observations): no job runs for the counts alone.  A row is counted
by the first step that drops it, so

    rows_in = dropped by each step + rows kept.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from harmoniq.functions.codes import (country_of, label_by_rules, level_of, release_from_name, rolling_12m, year_end,
                                      year_start)
from harmoniq.functions.text import drop_note_tag, fold_key, lenient_long
from harmoniq.operators.harmonise import (attach_population, canonicalise, denominator_fallback, literal_map,
                                          lookup_side, is_literal, native_examples, with_rate)
from harmoniq.session import materialize


# ---- the steps ----------------------------------------------------------------------
@dataclass(frozen=True)
class Keep:
    """Rows whose text passes every test that is given."""
    column: str
    one_of: tuple = ()
    prefixes: tuple = ()
    pattern: str | None = None


@dataclass(frozen=True)
class Where:
    """Rows for which a condition holds."""
    condition: Column


@dataclass(frozen=True)
class Count:
    """The measure; a value that is not a number is 0 (``zero``) or drops its row (``drop``)."""
    column: str
    missing: str

    def __post_init__(self):
        if self.missing not in ("zero", "drop"):
            raise ValueError("a count that is not a number is either zero or dropped")


@dataclass(frozen=True)
class Category:
    """Native label -> category; unmapped rows go."""
    column: str
    pairs: tuple


@dataclass(frozen=True)
class Region:
    """Native name or code -> region code; unmapped rows go.  ``table`` holds
    (native, code) pairs or is a table of them (``native_column`` names the key
    of a mapping file); ``key``: exact, trim, lower or fold (no accents, lower);
    names that are not found are looked up in ``aliases`` (alias, name)."""
    column: str
    table: object
    key: str = "exact"
    native_column: str = "native_code"
    aliases: tuple = ()


@dataclass(frozen=True)
class Nation:
    """Every row counts for one region."""
    code: str


@dataclass(frozen=True)
class CalendarYear:
    column: str


@dataclass(frozen=True)
class CodeYear:
    """A period code that begins with its year, like 2024JJ00."""
    column: str


@dataclass(frozen=True)
class Quarter:
    """A code like 2007K1; quarters are summed to years."""
    column: str


@dataclass(frozen=True)
class RollingYear:
    """The twelve months that end with the release named in a file name."""
    file: str


@dataclass(frozen=True)
class FileYear:
    """The year before (``lag``) the one in which the file was modified."""
    modified: str
    lag: int = 1


@dataclass(frozen=True)
class Dimension:
    """Native label -> suspect dimension; unmapped rows go."""
    column: str
    pairs: tuple


@dataclass(frozen=True)
class NamedDimension:
    """Suspect dimension from the file name: the first rule that is contained wins."""
    file: str
    rules: tuple
    default: str = "total"


@dataclass(frozen=True)
class PreferUnit:
    """Per indicator the rows of the preferred unit, if there are any, else those of the fallback."""
    indicator: str
    unit: str
    preferred: str
    fallback: str


@dataclass(frozen=True)
class Sum:
    """One row per region, category, dimension, period and ``by``; ``native``
    is the label whose examples are listed."""
    native: str
    by: tuple = ()


@dataclass(frozen=True)
class EachRow:
    """No grouping: the source publishes one row per key already."""
    native: str
    label: str = "%s"


@dataclass(frozen=True)
class Recent:
    """The newest ``years`` calendar years (or periods)."""
    years: int


@dataclass(frozen=True)
class Latest:
    """The newest period only."""


@dataclass(frozen=True)
class CompleteYears:
    """Years up to the newest with four quarters in some group, ``years`` back from it."""
    years: int


@dataclass(frozen=True)
class Population:
    """Denominator from the region dimension, else the largest of the source's own column."""
    label: str
    own: str | None = None
    own_label: str | None = None


@dataclass(frozen=True)
class Source:
    country: str | None                  # None: from the region code
    authority: str
    url: str
    steps: tuple
    notes: str | None = None


# ---- counting while rows pass ---------------------------------------------------------
class Tally:
    """Named sums over the rows that pass certain points of a plan; they are
    there once an action over the plan has ended."""

    def __init__(self):
        self._seen: list[Observation] = []

    def observe(self, df: DataFrame, **sums: Column) -> DataFrame:
        o = Observation()
        self._seen.append(o)
        return df.observe(o, *[c.alias(n) for n, c in sums.items()])

    def add(self, other: Tally) -> None:
        self._seen += other._seen

    def get(self) -> dict:
        out: dict = {}
        for o in self._seen:
            for k, v in observed(o).items():
                out[k] = v if k not in out else out[k] + v if v is not None else out[k]
        return out


def observed(o: Observation) -> dict:
    """What an observation saw; nothing if Spark left its plan out because no
    row can pass there (pyspark cannot convert that empty row)."""
    try:
        return o.get
    except Exception as e:  # noqa: BLE001
        if "assertion failed" not in str(e):
            raise
        return {}


@contextmanager
def whole_plans(spark: SparkSession):
    """Keep Spark from leaving parts of a plan out once it finds one side of a
    join empty: the rows that pass those parts are to be counted."""
    rules = {"spark.sql.optimizer.excludedRules": "org.apache.spark.sql.catalyst.optimizer.PropagateEmptyRelation",
             "spark.sql.adaptive.optimizer.excludedRules": "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"}
    was = {k: spark.conf.get(k, None) for k in rules}
    for k, rule in rules.items():
        spark.conf.set(k, f"{was[k]},{rule}" if was[k] else rule)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _number(condition: Column) -> Column:
    return F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("bigint")), F.lit(0))


@dataclass
class _State:
    spark: SparkSession
    regions: DataFrame
    tally: Tally | None
    carried: set = field(default_factory=set)      # columns that later steps still read
    summed: bool = False
    stored: Tally | None = None                     # newest periods, seen when the sums were stored

    def drop(self, df: DataFrame, name: str, kept: Column) -> DataFrame:
        kept = F.coalesce(kept, F.lit(False))
        if self.tally is not None:
            rows = F.col("__rows") if self.summed else F.lit(1)
            df = self.tally.observe(df, **{name: F.coalesce(F.sum(F.when(~kept, rows)), F.lit(0))})
        return df.filter(kept)


def _map(df: DataFrame, key: Column, table: DataFrame, out: str) -> DataFrame:
    """Left join to (native, value), both named anew; NULL where nothing matches."""
    m = table.select(F.col(table.columns[0]).alias("__k"), F.col(table.columns[1]).alias(out))
    return df.join(lookup_side(m, is_literal(table)), key == F.col("__k"), "left").drop("__k")


KEYS = {"exact": lambda c: c, "trim": F.trim, "lower": lambda c: F.lower(F.trim(drop_note_tag(c))), "fold": fold_key}


def _keep(s: Keep, df: DataFrame, st: _State) -> DataFrame:
    c = F.trim(F.col(s.column).cast("string"))
    kept = F.lit(True)
    if s.one_of:
        kept = kept & c.isin(*s.one_of)
    if s.prefixes:
        starts = F.lit(False)
        for p in s.prefixes:
            starts = starts | c.startswith(p)
        kept = kept & starts
    if s.pattern:
        kept = kept & c.rlike(s.pattern)
    return st.drop(df, "filtered", kept)


def _count(s: Count, df: DataFrame, st: _State) -> DataFrame:
    value = lenient_long(F.col(s.column).cast("string"), "null")
    df = df.withColumn("__count", value)
    if s.missing == "drop":
        return st.drop(df, "no_count", F.col("__count").isNotNull())
    if st.tally is not None:
        df = st.tally.observe(df, coerced=_number(F.col("__count").isNull()))
    return df.withColumn("__count", F.coalesce("__count", F.lit(0).cast("bigint")))


def _category(s: Category, df: DataFrame, st: _State) -> DataFrame:
    table = literal_map(st.spark, s.pairs, "native", "value")
    df = _map(df, F.trim(F.col(s.column)), table, "crime_category")
    return st.drop(df, "unmapped_category", F.col("crime_category").isNotNull())


def _region(s: Region, df: DataFrame, st: _State) -> DataFrame:
    clean = KEYS[s.key]
    if isinstance(s.table, DataFrame):
        value = "nuts_code" if "nuts_code" in s.table.columns else s.table.columns[1]
        key = s.native_column if s.native_column in s.table.columns else s.table.columns[0]
        pairs = s.table.select(clean(F.col(key)).alias("native"), F.col(value).alias("value"))
    else:
        pairs = literal_map(st.spark, s.table, "native", "value")
        made = pairs.select(clean(F.col("native")).alias("native"), "value")
        made._harmoniq_literal = True
        pairs = made
    key = clean(F.col(s.column))
    df = _map(df, key, pairs, "__direct")
    if s.aliases:
        known = literal_map(st.spark, s.aliases, "native", "value").select(
            clean(F.col("native")).alias("native"), clean(F.col("value")).alias("name"))
        known = known.join(pairs.withColumnRenamed("native", "name"), "name").select("native", "value")
        df = _map(df, key, known, "__alias")
        df = df.withColumn("__direct", F.coalesce("__direct", "__alias")).drop("__alias")
    df = df.withColumnRenamed("__direct", "region_code")
    return st.drop(df, "unmapped_region", F.col("region_code").isNotNull())


def _year(df: DataFrame, st: _State, year: Column) -> DataFrame:
    df = df.withColumn("__period", year)
    df = st.drop(df, "no_period", F.col("__period").isNotNull())
    return df.withColumn("period_start", year_start("__period")).withColumn("period_end", year_end("__period"))


def _quarter(s: Quarter, df: DataFrame, st: _State) -> DataFrame:
    c = F.trim(F.col(s.column))
    right = c.rlike("^[0-9]{4}[A-Za-z][1-4]$")
    df = df.withColumn("__quarter", F.when(right, F.substring(c, 6, 1).cast("int")))
    return _year(df, st, F.when(right, F.substring(c, 1, 4).cast("int")))


def _rolling(s: RollingYear, df: DataFrame, st: _State) -> DataFrame:
    month, year = release_from_name(F.col(s.file))
    start, end = rolling_12m(month, year)
    df = df.withColumn("period_start", start).withColumn("period_end", end)
    df = st.drop(df, "no_period", F.col("period_end").isNotNull())
    return df.withColumn("__period", (F.year("period_end") * 12 + F.month("period_end")).cast("int"))


def _file_year(s: FileYear, df: DataFrame, st: _State) -> DataFrame:
    return _year(df, st, (F.year(s.modified) - s.lag).cast("int"))


def _dimension(s: Dimension, df: DataFrame, st: _State) -> DataFrame:
    df = _map(df, F.trim(F.col(s.column)), literal_map(st.spark, s.pairs, "native", "value"), "suspect_dim")
    return st.drop(df, "unmapped_dimension", F.col("suspect_dim").isNotNull())


def _prefer(s: PreferUnit, df: DataFrame, st: _State) -> DataFrame:
    has = df.groupBy(F.col(s.indicator).alias("__i")).agg(
        F.max((F.col(s.unit) == s.preferred).cast("int")).alias("__has"))
    joined = df.join(has, F.col(s.indicator).eqNullSafe(F.col("__i")), "left").drop("__i")
    unit = F.when(F.col("__has") == 1, F.lit(s.preferred)).otherwise(F.lit(s.fallback))
    return st.drop(joined, "other_unit", F.col(s.unit) == unit).drop("__has")


def _sum(s: Sum, df: DataFrame, st: _State) -> DataFrame:
    aggs = [F.sum("__count").alias("count"), native_examples(s.native).alias("crime_category_native"),
            F.count(F.lit(1)).alias("__rows")]
    if "__quarter" in df.columns:                   # a bit per quarter: counted without a distinct
        aggs.append(F.expr("bit_count(bit_or(shiftleft(1, __quarter)))").alias("__quarters"))
    aggs += [F.max(F.col(c).try_cast("double").try_cast("bigint")).alias(c) for c in sorted(st.carried)]
    by = ["region_code", "crime_category", "suspect_dim", "period_start", "period_end", "__period"]
    df = df.groupBy(*by, *[c for c in s.by if c not in by]).agg(*aggs)
    st.summed = True
    return _stored(df, st)


def _each(s: EachRow, df: DataFrame, st: _State) -> DataFrame:
    own = [F.col(c).try_cast("double").try_cast("bigint").alias(c) for c in sorted(st.carried)]
    df = df.select("region_code", "crime_category", "suspect_dim", "period_start", "period_end", "__period",
                   F.col("__count").alias("count"), F.format_string(s.label, F.col(s.native)).alias("crime_category_native"),
                   F.lit(1).cast("bigint").alias("__rows"), *own)
    st.summed = True
    return _stored(df, st)


def _stored(df: DataFrame, st: _State) -> DataFrame:
    """The grouped rows are stored once (a reliable checkpoint); the newest
    periods are observed on the way, so retention needs no job of its own."""
    st.stored = Tally()
    four = F.col("__quarters") == 4 if "__quarters" in df.columns else F.lit(False)
    return materialize(st.stored.observe(df, newest=F.max("__period"), complete=F.max(F.when(four, F.col("__period")))))


def _newest(df: DataFrame, st: _State) -> Column:
    if st.summed:
        return F.lit(st.stored.get().get("newest")).cast("int")
    return df.select(F.max("__period")).scalar()     # before the grouping: over the rows themselves


def _recent(s: Recent, df: DataFrame, st: _State) -> DataFrame:
    return st.drop(df, "old_periods", F.col("__period") > _newest(df, st) - s.years)


def _complete(s: CompleteYears, df: DataFrame, st: _State) -> DataFrame:
    if not st.summed:
        raise ValueError("complete years are known after the quarters are summed")
    last = F.lit(st.stored.get().get("complete")).cast("int")
    return st.drop(df, "old_periods", (F.col("__period") <= last) & (F.col("__period") > last - s.years))


def _population(s: Population, df: DataFrame, st: _State) -> DataFrame:
    df = attach_population(df, st.regions, out="__dim")
    own = F.col(s.own) if s.own else F.lit(None).cast("bigint")
    value, label = denominator_fallback(F.col("__dim"), own, s.label, s.own_label or s.label)
    return df.withColumn("denominator_population", value).withColumn("denominator_source", label)


INTERPRETERS = {
    Keep: _keep, Where: lambda s, df, st: st.drop(df, "filtered", s.condition), Count: _count, Category: _category,
    Region: _region, Nation: lambda s, df, st: df.withColumn("region_code", F.lit(s.code)),
    CalendarYear: lambda s, df, st: _year(df, st, F.col(s.column).cast("string").try_cast("int")),
    CodeYear: lambda s, df, st: _year(df, st, F.substring(F.trim(F.col(s.column)), 1, 4).try_cast("int")),
    Quarter: _quarter, RollingYear: _rolling, FileYear: _file_year, Dimension: _dimension,
    NamedDimension: lambda s, df, st: df.withColumn("suspect_dim", label_by_rules(s.file, list(s.rules), s.default)),
    PreferUnit: _prefer, Sum: _sum, EachRow: _each, Recent: _recent,
    Latest: lambda s, df, st: st.drop(df, "old_periods", F.col("__period") == _newest(df, st)),
    CompleteYears: _complete, Population: _population}
PERIODS = (CalendarYear, CodeYear, Quarter, RollingYear, FileYear)


def check_steps(source: Source) -> None:
    """A list must count, place, date and group its rows, each once, and say
    what becomes of old periods (``Recent``, ``Latest``, ``CompleteYears``, or
    a period kind that has only one)."""
    kinds = [type(s) for s in source.steps]
    unknown = [k.__name__ for k in kinds if k not in INTERPRETERS]
    if unknown:
        raise ValueError(f"no such step: {unknown}")

    def one(names, *of):
        if sum(k in of for k in kinds) != 1:
            raise ValueError(f"{source.authority}: exactly one of {names}")
    one("Count", Count)
    one("Category", Category)
    one("Region, Nation", Region, Nation)
    one("a period kind", *PERIODS)
    one("Sum, EachRow", Sum, EachRow)
    one("Population", Population)


def apply_steps(spark: SparkSession, df: DataFrame, source: Source, regions: DataFrame,
                tally: Tally | None = None) -> DataFrame:
    """The landed rows through the source's steps."""
    check_steps(source)
    st = _State(spark, regions, tally, {s.own for s in source.steps if isinstance(s, Population) and s.own})
    if tally is not None:
        df = tally.observe(df, rows_in=F.count(F.lit(1)))
    if "suspect_dim" in df.columns:
        df = df.drop("suspect_dim")
    if not any(isinstance(s, (Dimension, NamedDimension)) for s in source.steps):
        df = df.withColumn("suspect_dim", F.lit("total"))
    for step in source.steps:
        df = INTERPRETERS[type(step)](step, df, st)
    return df


def harmonise_source(spark: SparkSession, df: DataFrame, source: Source, regions: DataFrame, as_of=None,
                     file_hash: str = "", tally: Tally | None = None) -> DataFrame:
    """Canonical rows of a source."""
    rows = with_rate(apply_steps(spark, df, source, regions, tally))
    retrieved = (F.current_timestamp().cast("timestamp_ntz") if as_of is None else
                 as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp_ntz"))
    if tally is not None:
        rows = tally.observe(rows, rows_kept=F.coalesce(F.sum("__rows"), F.lit(0)))
    return canonicalise(
        rows, source_country=F.lit(source.country) if source.country else country_of("region_code"),
        source_authority=source.authority, source_url=source.url, source_file_hash=file_hash, retrieved_at=retrieved,
        period_type="year", region_level=level_of("region_code"), notes=F.lit(source.notes))
