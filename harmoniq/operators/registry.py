"""Sources run into the canonical table, with their accounts.

A source is one pass over its landed rows (into the stored sums) and one write.
Everything its record says is counted while the rows pass: rows read, dropped
by each step, counts turned to zero, broken rules, repeated keys, periods and
regions.  The write lands in a commit folder of its own; broken rules or
repeated keys refuse the source before the commit's pointer is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmoniq.operators.quality import InvalidRows, aggregate_rules, conform, incident_rules
from harmoniq.operators.snapshots import upsert_snapshot
from harmoniq.operators.steps import Source, Tally, harmonise_source, whole_plans
from harmoniq.schema import AGGREGATE_KEY, CRIME_AGGREGATES

DROPS = ("filtered", "no_count", "no_period", "unmapped_category", "unmapped_region", "unmapped_dimension",
         "other_unit", "old_periods")
RECORD = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("status", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("rows_in", *DROPS, "rows_kept", "coerced", "n_rows")]
    + [T.StructField("min_period", T.DateType()), T.StructField("max_period", T.DateType()),
       T.StructField("n_regions", T.LongType()), T.StructField("error", T.StringType())])
RULE = "rule_"


def one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per natural key (NULL == '') with the number of rows that had
    it in ``__same``; repeated keys are counted, never silently merged."""
    others = [c for c in rows.columns if c not in keys]
    text = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)}
    by = [F.nullif(F.col(k), F.lit("")).alias(k) if k in text else F.col(k) for k in keys]
    one = rows.groupBy(*by).agg(F.max(F.struct(*others)).alias("__one"), F.count(F.lit(1)).alias("__same"))
    return one.select(*keys, "__one.*", "__same").select(*rows.columns, "__same")


def run_registry(spark: SparkSession, sources: list[tuple[str, DataFrame, Source]], regions: DataFrame, root: str,
                 as_of=None) -> DataFrame:
    """Run sources in order; last writer wins, a failing source is recorded
    and the others still run.  Returns one record per source (``RECORD``)."""
    records = []
    for name, df, source in sources:
        tally = Tally()
        try:
            with whole_plans(spark):
                rows = conform(harmonise_source(spark, df, source, regions, as_of=as_of, tally=tally), CRIME_AGGREGATES)
                _write(spark, root, one_per_key(rows, list(AGGREGATE_KEY)), tally)
            found = tally.get()
            records.append((name, "ok", *[found.get(n) or 0 for n in ("rows_in", *DROPS, "rows_kept", "coerced", "n_rows")],
                            found.get("min_period"), found.get("max_period"), found.get("n_regions") or 0, None))
        except Exception as e:  # noqa: BLE001  isolate one source's failure
            records.append((name, "failed", *[None] * (len(DROPS) + 4), None, None, None, str(e)))
    return spark.createDataFrame(records, RECORD)


def _refuse(found: dict, rules: list) -> None:
    broken = [f"{n}: {found[RULE + n]} rows" for n, _ in sorted(rules, key=lambda r: r[0]) if found.get(RULE + n)]
    if found.get("repeated"):
        broken.append(f"repeated keys: {found['repeated']}")
    if broken:
        raise InvalidRows("; ".join(broken))


def _rule_sums(rules: list) -> dict:
    return {RULE + n: F.sum(F.coalesce(c, F.lit(False)).cast("bigint")) for n, c in rules}


def write_incidents(spark: SparkSession, root: str, incidents: DataFrame) -> int:
    """J7 + Q5: finished incidents into the incidents table, last writer wins on
    the id.  The rules are counted while the rows are written; a batch that
    breaks one is refused whole, before the pointer.  Of rows that share an id
    in the batch the one with more source text, then the later extraction,
    stays.  The country is part of the id, so it can partition the table."""
    rules = incident_rules()
    seen = Tally()
    ranked = incidents.withColumn("__text", F.length(F.coalesce(F.col("sources_json"), F.lit(""))))
    return upsert_snapshot(
        spark, root, ranked, ["incident_id"], ["country"], incidents.schema, order=["__text", "extracted_at", "sources_json"],
        observe=lambda df: seen.observe(df, **_rule_sums(rules)).drop("__text"), carried=("__text",),
        check=lambda: _refuse(seen.get(), rules))


def _write(spark: SparkSession, root: str, rows: DataFrame, tally: Tally) -> None:
    rules = aggregate_rules()
    seen = Tally()

    def observe(df: DataFrame) -> DataFrame:
        facts = {"n_rows": F.count(F.lit(1)), "min_period": F.min("period_start"), "max_period": F.max("period_end"),
                 "n_regions": F.size(F.collect_set("region_code")).cast("bigint"),
                 "repeated": F.sum(F.col("__same") - 1)}
        return seen.observe(df, **_rule_sums(rules), **facts).drop("__same")

    upsert_snapshot(spark, root, rows, list(AGGREGATE_KEY), ["source_country"], CRIME_AGGREGATES, observe=observe,
                    check=lambda: _refuse(seen.get(), rules), carried=("__same",))
    tally.add(seen)
