"""The query catalogue: each query reads the driver's tables whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import fixed_point, percent_label, round_binary, thousands
from ..functions.timestamps import parse_timestamp, parse_timestamp_mixed, time_parts
from ..operators import checks, flags, heavy, known, quality, quantiles, rows, runs, sketches, summaries
from ..plans import charts, jobs, reports
from ..plans.rollup import incident_rollup, report_base, rollup_slice, slice_counts
from ..sinks.writers import (
    let_go,
    metric_rows,
    read_slices,
    rewrite_partitions,
    shared_folder,
    staged,
    write_csv,
    write_json,
    write_partitioned,
)
from ..sources.files import stored_figures
from ..sources.quarantine import read_quarantined
from ..sources.readers import read_incidents_csv, read_parquet, read_summary_csv
from ..sources.schema import FLAG_COLUMNS
from .standin import cleaned_incidents, raw_incidents, table, typed_incidents

Query = Callable[[SparkSession, str], DataFrame]

DIMENSIONS = ("State", "Year", "Severity")
CITY_MINIMUM = 20
# Which run a record stands for in the run tables.
RUN_OF_SOURCE = {"SourceA": 1, "SourceN": 2, "SourceR": 3}
# What stands for the seconds of a run.
RUN_SECONDS = {"scan": "Humidity(%)", "write": "Visibility(mi)"}
# Metrics of the benchmark summary whose values name the environment.
ENVIRONMENT = (
    "spark_version", "spark_master", "default_parallelism", "shuffle_partitions", "input_uri"
)
COUNTED = ["State", "Severity", "Start_Time"]
# Raw files: a header, and compressed (fast), since the text of a record is several times its content.
RAW_FILES = {"header": True, "compression": "snappy"}
# Those of the prepare job, which come on top of all that it stores.
SMALL_FILES = {"header": True, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _cleaned(query: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over the stored cleaned records; ``over`` is the part that needs them stored already."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(cleaned_incidents(spark, sf_dir))

    run.over = query
    return run


def _report(name: str, query: Callable[[DataFrame], DataFrame]) -> Query:
    """A report over one slice's counts."""
    return _cleaned(lambda cleaned: query(slice_counts(cleaned, name)))


def _rolled(name: str, query: Callable[[DataFrame], DataFrame]) -> Query:
    """The same report over the rollup of all slices."""
    return _cleaned(lambda cleaned: query(rollup_slice(incident_rollup(report_base(cleaned)), name)))


def _severity(cleaned: DataFrame) -> DataFrame:
    return reports.severity_distribution(slice_counts(cleaned, "place"))


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the stored typed rows, as the prepare job does: the distinct count reads one column."""
    return quality.profile(_stored(typed_incidents(spark, sf_dir)))


def _quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(_profile(spark, sf_dir), input_uri="incidents")


def _missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_values(_profile(spark, sf_dir))


def _duplicate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return quality.distinct_metrics(lineitem, ["l_orderkey", "l_linenumber"])


def _dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return rows.dedup_by_key(lineitem, ["l_orderkey", "l_linenumber"])


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.clean(typed_incidents(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_incidents(spark, sf_dir)


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text, by event type: nine fraction digits, whole seconds, junk, or a line end behind."""
    number = F.col("event_id") % 4
    line_end = F.when(number == 0, "\n").when(number == 1, "\r").when(number == 2, "\u0085").otherwise("\u2028")
    stored = F.col("ts").cast("string")
    whole, micros = F.substring(stored, 1, 19), F.rpad(F.substring(stored, 21, 6), 6, "0")
    text = (
        F.when(F.col("event_type") == "error", "n/a")
        .when(F.col("event_type") == "signup", F.concat(whole, line_end))
        .when(F.col("event_type").isin("view", "click"), F.concat(whole, F.lit("."), micros, F.lit("789")))
        .otherwise(whole)
    )
    return table(spark, sf_dir, "events").select("event_id", "event_type", text.alias("text"))


def _parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_timestamp("text")
    return _event_texts(spark, sf_dir).select("event_id", "text", parsed.alias("moment"))


# Text forms by order key: a date pattern, and what follows the date.
MIXED_FORMS = (
    ("yyyy-MM-dd", ""),
    ("yyyy-MM-dd", "T08:30:00"),
    ("MM/dd/yyyy", ""),
    ("MM/dd/yyyy", " 17:45"),
    ("M/d/yyyy", ""),
    ("M/d/yyyy", " 5:46"),
    ("MM/dd/yyyy", " 05:46 PM"),
    ("MMM d, yyyy", ""),
    ("yyyy-MM-dd", "T05:46:00Z"),
    ("yyyy-MM-dd", " 5:46"),
    ("yyyy-M-d", ""),
    ("'on' yyyy-MM-dd", ""),
    ("yyyy-MM-dd", "T05:46:00+05:00"),
    ("d.M.yyyy", " 5:46 -0330"),
)


def _parse_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in the forms above."""
    form = F.col("o_orderkey") % len(MIXED_FORMS)
    texts = [
        F.when(form == i, F.concat(F.date_format("o_orderdate", pattern), F.lit(tail)))
        for i, (pattern, tail) in enumerate(MIXED_FORMS)
    ]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(*texts).alias("text"))
    return orders.withColumn("moment", parse_timestamp_mixed("text"))


def _event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by weekday and hour of their own clock."""
    events = table(spark, sf_dir, "events").withColumns(time_parts("ts"))
    return summaries.summarize(
        events,
        ["Weekday_Number", "Weekday", "Hour"],
        mean={"Average_Value": "value"},
        order=["Weekday_Number", "Hour"],
    )


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals per status: rounded figures and their label texts."""
    total = summaries.summarize(
        table(spark, sf_dir, "orders"),
        ["o_orderstatus", "o_orderpriority"],
        mean={"Average_Price": "o_totalprice"},
        share="Share",
        count="Order_Count",
    )
    return total.withColumns(
        {
            "Count_Label": thousands("Order_Count"),
            "Share_Label": percent_label("Share", 1),
            "Price_Label": fixed_point("Average_Price", 2),
            "Share_Rounded": round_binary("Share", 2),
        }
    )


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw records written as CSV and read back by the declared schema."""
    return read_incidents_csv(spark, _raw_csv(spark, sf_dir)[1])


def _csv_grouping_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark query from raw CSV: three columns, rules, one grouping."""
    return jobs.benchmark_counts(spark, _raw_csv(spark, sf_dir)[1])


def _partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/cleaned"
    write_partitioned(rows.clean(typed_incidents(spark, sf_dir)), path)
    return read_parquet(spark, path).withColumn("Year", F.col("Year").cast("int"))


def _prepare_then_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV through the prepare job, then the state report on what it stored."""
    root, raw = _raw_csv(spark, sf_dir, SMALL_FILES)
    stored = jobs.prepare_job(spark, raw, f"{root}/out")
    return reports.state_summary(slice_counts(stored, "place"))


def _summary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The road-feature table written as one CSV file and read back typed."""
    path = f"{shared_folder(spark)}/road_feature_summary"
    counts = flags.flag_counts(cleaned_incidents(spark, sf_dir), FLAG_COLUMNS)
    write_csv(
        reports.road_feature_summary(counts), path, order=["Feature", F.desc("Feature_Present")]
    )
    return read_summary_csv(spark, path, layout="road_feature_summary")


def _metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input and valid row counts of the raw records as JSON, read back."""
    path = f"{shared_folder(spark)}/metrics"
    typed = typed_incidents(spark, sf_dir, [*rows.CLEAN_NOT_NULL, *rows.CLEAN_BETWEEN])
    counted = checks.input_counts(
        typed, rows.row_rule(rows.CLEAN_NOT_NULL, rows.CLEAN_BETWEEN)
    )
    write_json(counted, path)
    return spark.read.schema("input_rows BIGINT, valid_rows BIGINT").json(path)


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile against the stored cleaned dataset."""
    typed = _stored(typed_incidents(spark, sf_dir))
    stored_at = f"{shared_folder(spark)}/cleaned"
    write_partitioned(rows.clean(typed), stored_at)
    kept = stored_figures(spark, stored_at)["row_count"]
    return quality.validation(quality.profile(typed), kept, processed_uri="cleaned")


def _reconciliation(cleaned: DataFrame) -> DataFrame:
    return reports.reconciliation(
        cleaned.agg(F.count("*")),
        state=reports.state_summary(slice_counts(cleaned, "place")),
        year=reports.year_summary(slice_counts(cleaned, "time")),
        severity=_severity(cleaned),
        info={"input_uri": "cleaned", "output_uri": "reports"},
    )


def _dimension_check(cleaned: DataFrame) -> DataFrame:
    """Against the rows of the dataset, counted apart; records without weather make that dimension FAIL."""
    dimensions = [*DIMENSIONS, "Weather_Condition"]
    counted = _stored(summaries.combination_counts(cleaned, dimensions))
    counts = summaries.dimension_counts(counted, dimensions).where("Value IS NOT NULL")
    return checks.dimension_check(counts, _stored(cleaned.agg(F.count("*").alias("rows"))), dimensions)


def _incremental_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of all raw files after two increments, the second of which reads the second half alone."""
    root = shared_folder(spark)
    raw = raw_incidents(spark, sf_dir)
    early = F.coalesce(F.col("Zipcode") < "000000800", F.lit(False))
    for half, mode in ((raw.where(early), "overwrite"), (raw.where(~early), "append")):
        half.write.mode(mode).options(**RAW_FILES).csv(f"{root}/raw_csv")
        counts = jobs.benchmark_increment(spark, f"{root}/raw_csv", f"{root}/store")
    return counts


def _dedup_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines stored once per key in two increments by shipping date; what came first stays."""
    lines = table(spark, sf_dir, "lineitem")
    first, second = lines.where("l_shipdate < '1997-01-01'"), lines.where("l_shipdate >= '1997-01-01' OR l_shipdate IS NULL")
    root = shared_folder(spark)
    planned = known.KeyStore.blocks_for(lines.count())
    store = known.KeyStore(spark, f"lines_{root[-32:]}", root, ["l_orderkey", "l_linenumber"], planned, buckets=8)
    store.create(first)
    store.add(second)
    return store.stored()


def _year_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dataset with one stale year and one that should not be there, after both were rewritten."""
    root = shared_folder(spark)
    cleaned = cleaned_incidents(spark, sf_dir, root)
    wide = read_slices(spark, f"{root}/cleaned")
    stale = wide.withColumn("Street", F.when(F.col("Year") == 1996, "stale").otherwise(F.col("Street")))
    extra = wide.where("Year = 1997").withColumn("Year", F.lit(2050))
    write_partitioned(stale.unionByName(extra), f"{root}/dataset")
    rewrite_partitions(cleaned, f"{root}/dataset", [1996, 2050], root)
    return read_parquet(spark, f"{root}/dataset").withColumn("Year", F.col("Year").cast("int"))


# Cells that do not fit their column, by a test on the record.
MALFORMED = {
    "Severity": ("Zipcode LIKE '%7'", "high"),
    "Distance(mi)": ("Street = 'Street 5'", "far"),
    "Stop": ("Airport_Code = 'K3'", "perhaps"),
}


def _csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records with malformed cells: all, good and quarantined ones, and records at fault per column."""
    root = shared_folder(spark)
    raw = raw_incidents(spark, sf_dir)
    cells = {c: F.when(F.expr(test), cell).otherwise(F.col(f"`{c}`").cast("string")) for c, (test, cell) in MALFORMED.items()}
    raw.withColumns(cells).write.options(**RAW_FILES).csv(f"{root}/raw_csv")
    read = read_quarantined(spark, f"{root}/raw_csv", root)
    count = lambda frame, check: frame.agg(F.lit(check).alias("Check"), F.lit(None).cast("string").alias("Column"), F.count("*").alias("Row_Count"))
    lines = spark.read.option("header", True).csv(f"{root}/raw_csv")
    columns = read.columns.select(F.lit("malformed").alias("Check"), F.col("column").alias("Column"), F.col("bad_records").alias("Row_Count"))
    parts = [count(lines, "raw"), count(read.good, "good"), count(read.bad, "quarantined"), columns]
    return reduce(DataFrame.unionByName, parts)


def _sketches_by_year(cleaned: DataFrame) -> DataFrame:
    """Different Zipcodes per year and over all years, and whether sketches stored per year tell them within their bound."""
    stored = _stored(sketches.distinct_sketches(cleaned, ["Year"], "Zipcode"))
    every = F.lit(None).cast("int").alias("Year")
    exact = F.count_distinct("Zipcode").alias("Exact_Count")
    parts = []
    for counted, told in (
        (cleaned.groupBy("Year").agg(exact), sketches.united(stored, ["Year"])),
        (cleaned.agg(exact).select(every, "Exact_Count"), sketches.united(stored).select(every, "row_count", "sketch")),
    ):
        estimate = sketches.estimated(told).select(F.col("Year").alias("_year"), "distinct_estimate")
        met = counted.join(estimate, F.col("Year").eqNullSafe(F.col("_year")))
        parts.append(met.select("Year", "Exact_Count", sketches.within("distinct_estimate", "Exact_Count", sketches.error_bound()).alias("Within_Bound")))
    return parts[0].unionByName(parts[1])


def _content_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows against what was stored of them, as it is and with one cell changed."""
    root = shared_folder(spark)
    cleaned = cleaned_incidents(spark, sf_dir, root)
    path = f"{root}/dataset"
    write_partitioned(read_slices(spark, f"{root}/cleaned"), path)
    stored = read_parquet(spark, path)
    last = cleaned.agg(F.max("ID")).scalar()
    changed = stored.withColumn("Street", F.when(F.col("ID") == last, F.lit(None)).otherwise(F.col("Street")))
    parts = [
        checks.compare_contents(cleaned, frame, cleaned.columns).select(F.lit(name).alias("Copy"), "Check", "Status")
        for name, frame in (("stored", stored), ("one cell changed", changed))
    ]
    return parts[0].unionByName(parts[1])


def _quantiles(cleaned: DataFrame) -> DataFrame:
    folder = shared_folder(cleaned.sparkSession)
    found = quantiles.exact_quantiles(cleaned, ["State"], "Pressure(in)", [0.25, 0.5, 0.9], folder, few=100)
    return found.select("State", "share", "row_count", F.round("quantile", 9).alias("quantile"))


def _largest_groups(cleaned: DataFrame) -> DataFrame:
    """The 50 largest values of a key that is a place by night and an ID by day."""
    key = F.when(F.col("Hour") < 8, F.col("City_State")).otherwise(F.col("ID"))
    return heavy.largest_groups(cleaned, key, 50, shared_folder(cleaned.sparkSession), name="Place", count="Accident_Count")


def _largest_cities(cleaned: DataFrame) -> DataFrame:
    return heavy.largest_groups(
        cleaned, "City_State", 100, shared_folder(cleaned.sparkSession), name="City_State", count="Accident_Count"
    )


def _stored_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of the stored cleaned dataset from its footers, as (metric, value)."""
    path = f"{shared_folder(spark)}/dataset"
    write_partitioned(rows.clean(typed_incidents(spark, sf_dir)), path)
    figures = stored_figures(spark, path, ranges=["Severity", "Month", "Hour"], counts=["Weather_Condition", "End_Lat"])
    return spark.createDataFrame([(name, value) for name, value in figures.asDict().items()], "metric string, value long")


def _five_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw records hold invalid rows, so every count but the input's must FAIL."""
    typed = typed_incidents(spark, sf_dir, COUNTED).withColumn("Year", F.year("Start_Time"))
    counted = _stored(summaries.combination_counts(typed, DIMENSIONS, where=jobs.benchmark_rule()))
    seen = counted.select(F.sum("Input_Count").alias("input_rows"), F.sum("Accident_Count").alias("valid_rows"))
    return checks.five_way_counts(seen, summaries.dimension_counts(counted, DIMENSIONS))


def _dimension_table(dimension: str, kind: str, by_count: bool = False) -> Query:
    return _cleaned(
        lambda cleaned: summaries.dimension_table(
            summaries.grouping_counts(cleaned, DIMENSIONS), dimension, kind=kind, by_count=by_count
        )
    )


def _by_run(frame: DataFrame) -> DataFrame:
    """Number each record's run by its source."""
    number = F.coalesce(*[F.when(F.col("Source") == s, F.lit(n)) for s, n in RUN_OF_SOURCE.items()])
    return frame.withColumn("run", number)


def _stored(frame: DataFrame) -> DataFrame:
    """A table that is read more than once."""
    return staged(frame, f"{shared_folder(frame.sparkSession)}/stored", "zstd")


def _run_combinations(records: DataFrame, valid: Column | None = None) -> DataFrame:
    """Rows per run and combination, with the sums a timer's log is made from: one pass."""
    chosen = F.count("*") if valid is None else F.count_if(valid)
    return _stored(
        records.groupBy("run", *DIMENSIONS).agg(
            F.count("*").alias(summaries.INPUT),
            chosen.alias(summaries.COUNT),
            *[F.sum(c).alias(f"sum_{n}") for n, c in RUN_SECONDS.items()],
            *[F.count(c).alias(f"n_{n}") for n, c in RUN_SECONDS.items()],
        )
    )


def _seconds(name: str) -> Column:
    return F.sum(f"sum_{name}") / F.sum(f"n_{name}")


def _run_log(counted: DataFrame) -> DataFrame:
    """What a timer would log per run, taken from the records of that run."""
    log = counted.groupBy("run").agg(
        F.round(_seconds("scan"), 4).alias("total_seconds"),
        F.sum(summaries.INPUT).alias("expected_rows"),
    )
    return log.withColumn("output_uri", F.concat(F.lit("run_"), "run"))


def _run_table(cleaned: DataFrame) -> DataFrame:
    counted = _run_combinations(_by_run(cleaned))
    counts = summaries.dimension_counts(counted, DIMENSIONS, extra_keys=["run"])
    return runs.run_table(counts, _run_log(counted))


def _run_summary(cleaned: DataFrame) -> DataFrame:
    """All metrics of the benchmark job's summary; of those that name the environment, the names."""
    summary = runs.run_summary(
        _run_table(cleaned),
        before={"framework": "PySpark", **{name: "" for name in ENVIRONMENT}},
        after={"timing_scope": "records", "cluster_provisioning_time_included": False},
    )
    return summary.withColumn("value", F.when(F.col("metric").isin(*ENVIRONMENT), "named").otherwise(F.col("value")))


def _run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run over the raw records; invalid rows make the runs FAIL."""
    typed = typed_incidents(spark, sf_dir, [*COUNTED, "Source", *RUN_SECONDS.values()])
    records = _by_run(typed.withColumn("Year", F.year("Start_Time")))
    counted = _run_combinations(records, jobs.benchmark_rule())
    log = counted.groupBy("run").agg(
        F.sum(summaries.INPUT).alias("input_rows"),
        F.sum(summaries.COUNT).alias("valid_rows"),
        _seconds("scan").alias("scan_and_aggregate_seconds"),
        _seconds("write").alias("write_seconds"),
        F.sum(summaries.INPUT).alias("expected_rows"),
    )
    return runs.run_metrics(summaries.dimension_counts(counted, DIMENSIONS, extra_keys=["run"]), log)


def _runtimes(cleaned: DataFrame) -> DataFrame:
    """Two run tables, from the records with and without a stop, joined per run."""
    records = _by_run(cleaned)
    sides = _stored(
        records.groupBy("run", "Stop").agg(
            F.count("*").alias(summaries.INPUT),
            F.sum(RUN_SECONDS["scan"]).alias("sum_scan"),
            F.count(RUN_SECONDS["scan"]).alias("n_scan"),
        )
    )
    left, right = _run_log(sides.filter("Stop")), _run_log(sides.filter("NOT Stop"))
    return charts.runtimes(left, right, ("Pandas", "PySpark"))


def _metric_rows(cleaned: DataFrame) -> DataFrame:
    """A wide row of plain and nested figures as (metric, value) text."""
    row = cleaned.agg(
        F.count("*").alias("row_count"),
        F.sort_array(F.collect_set("Severity")).alias("levels"),
        (F.max("Severity") <= 4).alias("levels_in_range"),
        F.struct(F.min("Year").alias("first"), F.max("Year").alias("last")).alias("years"),
    )
    return metric_rows(row)


def _union(cleaned: DataFrame) -> DataFrame:
    return flags.flag_summary_union(
        cleaned, FLAG_COLUMNS, mean=reports.severity_mean(), rate=reports.severe_rate()
    )


def _unpivot(cleaned: DataFrame) -> DataFrame:
    return flags.flag_summary_unpivot(
        cleaned, FLAG_COLUMNS, mean=reports.severity_mean(), rate=reports.severe_rate()
    )


def _features(cleaned: DataFrame) -> DataFrame:
    return reports.road_feature_summary(flags.flag_counts(cleaned, FLAG_COLUMNS))


def _city_from_rows(cleaned: DataFrame) -> DataFrame:
    """City figures by aggregating the rows, no level counts in between."""
    return summaries.summarize(
        cleaned,
        ["City_State", "City", "State"],
        mean=reports.severity_mean(),
        rate={reports.RATE: F.col("Severity_3_4")},
        share=reports.SHARE,
    )


def _line_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return summaries.mean_columns(table(spark, sf_dir, "lineitem"), columns)


def _value_counts(cleaned: DataFrame) -> DataFrame:
    return summaries.value_counts(cleaned, "Weather_Condition")


def _rollup(cleaned: DataFrame) -> DataFrame:
    return incident_rollup(report_base(cleaned))


def _staged_rollup_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the rollup once, then check three reports made from it."""
    rollup = _stored(incident_rollup(report_base(cleaned_incidents(spark, sf_dir))))
    return reports.reconciliation(
        rollup_slice(rollup, "place").agg(F.sum(summaries.COUNT)),
        state=reports.state_summary(rollup_slice(rollup, "place")),
        year=reports.year_summary(rollup_slice(rollup, "time")),
        severity=reports.severity_distribution(rollup_slice(rollup, "weather")),
    )


def _raw_csv(spark: SparkSession, sf_dir: str, files: dict = RAW_FILES) -> tuple[str, str]:
    """A fresh shared folder and the raw records as CSV in it."""
    root = shared_folder(spark)
    raw_incidents(spark, sf_dir, folder=f"{root}/made").write.options(**files).csv(f"{root}/raw_csv")
    let_go(spark, f"{root}/made")
    return root, f"{root}/raw_csv"


def _analysed(spark: SparkSession, sf_dir: str) -> str:
    """The output folder of the analysis job over a stored, Year-partitioned cleaned dataset."""
    root = shared_folder(spark)
    write_partitioned(rows.clean(typed_incidents(spark, sf_dir)), f"{root}/cleaned")
    jobs.analysis_job(spark, f"{root}/cleaned", f"{root}/reports", minimum_city_count=CITY_MINIMUM)
    return f"{root}/reports"


def _analysis_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports written, and two of them read back."""
    out = _analysed(spark, sf_dir)
    checked = read_summary_csv(
        spark, f"{out}/reconciliation", layout="Check STRING, Value STRING, Status STRING"
    )
    cities = read_summary_csv(spark, f"{out}/city_severity_min_{CITY_MINIMUM}", layout="top_cities")
    ranked = cities.select(
        F.col("City_State").alias("Check"),
        F.col("Accident_Count").cast("string").alias("Value"),
        F.lit("CITY").alias("Status"),
    )
    return checked.filter("Status <> 'INFO'").unionByName(ranked)


# Report folders and their key columns; the other columns are measures.
REPORT_KEYS = {
    "state_summary": ["State"],
    "top_100_cities_by_count": ["City_State", "City", "State"],
    "year_summary": ["Year"],
    "year_month_summary": ["Year", "Month"],
    "weekday_summary": ["Weekday_Number", "Weekday"],
    "hour_summary": ["Hour"],
    "weekday_hour_summary": ["Weekday_Number", "Weekday", "Hour"],
    "severity_distribution": ["Severity"],
    "weather_condition_summary": ["Weather_Condition_Group"],
    "numeric_weather_overall": [],
    "road_feature_summary": ["Feature", "Feature_Present"],
}


def _analysis_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other eleven reports read back, a row per group and measure."""
    out = _analysed(spark, sf_dir)
    parts = []
    for name, keys in REPORT_KEYS.items():
        report = read_summary_csv(spark, f"{out}/{name}")
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        measures = [
            F.struct(F.lit(c).alias("Measure"), F.col(c).cast("double").alias("Value"))
            for c in report.columns
            if c not in keys
        ]
        parts.append(report.select(F.lit(name).alias("Report"), key.alias("Key"), F.inline(F.array(*measures))))
    return reduce(DataFrame.unionByName, parts)


def _named(frame: DataFrame, table_name: str, name: str | Column, value: str | Column) -> DataFrame:
    cells = {"Name": name, "Value": value}
    columns = [(F.col(c) if isinstance(c, str) else c).cast("string").alias(k) for k, c in cells.items()]
    return frame.select(F.lit(table_name).alias("Table"), *columns)


def _prepare_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three quality tables of the prepare job read back."""
    root, raw = _raw_csv(spark, sf_dir, SMALL_FILES)
    jobs.prepare_job(spark, raw, f"{root}/out")
    folder = f"{root}/out/results/data_quality"
    summary = read_summary_csv(spark, f"{folder}/summary", layout="metrics").filter("metric <> 'input_uri'")
    missing = read_summary_csv(
        spark,
        f"{folder}/missing_values",
        layout="column STRING, missing_count BIGINT, missing_percentage DOUBLE",
    )
    checked = read_summary_csv(spark, f"{folder}/validation", layout="check STRING, value STRING")
    share = fixed_point("missing_percentage", 4)
    return (
        _named(summary, "summary", "metric", "value")
        .unionByName(_named(missing, "missing_values", "column", "missing_count"))
        .unionByName(_named(missing, "missing_percentage", "column", share))
        .unionByName(_named(checked.filter("check <> 'processed_uri'"), "validation", "check", "value"))
    )


def _split_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count tables and both JSON files of the split benchmark job read back."""
    root, raw = _raw_csv(spark, sf_dir)
    jobs.split_benchmark_job(spark, raw, f"{root}/bench", runs=1)
    run = f"{root}/bench/run_1"
    parts = [
        _named(
            read_summary_csv(spark, f"{run}/{d.lower()}_counts", layout=f"{d} STRING, Accident_Count BIGINT"),
            f"{d.lower()}_counts",
            d,
            "Accident_Count",
        )
        for d in DIMENSIONS
    ]
    metrics = spark.read.schema(
        "input_rows BIGINT, valid_rows BIGINT, reconciliation_status STRING"
    ).json(f"{run}/run_metrics_json")
    parts.append(_named(metric_rows(metrics), "run_metrics", "metric", "value"))
    summary = spark.read.schema(
        "framework STRING, columns_used ARRAY<STRING>, runs BIGINT, all_runs_reconciled BOOLEAN"
    ).json(f"{root}/bench/benchmark_summary")
    flat = summary.withColumn("columns_used", F.concat_ws(",", "columns_used"))
    parts.append(_named(metric_rows(flat), "summary", "metric", "value"))
    return reduce(DataFrame.unionByName, parts)


def _inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The road-feature table written as CSV and read back with inferred types."""
    path = f"{shared_folder(spark)}/road_feature_summary"
    write_csv(_features(cleaned_incidents(spark, sf_dir)), path)
    table_ = read_summary_csv(spark, path)
    return table_.withColumn("Accident_Count", F.col("Accident_Count").cast("bigint"))


def _benchmark_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two timed runs from raw CSV; its invalid rows make them FAIL."""
    root, raw = _raw_csv(spark, sf_dir)
    return jobs.benchmark_job(spark, raw, f"{root}/bench", runs=2).drop("total_seconds", "output_uri")


def _split_benchmark_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of one run with scan and write timed apart."""
    root, raw = _raw_csv(spark, sf_dir)
    table = jobs.split_benchmark_job(spark, raw, f"{root}/bench", runs=1)
    return table.select("run", "input_rows", "valid_rows", "reconciliation_status")


def _chart(name: str, report: Callable[[DataFrame], DataFrame], chart: Callable) -> Query:
    return _report(name, lambda counts: chart(report(counts)))


QUERIES: dict[str, Query] = {
    # reports
    "state_summary": _report("place", reports.state_summary),
    "top_cities": _report("place", reports.top_cities),
    "city_severity_min": _report("place", lambda c: reports.city_severity(c, CITY_MINIMUM)),
    "city_summary_from_rows": _cleaned(_city_from_rows),
    "year_summary": _report("time", reports.year_summary),
    "year_month_summary": _report("time", reports.year_month_summary),
    "weekday_summary": _report("time", reports.weekday_summary),
    "hour_summary": _report("time", reports.hour_summary),
    "weekday_hour_summary": _report("time", reports.weekday_hour_summary),
    "event_weekday_hour": _event_calendar,
    "severity_distribution": _cleaned(_severity),
    "weather_condition_summary": _report("weather", reports.weather_summary),
    "numeric_weather_overall": _cleaned(reports.numeric_weather),
    "numeric_means_lineitem": _line_means,
    "road_feature_summary": _cleaned(_features),
    "road_feature_summary_unpivot": _cleaned(_unpivot),
    "road_feature_summary_union": _cleaned(_union),
    # one-scan rollup and reports made from it
    "incident_rollup": _cleaned(_rollup),
    "state_summary_from_rollup": _rolled("place", reports.state_summary),
    "weather_summary_from_rollup": _rolled("weather", reports.weather_summary),
    "year_month_from_rollup": _rolled("time", reports.year_month_summary),
    "road_features_from_rollup": _rolled("feature", reports.road_feature_summary),
    # counts
    "grouping_sets_counts": _cleaned(lambda c: summaries.grouping_counts(c, DIMENSIONS)),
    "grouping_sets_counts_sql": _cleaned(
        lambda c: summaries.grouping_counts_sql(c, DIMENSIONS, view="counted_rows")),
    "counts_by_state": _dimension_table("State", "string", by_count=True),
    "counts_by_year": _dimension_table("Year", "int"),
    "counts_by_severity": _dimension_table("Severity", "int"),
    "value_counts_weather": _cleaned(_value_counts),
    # quality and cleaning
    "quality_summary": _quality_summary,
    "missing_values": _missing_values,
    "duplicate_metrics": _duplicate_metrics,
    "dedup_keep_first": _dedup,
    "typed_rows": _typed,
    "clean_rows": _clean,
    "parse_timestamps": _parse_timestamps,
    "parse_timestamps_mixed": _parse_mixed,
    "label_texts": _labels,
    # sources and sinks
    "csv_roundtrip": _csv_roundtrip,
    "csv_grouping_counts": _csv_grouping_counts,
    "partitioned_roundtrip": _partitioned_roundtrip,
    "summary_csv_roundtrip": _summary_csv,
    "metrics_json_roundtrip": _metrics_json,
    "metric_rows": _cleaned(_metric_rows),
    "prepare_then_state_summary": _prepare_then_states,
    "analysis_job_outputs": _analysis_job,
    "analysis_job_tables": _analysis_tables,
    "prepare_job_tables": _prepare_tables,
    "split_benchmark_job_tables": _split_tables,
    "inferred_csv_reread": _inferred,
    "benchmark_job_totals": _benchmark_job,
    "split_benchmark_job_rows": _split_benchmark_job,
    # checks and runs
    "validation": _validation,
    "reconciliation": _cleaned(_reconciliation),
    "reconciliation_from_rollup": _staged_rollup_reconciliation,
    "dimension_check": _cleaned(_dimension_check),
    "content_checks": _content_checks,
    "five_way_check": _five_way,
    "benchmark_runs": _cleaned(_run_table),
    "benchmark_summary": _cleaned(_run_summary),
    "run_metrics": _run_metrics,
    "runtime_side_by_side": _cleaned(_runtimes),
    # kept state: increments, rewritten years, set-apart records, sketches, footers
    "incremental_counts": _incremental_counts,
    "dedup_increment": _dedup_increment,
    "year_rewrite": _year_rewrite,
    "csv_quarantine": _csv_quarantine,
    "distinct_sketches_by_year": _cleaned(_sketches_by_year),
    "quantiles_by_state": _cleaned(_quantiles),
    "largest_groups": _cleaned(_largest_groups),
    "largest_cities": _cleaned(_largest_cities),
    "stored_ranges": _stored_ranges,
    # chart tables
    "chart_top_states": _chart("place", reports.state_summary, charts.top_states),
    "chart_top_cities": _chart("place", reports.top_cities, charts.top_cities),
    "chart_yearly": _chart("time", reports.year_summary, lambda s: charts.yearly(s, (1995, 2001))),
    "chart_weekdays": _chart("time", reports.weekday_summary, charts.weekdays),
    "chart_hourly": _chart("time", reports.hour_summary, charts.hourly),
    "chart_severity": _cleaned(lambda c: charts.severity_shares(_severity(c))),
    "chart_weather": _chart("weather", reports.weather_summary, charts.top_weather),
    "chart_features": _cleaned(lambda c: charts.present_features(_features(c))),
}

