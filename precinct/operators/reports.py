"""Run summaries, KPI rows, model comparisons and text reports as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.functions import fixed, key_values, minutes, run_stamp, thousands
from precinct.operators.analysis import focus_top, top_states_per_type
from precinct.schema import CATEGORICAL, FOCUS_LABELS, NUMERIC, RANKED_LABELS, SUMMARY_SCHEMA
from precinct.sources.readers import resolve_col

# --- Fixed values: texts and line formats of the reports ---
TITLE = "Resumen - Clasificación MLlib"
NO_TIMINGS = "  (No se encontraron timings)"
NO_DISTRIBUTION = "  (No se encontró distribución)"
TIMINGS_HEADER = "Tiempos por etapa (s):"
SUMMARY_TIMINGS_HEADER = "Timings (s):"
DISTRIBUTION_HEADER = "Distribución INCIDENT_TYPE (ordenada):"
THEFT_HEADER = "THEFT por estado (ordenado):"
FOCUS_HEADER = "Tipos clave por estado (top 10 ordenado):"
TYPE_HEADER = "%s por estado (top 10):"
SOURCE_LINE = "Fuente: %s"
FILE_LINE = "Archivo: %s"
STAMP_LINE = "Fecha (UTC): %s"
ALGORITHM_LINE = "Algoritmo: %s"
COUNTS_LINE = "Leídos: %s | Procesados: %s"
TOTAL_LINE = "Total leídos: %s"
PROCESSED_LINE = "Procesados: %s"
SPLIT_LINE = "Train: %s | Test: %s"
METRICS_LINE = "Accuracy: %s | F1: %s"
DURATION_LINE = "Duración: %s min (%s s)"
RUNTIME_LINE = "Total runtime (s): %s"
MODEL_LINE = "Modelo: %s"
ENTRY_LINE = "  %s: %s"


def run_summary(
    metrics: DataFrame,
    counts: DataFrame,
    algorithm: Column | str,
    timings: Column,
    data_file: str = "",
    model_path: str | None = None,
    total_seconds: Column | None = None,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
    stamp: Column | None = None,
) -> DataFrame:
    """Run-summary records: one per row of ``metrics`` (accuracy, f1), with the one row of ``counts``."""
    metrics = metrics.withColumn("timings_seconds", timings)
    phases = F.map_values("timings_seconds")
    total = counts.select(F.struct("records_total", "records_processed", "train_rows", "test_rows")).scalar()
    values = {
        "run_timestamp": run_stamp() if stamp is None else stamp,
        "data_file": F.lit(data_file),
        **{c: total[c] for c in ("records_total", "records_processed", "train_rows", "test_rows")},
        "algorithm": F.lit(algorithm) if isinstance(algorithm, str) else algorithm,
        "model_path": F.lit(model_path),
        "metrics": F.struct("accuracy", "f1"),
        "timings_seconds": F.col("timings_seconds"),
        "features": F.struct(
            F.array(*map(F.lit, categorical)).alias("categorical"), F.array(*map(F.lit, numeric)).alias("numeric")
        ),
        "total_runtime_seconds": F.aggregate(phases, F.lit(0.0), lambda a, s: a + s)
        if total_seconds is None
        else total_seconds,
    }
    return metrics.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA.fields])


def first_available(df: DataFrame, priority_col: str, *keys: str) -> DataFrame:
    """The row with the lowest priority number, per key if keys are given.

    An aggregate, not a ranking, so that a group is reduced before it is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), priority_col).alias("best")
    picked = df.groupBy(*keys).agg(best) if keys else df.agg(best).filter(F.col("best").isNotNull())
    return picked.select(*keys, "best.*")


def run_kpis(summary: DataFrame) -> DataFrame:
    """The headline numbers of each summary as report text."""
    return summary.select(
        "algorithm",
        *[thousands(F.col(c)).alias(c) for c in ("records_total", "records_processed", "train_rows", "test_rows")],
        fixed(F.col("metrics.accuracy"), 4).alias("accuracy"),
        fixed(F.col("metrics.f1"), 4).alias("f1"),
        fixed(minutes(F.col("total_runtime_seconds")), 2).alias("minutes"),
    )


def compare_models(summaries: DataFrame) -> DataFrame:
    """One row per algorithm with its metrics and data sizes."""
    return summaries.select("algorithm", "metrics.accuracy", "metrics.f1", "train_rows", "test_rows")


def compare_classes(per_class: dict[str, DataFrame]) -> DataFrame:
    """The per-class metrics of several algorithms in one table with an ``algorithm`` column."""
    tables = [df.select(F.lit(name).alias("algorithm"), "*") for name, df in per_class.items()]
    return reduce(DataFrame.unionByName, tables)


def _lines(df: DataFrame, section: int, line: Column, seq: Column | None = None, name: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        (F.lit(0) if seq is None else seq).cast("bigint").alias("seq"),
        (F.lit("") if name is None else name).alias("name"),
        line.alias("line"),
    )


def _block(summary: DataFrame, section: int, lines: Iterable[Column]) -> DataFrame:
    """Several lines per summary row, numbered as given."""
    rows = [F.struct(F.lit(i).alias("i"), line.alias("text")) for i, line in enumerate(lines)]
    return _lines(summary.select(F.inline(F.array(*rows))), section, F.col("text"), F.col("i"))


def _timing_lines(summary: DataFrame, section: int) -> DataFrame:
    timings = summary.select(F.posexplode("timings_seconds").alias("pos", "phase", "seconds"))
    return _lines(timings, section, _line(ENTRY_LINE, "phase", fixed(F.col("seconds"), 2)), F.col("pos"))


def _line(pattern: str, *values: Column | str) -> Column:
    """A formatted line; a missing value leaves its place empty."""
    columns = [F.col(v) if isinstance(v, str) else v for v in values]
    return F.format_string(pattern, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def _metrics_line() -> Column:
    return _line(METRICS_LINE, fixed(F.col("metrics.accuracy"), 4), fixed(F.col("metrics.f1"), 4))


def summary_lines(summary: DataFrame, title: str = TITLE) -> DataFrame:
    """Text form of one run summary: section, seq, name, line."""
    top = [
        F.lit(title),
        _line(STAMP_LINE, "run_timestamp"),
        _line(FILE_LINE, "data_file"),
        _line(TOTAL_LINE, "records_total"),
        _line(PROCESSED_LINE, "records_processed"),
        _line(SPLIT_LINE, "train_rows", "test_rows"),
        _metrics_line(),
        F.lit(SUMMARY_TIMINGS_HEADER),
    ]
    end = [_line(RUNTIME_LINE, fixed(F.col("total_runtime_seconds"), 2)), _line(MODEL_LINE, "model_path")]
    return _block(summary, 0, top).unionByName(_timing_lines(summary, 1)).unionByName(_block(summary, 2, end))


def _titled(rows: DataFrame, section: Column, header: Column, line: Column, seq: Column, name: Column, rank: Column) -> DataFrame:
    """The rows, with a blank line and a header before the one of rank 1, in one projection."""

    def entry(part: Column, number: Column, who: Column, text: Column) -> Column:
        return F.struct(part.alias("section"), number.cast("bigint").alias("seq"), who.alias("name"), text.alias("line"))

    own = F.array(entry(section + 1, seq, name, line))
    none = F.lit("")
    head = F.array(entry(section, F.lit(0), none, none), entry(section, F.lit(1), none, header))
    return rows.select(F.inline(F.when(rank == 1, F.concat(head, own)).otherwise(own)))


def text_report(
    summary: DataFrame,
    distribution: DataFrame,
    theft: DataFrame | None = None,
    by_state: DataFrame | None = None,
    title: str = TITLE,
    focus: Sequence[str] = FOCUS_LABELS,
    ranked: Sequence[str] = RANKED_LABELS,
    n: int = 10,
) -> DataFrame:
    """The text report of one run: section, seq, name, line; sorted by the first three it reads in order.

    Ranked lists carry the negative count as ``seq``, so the order needs no numbering of the rows. The
    inputs are the small result tables of a run, normally read back from where it wrote them.
    """
    seconds = F.col("total_runtime_seconds")
    top = [
        F.lit(title),
        _line(SOURCE_LINE, "data_file"),
        _line(ALGORITHM_LINE, "algorithm"),
        _line(COUNTS_LINE, "records_total", "records_processed"),
        _line(SPLIT_LINE, "train_rows", "test_rows"),
        _metrics_line(),
        _line(DURATION_LINE, fixed(minutes(seconds), 2), fixed(F.coalesce(seconds, F.lit(0.0)), 2)),
        _line(MODEL_LINE, "model_path"),
        F.lit(""),
        F.lit(TIMINGS_HEADER),
    ]
    no_timings = summary.filter(F.coalesce(F.size("timings_seconds"), F.lit(0)) <= 0)
    count = F.col("count")
    empty = distribution.agg(F.count("*").alias("rows")).filter(F.col("rows") == 0)
    parts = [
        _block(summary, 0, top),
        _timing_lines(summary, 1),
        _lines(no_timings, 1, F.lit(NO_TIMINGS)),
        _block(summary, 2, [F.lit(""), F.lit(DISTRIBUTION_HEADER)]),
        _lines(distribution, 3, _line(ENTRY_LINE, "INCIDENT_TYPE", count), -count, F.col("INCIDENT_TYPE")),
        _lines(empty, 3, F.lit(NO_DISTRIBUTION)),
    ]
    if theft is not None:
        state, amount = (F.col(f"`{resolve_col(theft, c) or c}`") for c in ("state", "count"))
        shown = F.coalesce(state, F.lit(""))
        # One row for each state: the window sees a result table.
        rank = F.row_number().over(Window.orderBy(amount.desc(), shown))
        rows = theft.withColumn("rank", rank)
        parts.append(_titled(rows, F.lit(4), F.lit(THEFT_HEADER), _line(ENTRY_LINE, shown, amount), -amount, shown, F.col("rank")))
    if by_state is not None:
        shown = F.coalesce(F.col("state"), F.lit(""))
        present = [t for t in focus if resolve_col(by_state, t)]
        if present:
            pairs = key_values({t: F.col(t) for t in present})
            key = F.col("THEFT") if "THEFT" in present else F.col(present[0])
            rows = focus_top(by_state, focus, n).withColumn("rank", F.row_number().over(Window.orderBy(key.desc(), shown)))
            parts.append(_titled(rows, F.lit(6), F.lit(FOCUS_HEADER), _line(ENTRY_LINE, shown, pairs), -key, shown, F.col("rank")))
        # All labels are ranked and formatted together; a label's place in the list gives its section.
        rows = top_states_per_type(by_state, ranked, n)
        label = F.col("INCIDENT_TYPE")
        place = F.array_position(F.array(*map(F.lit, ranked)), label).cast("int")
        header = F.format_string(TYPE_HEADER, label)
        parts.append(_titled(rows, 6 + 2 * place, header, _line(ENTRY_LINE, shown, count), -count, shown, F.col("rank")))
    return reduce(DataFrame.unionByName, parts)
