"""DataFrame to DataFrame operators."""

from precinct.operators.analysis import (
    focus_top,
    hour_counts,
    label_distribution,
    month_counts,
    multiple_profile,
    offenses_by_state_daytype,
    row_counts,
    top_states_per_type,
    type_by_state,
    types_by_state,
)
from precinct.operators.clean import cast_numeric, derive, filter_valid, impute_zero, standardize
from precinct.operators.counters import add_counters, conditional_counters, demographic_conditions
from precinct.operators.metrics import (
    Evaluation,
    accuracy,
    category_index,
    cell_counts,
    confusion,
    evaluate,
    global_metrics,
    index_to_name,
    label_dictionary,
    majority_predictions,
    name_to_index,
    per_class_metrics,
    reweighted,
    split_cells,
    weighted_f1,
)
from precinct.operators.ml import (
    add_weights,
    balanced_weights,
    build_pipeline,
    class_weights,
    classifier,
    fit,
    label_names,
    load_model,
    pipeline_with_counts,
    save_model,
    score,
)
from precinct.operators.multihot import MultiHot, MultiHotModel, value_counts
from precinct.operators.rank import ranked_values, with_ranks
from precinct.operators.reports import (
    compare_classes,
    compare_models,
    first_available,
    run_kpis,
    run_summary,
    summary_lines,
    text_report,
)
from precinct.operators.runs import metric_trend, phase_timings, recorded_runs, run_series, run_stats, with_run_seconds
from precinct.operators.split import hash_split, in_train, random_split, stratified_sample

__all__ = [name for name in dir() if not name.startswith("_")]
