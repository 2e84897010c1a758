"""The same results as __spark_entry__.queries(), stated in SQL for the check engine."""

from __future__ import annotations

from collections.abc import Sequence

import workload
from pulsegrid.config import ALL_METRICS, SLEEP_METRICS

# Fixed values of the number and time texts, as in pulsegrid.functions.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_FULL_TIME = r"^([01]?[0-9]|2[0-3]):([0-5]?[0-9]):([0-5]?[0-9])$"


def _with(parts: dict[str, str], final: str) -> str:
    return "with " + ",\n".join(f"{name} as materialized ({text})" for name, text in parts.items()) + "\n" + final


def _num(cell: str) -> str:
    return f"case when regexp_matches({cell}, '{_NUMBER}') then try_cast({cell} as double) end"


def _parsed(source: str, normalize: bool = True) -> str:
    """The rows of a minute table with day_index, minute_of_day and hr_num."""
    short = "length(time) - length(replace(time, ':', '')) = 1"
    time = f"case when {short} then time || ':00' else time end" if normalize else "time"
    return f"""
select *, case when regexp_matches(lower(date), '^day[0-9]+$') then cast(substr(date, 4) as bigint) end as day_index,
       case when regexp_matches(time, '{_FULL_TIME}')
            then cast(split_part(time, ':', 1) as int) * 60 + cast(split_part(time, ':', 2) as int) end as minute_of_day,
       {_num('hr')} as hr_num
from (select * replace ({time} as time) from {source})"""


_TIMED = "day_index is not null and minute_of_day is not null"
_RECORDED = f"{_TIMED} and hr_num <> 0"


def _sparse(normalize: bool = True) -> dict[str, str]:
    return {"raw": workload.sparse_sql(), "p": _parsed("raw", normalize)}


def _odd_subjects() -> dict[str, str]:
    return {"raw": f"select * replace ({workload.ODD_SUBJECT} as subject_id) from ({workload.sparse_sql()})", "p": _parsed("raw")}


def _any_num(cell: str) -> str:
    """Like _num, for cells with blanks, signs and infinities."""
    return f"""case when regexp_matches({cell}, '{_NUMBER}') then try_cast(ltrim({cell}, '+') as double)
            when regexp_matches(lower({cell}), '^[+-]?inf(inity)?$')
            then case when {cell} like '-%' then cast('-inf' as double) else cast('inf' as double) end end"""


def _strip(cell: str) -> str:
    return rf"regexp_replace({cell}, '^\s+|\s+$', '', 'g')"


def _odd() -> dict[str, str]:
    """The odd minutes: raw, and p with the derived columns."""
    return {"raw": workload.odd_sql(), "p": _odd_parsed("raw")}


def _odd_parsed(source: str) -> str:
    time = _strip("time")
    return f"""
select * exclude (day_text, day_num, hr_text),
       case when day_text like 'day%' and day_num = floor(day_num) then cast(day_num as bigint) end as day_index,
       case when regexp_matches(time, '{_FULL_TIME}')
            then cast(split_part(time, ':', 1) as int) * 60 + cast(split_part(time, ':', 2) as int) end as minute_of_day,
       {_any_num('hr_text')} as hr_num
from (select *, {_any_num(_strip('substr(day_text, 4)'))} as day_num
      from (select * replace (case when length({time}) - length(replace({time}, ':', '')) = 1
                              then {time} || ':00' else {time} end as time),
                   lower({_strip('date')}) as day_text, {_strip('hr')} as hr_text
            from {source}))"""


def _odd_clean() -> dict[str, str]:
    zeroed = f"select * replace (case when hr_num not between 40 and 163 then '0' else hr end as hr) from ({_odd_parsed('d')})"
    return _odd() | {"d": _deduped(), "z": f"select subject_id, date, time, hr, src_order, copies from ({zeroed})", "c": _odd_parsed("z")}


def _dense() -> dict[str, str]:
    return {"raw": workload.dense_sql(), "p": _parsed("raw")}


def _deduped(keep: str = "max", columns: str = "subject_id, date, time") -> str:
    arg = "arg_max" if keep == "max" else "arg_min"
    return f"""
select {columns}, {arg}(hr, src_order) as hr, {keep}(src_order) as src_order, count(*) as copies
from p where {_RECORDED} group by {columns}"""


def _zeroed(source: str) -> str:
    return f"select * replace (case when {_num('hr')} not between 40 and 163 then '0' else hr end as hr) from {source}"


def _sparse_clean(normalize: bool = True) -> dict[str, str]:
    return _sparse() | {"d": _deduped(), "z": _zeroed("d"), "c": _parsed("z", normalize)}


def _dense_clean() -> dict[str, str]:
    return _dense() | {"c": _parsed(f"({_zeroed('raw')})")}


_OBSERVED = f"""
select subject_id, day_index, arg_min(date, src_order) as date,
       count(distinct case when hr_num > 0 then minute_of_day end) as worn_minutes
from c where {_TIMED} group by subject_id, day_index"""


def _grid(source: str, start: str = "0", end: str = "last_day") -> str:
    return f"""
select subject_id, unnest(range(first_day, end_day + 1)) as day_index
from (select subject_id, cast({start} as bigint) as first_day, cast({end} as bigint) as end_day
      from (select subject_id, max(day_index) as last_day from {source}
            where subject_id is not null group by subject_id))"""


def _adherence(threshold: int, start: str = "0") -> dict[str, str]:
    return {
        "obs": _OBSERVED,
        "grid": _grid("obs", start),
        "daily": f"""
select g.subject_id, g.day_index, o.date, cast(coalesce(o.worn_minutes, 0) as bigint) as worn_minutes,
       cast(1440 as bigint) as expected_minutes,
       cast(coalesce(o.worn_minutes, 0) as double) / 1440.0 as adherence_ratio,
       coalesce(o.worn_minutes, 0) >= {threshold} as is_valid_day
from grid g left join obs o on g.subject_id = o.subject_id and g.day_index = o.day_index""",
    }


def _dense_days() -> dict[str, str]:
    return _dense_clean() | _adherence(1152)


def _sparse_days() -> dict[str, str]:
    return _sparse_clean() | _adherence(2)


def _runs(need: int, where: str = "true") -> dict[str, str]:
    return {
        "days": f"select * from daily where {where}",
        "flagged": """
select subject_id, day_index,
       case when day_index = lag(day_index) over w + 1 then 0 else 1 end as starts
from days where is_valid_day window w as (partition by subject_id order by day_index)""",
        "numbered": """
select *, sum(starts) over (partition by subject_id order by day_index
                            rows between unbounded preceding and current row) as run from flagged""",
        "runs": """
select subject_id, min(day_index) as first, max(day_index) as last, count(*) as n
from numbered group by subject_id, run""",
        "best": """
select subject_id, n, first, last from runs
qualify row_number() over (partition by subject_id order by n desc, first) = 1""",
        "summary": f"""
select s.subject_id, cast(coalesce(b.n, 0) as bigint) as max_run_len, b.first as best_run_start_day,
       b.last as best_run_end_day, coalesce(b.n, 0) >= {need} as pass
from (select distinct subject_id from days) s left join best b on s.subject_id = b.subject_id""",
    }


_READINGS = """
select subject_id, day_index, avg(hr_num) as daily_mean, max(hr_num) as daily_max, min(hr_num) as daily_min
from c where day_index is not null and hr_num > 0 group by subject_id, day_index"""


def _hr_stats() -> dict[str, str]:
    return _dense_days() | {
        "readings": _READINGS,
        "stats": """
select k.subject_id, k.date, r.daily_mean, r.daily_max, r.daily_min
from daily k left join readings r on k.subject_id = r.subject_id and k.day_index = r.day_index
where k.is_valid_day""",
    }


def _odd_stats() -> dict[str, str]:
    """Statistics of all days of the grid, so also of days without readings."""
    return _odd_clean() | _adherence(2) | {
        "readings": _READINGS,
        "stats": """
select k.subject_id, k.date, r.daily_mean, r.daily_max, r.daily_min
from daily k left join readings r on k.subject_id = r.subject_id and k.day_index = r.day_index""",
    }


_STATS_SUMMARY = (
    "select count(distinct subject_id) as n_subjects, count(*) as n_valid_days, "
    "count(daily_mean) as n_days_with_hr_data, count(*) - count(daily_mean) as n_days_missing_hr_data, "
    + ", ".join(
        f"round_even(avg({m}) * 10, 0) / 10 as mean_{m}_hr, round_even(stddev_samp({m}) * 10, 0) / 10 as sd_{m}_hr"
        for m in ("daily_mean", "daily_max", "daily_min")
    )
    + " from stats"
)


def _collapsed(name: str, source: str, metrics: list[str], absent: list[str] = (), how: str = "mean") -> str:
    values = []
    for m in metrics:
        value = f"avg({_num(m)})"
        if how == "first":
            value = f"arg_min({_num(m)}, src_order) filter (where ({_num(m)}) is not null)"
        values.append(f"{value} as {m}")
        values.append(f"case when count(*) = 1 then count({m}) = 0 else avg({_num(m)}) is null end as {m}__missing")
    for m in absent:
        values += [f"cast(null as double) as {m}", f"true as {m}__missing"]
    return f"""
select subject_id, date, {', '.join(values)} from ({source}) group by subject_id, date
having count(*) = 1 or (subject_id is not null and date is not null)"""


_PRESENT = {
    "activity": ["steps", "distance"],
    "resting": ["resting_hr"],
    "daily_hr": ["daily_mean", "daily_max", "daily_min"],
    "sleep": ["total_minutes_asleep", "total_time_in_bed", "cnt_wake"],
}
_ABSENT = {
    "activity": ["calories"],
    "resting": [],
    "daily_hr": [],
    "sleep": [m for m in SLEEP_METRICS if m not in _PRESENT["sleep"]],
}
_TRUE = "lower(is_valid_day) in ('true', '1')"


def _merged(keys: str, collapsed: dict[str, str]) -> dict[str, str]:
    joins = " ".join(
        f"left join {s} on k.subject_id is not distinct from {s}.subject_id and k.date is not distinct from {s}.date"
        for s in collapsed
    )
    columns = ", ".join(f"{m}, coalesce({m}__missing, true) as {m}__missing" for m in ALL_METRICS)
    return {"keys": keys} | collapsed | {"merged": f"select k.subject_id, k.date, {columns} from keys k {joins}"}


def _coverage(where: str = _TRUE) -> dict[str, str]:
    keys = f"select distinct subject_id, date from ({workload.daily_sql('keys')}) where {where}"
    return _merged(keys, {s: _collapsed(s, workload.daily_sql(s), _PRESENT[s], _ABSENT[s]) for s in _PRESENT})


def _report(metrics: Sequence[str] = ALL_METRICS) -> str:
    rows = []
    for place, m in enumerate(metrics):
        if m in ALL_METRICS:
            count = f"cast(count_if({m}__missing) as bigint)"
            rate = f"case when count(*) = 0 then 0.0 else count_if({m}__missing) / cast(count(*) as double) end"
        else:
            count, rate = "count(*)", "1.0"
        rows.append(
            f"select cast({place} as int) as place, '{m}' as metric, {count} as missing_count, "
            f"cast({rate} as double) as missing_rate, count(*) as total_keys from merged"
        )
    return " union all ".join(rows)


def _compliance(clean: dict[str, str]) -> dict[str, str]:
    return clean | {
        "obs": _OBSERVED,
        "grid": _grid("obs"),
        "compliance": """
select g.subject_id, g.day_index, 'day' || cast(g.day_index as varchar) as date,
       cast(coalesce(o.worn_minutes, 0) as bigint) as worn_minutes,
       cast(coalesce(o.worn_minutes, 0) as double) / 1440.0 as compliance
from grid g left join obs o on g.subject_id = o.subject_id and g.day_index = o.day_index""",
    }


def _histogram(clean: dict[str, str]) -> str:
    return _with(
        _compliance(clean)
        | {
            "ends": """
select case when min(compliance) = max(compliance) then min(compliance) - 0.5 else min(compliance) end as lo,
       case when min(compliance) = max(compliance) then max(compliance) + 0.5 else max(compliance) end as hi
from compliance""",
            "edges": """
select bin, lo + bin * ((hi - lo) / 25.0) as low_edge,
       case when bin = 24 then hi else lo + (bin + 1) * ((hi - lo) / 25.0) end as high_edge
from ends, (select cast(unnest(range(0, 25)) as bigint) as bin)""",
        },
        """select bin, low_edge as lo, high_edge as hi, (select count(*) from compliance
where compliance >= low_edge and (compliance < high_edge or (bin = 24 and compliance <= high_edge))) as n
from edges""",
    )


def _cohort() -> dict[str, str]:
    """The combined job on dense minutes, its own heart-rate statistics, and the daily sources."""
    parts = _dense() | {"d": _deduped(), "z": _zeroed("d"), "c": _parsed("z")} | _adherence(1152)
    parts |= _runs(7)
    parts |= {
        "daily_pass": "select * from days where subject_id in (select subject_id from summary where pass)",
        "readings": _READINGS,
        "stats": """
select k.subject_id, k.date, r.daily_mean, r.daily_max, r.daily_min
from daily k left join readings r on k.subject_id = r.subject_id and k.day_index = r.day_index
where k.is_valid_day""",
    }
    collapsed = {
        s: _collapsed(s, workload.daily_sql(s), _PRESENT[s], _ABSENT[s]) for s in ("activity", "resting", "sleep")
    }
    own = ", ".join(f"{m}, {m} is null as {m}__missing" for m in _PRESENT["daily_hr"])
    collapsed["daily_hr"] = f"select subject_id, date, {own} from stats"
    return parts | _merged("select distinct subject_id, date from daily_pass where is_valid_day", collapsed)


def _stage(name: str, source: str, rows: str = "count(*)") -> str:
    return (
        f"select '{name}' as stage, cast(coalesce({rows}, 0) as bigint) as rows, "
        f"count(distinct subject_id) as subjects from {source}"
    )


_GLOBAL = """
select count(distinct subject_id) as n_subjects, count(*) as total_patient_days,
       count(*) * 1440 as total_expected_minutes,
       cast(coalesce(sum(recorded_minutes), 0) as bigint) as total_recorded_minutes
from (select g.subject_id, r.recorded_minutes
      from grid g left join rec r on g.subject_id = r.subject_id and g.day_index = r.day_index)"""

_REC = f"""
select subject_id, day_index, count(*) as recorded_minutes
from p where {_RECORDED} and subject_id is not null group by subject_id, day_index"""

_DEDUP_SUMMARY = """
select (select count(*) from d) as filtered_rows,
       cast((select coalesce(sum(copies - 1), 0) from d) as bigint) as removed_duplicates_rows,
       cast((select coalesce(sum(greatest(last_day + 1, 0)), 0)
             from (select subject_id, max(day_index) as last_day from e
                   where subject_id is not null group by subject_id))
            - (select count(*) from (select distinct subject_id, day_index from e)) as bigint) as non_wear_days"""


def statements() -> dict[str, str]:
    sparse, dense, dense_days, sparse_days = _sparse(), _dense(), _dense_days(), _sparse_days()
    activity = workload.daily_sql("activity")
    recorded = sparse | {"rec": _REC}
    flags = "hr_num < 40 as is_too_low, hr_num > 163 as is_too_high, hr_num < 40 or hr_num > 163 as is_outlier"
    columns = "src_order, subject_id, date, time, hr"
    untimed = _sparse(normalize=False)
    daily_columns = "subject_id, day_index, date, worn_minutes, expected_minutes, adherence_ratio, is_valid_day"
    activity_mean = "subject_id, date, steps, distance, calories"
    cohort = _cohort()
    cohort_clean = dense | {"d": _deduped(), "z": _zeroed("d"), "c": _parsed("z")}
    return {
        "parse_minutes": _with(
            sparse,
            f"select {columns}, day_index, minute_of_day, hr_num, ({_TIMED}) as ok_datetime, "
            "coalesce(hr_num <> 0, false) as ok_hr_validminute from p",
        ),
        "csv_round_trip": _with(sparse, "select subject_id, date, time, hr from raw"),
        "csv_odd_records": _with(
            _odd_subjects() | {"d": _deduped()}, "select subject_id, date, time, hr, copies from d"
        ),
        "csv_two_layouts": _with(
            sparse | {"d": _deduped()}, "select subject_id, date, time, hr, copies from d"
        ),
        "timed_minutes": _with(untimed, f"select {columns} from p where {_TIMED}"),
        "recorded_minutes": _with(
            sparse, f"select {columns} from raw where src_order in (select src_order from p where {_RECORDED})"
        ),
        "worn_minutes": _with(untimed, f"select {columns} from p where {_TIMED} and hr_num > 0"),
        "recorded_minutes_per_day": _with(recorded, "select * from rec"),
        "last_recorded_days": _with(
            recorded, "select subject_id, max(day_index) as last_day from rec group by subject_id"
        ),
        "patient_days": _with(
            recorded | {"grid": _grid("rec", "3")},
            "select g.subject_id, g.day_index, cast(coalesce(r.recorded_minutes, 0) as bigint) as recorded_minutes "
            "from grid g left join rec r on g.subject_id = r.subject_id and g.day_index = r.day_index",
        ),
        "global_counts": _with(dense | {"rec": _REC, "grid": _grid("rec")}, _GLOBAL),
        "global_counts_range": _with(recorded | {"grid": _grid("rec", "2", "35")}, _GLOBAL),
        "recording_ratio": _with(
            recorded | {"grid": _grid("rec")},
            f"select *, total_recorded_minutes / cast(total_expected_minutes as double) as recording_ratio from ({_GLOBAL})",
        ),
        "dedup_last": _with(sparse, _deduped("max")),
        "dedup_first": _with(sparse, _deduped("min")),
        "dedup_by_minute": _with(
            sparse,
            f"""select subject_id, day_index, minute_of_day, arg_max(date, src_order) as date,
       arg_max(time, src_order) as time, last.hr as hr, last.hr_num as hr_num, max(src_order) as src_order,
       count(*) as copies
from (select *, arg_max(struct_pack(hr := hr, hr_num := hr_num), src_order)
             over (partition by subject_id, day_index, minute_of_day) as last
      from p where {_TIMED})
group by subject_id, day_index, minute_of_day, last""",
        ),
        "dedup_summary": _with(sparse | {"d": _deduped(), "e": _parsed("d")}, _DEDUP_SUMMARY),
        "outlier_flags": _with(untimed, f"select {columns}, hr_num, {flags} from p"),
        "outlier_replace": _with(
            sparse,
            "select src_order, subject_id, date, time, "
            "case when hr_num < 40 or hr_num > 163 then '0' else hr end as hr from p",
        ),
        "outlier_drop": _with(sparse, f"select {columns} from p where hr_num between 60 and 150"),
        "outlier_summary": _with(
            dense,
            """select count(*) as input_rows, count(*) filter (where hr_num < 40 or hr_num > 163) as outliers_detected,
       count(*) filter (where hr_num < 40) as outliers_too_low,
       count(*) filter (where hr_num > 163) as outliers_too_high,
       count(*) filter (where hr_num < 40 or hr_num > 163) / cast(count(*) as double) * 100 as outlier_percent
from p""",
        ),
        "observed_days": _with(_sparse_clean(), _OBSERVED),
        "day_grid": _with(_sparse_clean() | {"obs": _OBSERVED}, _grid("obs")),
        "day_grid_to_fixed_end": _with(_sparse_clean() | {"obs": _OBSERVED}, _grid("obs", "5", "40")),
        "daily_adherence": _with(dense_days, f"select {daily_columns} from daily"),
        "daily_adherence_sparse": _with(sparse_days, f"select {daily_columns} from daily"),
        "daily_adherence_from_first_day": _with(
            _sparse_clean() | _adherence(2, "(select min(day_index) from obs)"),
            f"select {daily_columns} from daily",
        ),
        "valid_day_summary": _with(
            dense_days,
            """select count(distinct subject_id) as n_subjects, count(*) as total_patient_days,
       count(*) filter (where is_valid_day) as total_valid_days,
       count(*) filter (where is_valid_day) / cast(count(*) as double) as valid_day_ratio,
       cast(1152 as bigint) as threshold_minutes, cast(0.8 as double) as threshold_ratio
from daily""",
        ),
        "participant_runs": _with(dense_days | _runs(7), "select * from summary"),
        "participant_runs_sparse": _with(sparse_days | _runs(3), "select * from summary"),
        "participant_runs_range": _with(
            dense_days | _runs(4, "day_index between 2 and 9"), "select * from summary"
        ),
        "subjects_pass": _with(dense_days | _runs(7), "select subject_id from summary where pass"),
        "subjects_fail": _with(dense_days | _runs(7), "select subject_id from summary where not pass"),
        "daily_pass": _with(
            sparse_days | _runs(3),
            f"select {daily_columns} from days where subject_id in (select subject_id from summary where pass)",
        ),
        "run_stats": _with(
            sparse_days | _runs(3),
            """select count(*) as n_subjects, count(*) filter (where pass) as n_pass,
       count(*) filter (where not pass) as n_fail,
       round(count(*) filter (where pass) / cast(count(*) as double) * 100, 9) as pass_percent,
       round(avg(max_run_len) filter (where pass), 9) as mean_run_len,
       cast(median(max_run_len) filter (where pass) as double) as median_run_len,
       min(max_run_len) filter (where pass) as min_run_len, max(max_run_len) filter (where pass) as max_run_len
from summary""",
        ),
        "valid_day_keys": _with(dense_days, "select subject_id, day_index, date from daily where is_valid_day"),
        "worn_readings": _with(
            sparse, "select subject_id, day_index, hr_num from p where day_index is not null and hr_num > 0"
        ),
        "readings_on_valid_days": _with(
            sparse_days,
            """select c.subject_id, c.day_index, c.hr_num
from c join daily k on c.subject_id = k.subject_id and c.day_index = k.day_index
where k.is_valid_day and c.hr_num > 0""",
        ),
        "daily_hr_stats": _with(_hr_stats(), "select * from stats"),
        "hr_stats_summary": _with(_hr_stats(), _STATS_SUMMARY),
        "metric_keys": f"select distinct subject_id, date from ({workload.daily_sql('keys')}) where {_TRUE}",
        "collapse_mean": _with(
            {"a": _collapsed("activity", activity, _PRESENT["activity"], ["calories"])},
            f"select {activity_mean} from a",
        ),
        "collapse_first": _with(
            {"a": _collapsed("activity", activity, _PRESENT["activity"], ["calories"], "first")},
            f"select {activity_mean} from a",
        ),
        "merged_metrics": _with(_coverage(), f"select subject_id, date, {', '.join(ALL_METRICS)} from merged"),
        "missingness": _with(
            _coverage(), f"select metric, missing_count, missing_rate, total_keys from ({_report()})"
        ),
        "missingness_top": _with(_coverage(), f"select * from ({_report()}) order by place limit 10"),
        "missingness_unknown_metric": _with(
            _coverage("true"),
            f"select metric, missing_count, missing_rate, total_keys from ({_report(['steps', 'weight'])})",
        ),
        "daily_compliance": _with(_compliance(_dense_clean()), "select * from compliance"),
        "compliance_stats": _with(
            _compliance(_dense_clean()),
            """select count(*) as n_days, round(avg(compliance), 9) as mean_compliance,
       round(median(compliance), 9) as median_compliance,
       count(*) filter (where compliance = 0) as zero_days, cast(0.8 as double) as threshold_ratio
from compliance""",
        ),
        "compliance_histogram": _histogram(_dense_clean()),
        "compliance_histogram_sparse": _histogram(_sparse_clean()),
        "dedup_last_from_files": _with(
            sparse | {"d": _deduped()}, "select subject_id, date, time, hr, copies from d"
        ),
        "odd_minutes": _with(
            _odd(),
            f"select {columns}, day_index, minute_of_day, hr_num, ({_TIMED}) as ok_datetime, "
            "coalesce(hr_num <> 0, false) as ok_hr_validminute from p",
        ),
        "odd_dedup": _with(_odd() | {"d": _deduped()}, f"select {columns}, copies from d"),
        "odd_dedup_summary": _with(_odd() | {"d": _deduped(), "e": _odd_parsed("d")}, _DEDUP_SUMMARY),
        "odd_outliers": _with(_odd_clean(), f"select {columns} from z"),
        "odd_adherence": _with(_odd_clean() | _adherence(2), f"select {daily_columns} from daily"),
        "odd_adherence_from_first_day": _with(
            _odd_clean() | _adherence(2, "(select min(day_index) from obs)"), f"select {daily_columns} from daily"
        ),
        "odd_hr_stats": _with(_odd_stats(), "select * from stats"),
        "odd_hr_summary": _with(_odd_stats(), _STATS_SUMMARY),
        "odd_readings_on_repeated_days": _with(
            _odd_clean() | _adherence(2),
            """select subject_id, day_index, hr_num from p where hr_num > 0
and (subject_id, day_index) in (select (subject_id, day_index) from daily where is_valid_day)""",
        ),
        "runs_over_blocks": _with({"daily": workload.long_sql()} | _runs(30), "select * from summary"),
        "cohort_flow": _with(
            cohort,
            " union all ".join(
                [
                    _stage("raw minutes", "raw"),
                    _stage("recorded minutes", "d", "sum(copies)"),
                    _stage("deduplicated minutes", "d"),
                    _stage("timed minutes", f"c where {_TIMED}"),
                    _stage("worn minutes", "obs where worn_minutes > 0", "sum(worn_minutes)"),
                    _stage("patient days", "daily"),
                    _stage("valid days", "daily where is_valid_day"),
                    _stage("days of passing subjects", "daily_pass"),
                    _stage("valid days with readings", "stats where daily_mean is not null"),
                    _stage("days with merged metrics", "merged"),
                ]
            ),
        ),
        "cohort_raw_counts": _with(sparse, _stage("raw", "raw")),
        "cohort_dedup_summary": _with(dense | {"d": _deduped(), "e": _parsed("d")}, _DEDUP_SUMMARY),
        "cohort_global_counts": _with(dense | {"rec": _REC, "grid": _grid("rec")}, _GLOBAL),
        "cohort_outlier_counts": _with(
            cohort,
            f"""select count(*) as input_rows, count(*) filter (where h < 40 or h > 163) as outliers_detected,
       count(*) filter (where h < 40) as outliers_too_low, count(*) filter (where h > 163) as outliers_too_high
from (select {_num('hr')} as h from d)""",
        ),
        "cohort_hr_stats": _with(cohort, "select * from stats"),
        "cohort_hr_summary": _with(cohort, _STATS_SUMMARY),
        "cohort_participants": _with(
            cohort,
            """select count(*) as n_subjects, count(*) filter (where pass) as n_pass,
       count(*) filter (where not pass) as n_fail,
       round(count(*) filter (where pass) / cast(count(*) as double) * 100, 9) as pass_percent,
       round(avg(max_run_len) filter (where pass), 9) as mean_run_len,
       cast(median(max_run_len) filter (where pass) as double) as median_run_len,
       min(max_run_len) filter (where pass) as min_run_len, max(max_run_len) filter (where pass) as max_run_len
from summary""",
        ),
        "cohort_merged_metrics": _with(cohort, f"select subject_id, date, {', '.join(ALL_METRICS)} from merged"),
        "cohort_compliance": _with(_compliance(cohort_clean), "select * from compliance"),
        "cohort_histogram": _histogram(cohort_clean),
        "cohort_daily_pass": _with(cohort, f"select {daily_columns} from daily_pass"),
        "cohort_missingness": _with(
            cohort, f"select metric, missing_count, missing_rate, total_keys from ({_report()})"
        ),
    }
