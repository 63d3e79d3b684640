"""DuckDB SQL twins of the catalog queries (the correctness oracle).

The run view is the same mapping of ``lineitem`` as
:func:`stridewise.sources.tables.run_view`; the cleaning chain is restated
with window functions, grouping sets and joins. Thresholds are spelled out
as the defaults of :class:`stridewise.config.CleaningConfig`.
"""

from __future__ import annotations

IDS = "l_orderkey, l_linenumber, copy_no"
CORE = "date, activity_type, distance_km, duration_sec, calories, avg_heart_rate, max_heart_rate, source, export_date"
ALL = f"{CORE}, {IDS}"

RUN_CTES = """b as (
  select case l_returnflag when 'A' then 'alpha' when 'N' then 'beta' else 'gamma' end as source,
         l_shipdate as date,
         case when l_linenumber = 7 then 'Cycling' when l_linenumber >= 5 then 'Trail Running'
              else 'Running' end as activity_type,
         case when l_partkey % 101 = 0 then null when l_partkey % 103 = 0 then l_quantity + 40
              else l_quantity end as distance_km,
         case when l_suppkey % 37 = 0 then null
              else l_quantity * 60 * (2 + ((l_orderkey * 7 + l_partkey) % 900) / cast(100 as double))
         end as duration_sec,
         case when l_tax = 0 then null when l_tax = 0.08 and l_discount = 0 then cast(0 as double)
              else l_quantity * (20 + l_partkey % 110) end as calories,
         case when l_discount = 0.1 then null when l_partkey % 211 = 0 then cast(0 as double)
              when l_partkey % 199 = 0 then cast(305 as double)
              else cast(75 + l_partkey % 140 as double) end as avg_heart_rate,
         case when l_discount = 0.09 then null
              else cast(69 + l_partkey % 140 + l_orderkey % 60 as double) end as max_heart_rate,
         l_orderkey, l_linenumber
  from lineitem),
rv as (
  select *, 0 as copy_no, cast('2025-08-22' as timestamp) as export_date from b
  union all
  select *, 1 as copy_no, cast('2025-09-19' as timestamp) as export_date from b where l_orderkey % 97 = 0),
runs as (
  select """ + ALL + """ from rv where lower(activity_type) like '%run%')"""

V_DIST = "coalesce(distance_km between 0.05 and 60, false)"
V_DUR = "coalesce(duration_sec between 60 and 18000, false)"
PACE = "((duration_sec / cast(60 as double)) / nullif(distance_km, 0))"
V_PACE = f"coalesce({PACE} between 2.3 and 10.5, false)"
V_HR = "coalesce(avg_heart_rate between 80 and 210, false)"
INV = "(avg_heart_rate is not null and max_heart_rate is not null and max_heart_rate < avg_heart_rate)"
TOL = f"({INV} and avg_heart_rate - max_heart_rate <= 3)"
CONFLICT = f"({INV} and not {TOL})"

DEDUPE_ORDER = ("export_date nulls first, activity_type nulls first, calories nulls first, "
                "avg_heart_rate nulls first, max_heart_rate nulls first, l_orderkey nulls first, "
                "l_linenumber nulls first, copy_no nulls first")
KEY = "source, date, distance_km, duration_sec"

DIST_BIN = """case when (case when distance_km < 0 then 0 else distance_km end) >= 0 and (case when distance_km < 0 then 0 else distance_km end) < 5 then cast(0.0 as double)
     when (case when distance_km < 0 then 0 else distance_km end) >= 5 and (case when distance_km < 0 then 0 else distance_km end) < 10 then cast(5.0 as double)
     when (case when distance_km < 0 then 0 else distance_km end) >= 10 and (case when distance_km < 0 then 0 else distance_km end) < 15 then cast(10.0 as double)
     when (case when distance_km < 0 then 0 else distance_km end) >= 15 and (case when distance_km < 0 then 0 else distance_km end) < 25 then cast(15.0 as double)
     when (case when distance_km < 0 then 0 else distance_km end) >= 25 and (case when distance_km < 0 then 0 else distance_km end) < 50 then cast(25.0 as double) end"""


def hr_bin_sql(hr: str, e: str, nd: str) -> str:
    return (f"cast(case when {hr} is null then null when {nd} >= 4 then greatest(1, len(list_filter(list_distinct({e}), lambda x: x < {hr}))) "
            f"when {nd} >= 2 then case when {hr} <= {e}[1] + ({e}[len({e})] - {e}[1]) / cast(2 as double) then 1 else 2 end end as integer)")


# steps 1-4: s_dd = deduplicated (with n_copies), s_act = rows still in play
STEPS_1_4 = f""",
s1 as (select * replace (coalesce(date, export_date + interval 12 hour) as date) from runs),
s2 as (select *, count(*) over (partition by {KEY}) as n_copies,
              row_number() over (partition by {KEY} order by {DEDUPE_ORDER}) as rn from s1),
s_dd as (select * exclude (rn) from s2 where rn = 1),
s_act as (select {ALL} from s_dd
          where distance_km is not null and duration_sec is not null and {V_DIST} and {V_DUR} and {V_PACE})"""

HR_STEP = f""",
h1 as (select * replace (case when avg_heart_rate > 0 and avg_heart_rate <= 300 then avg_heart_rate end as avg_heart_rate,
                         case when max_heart_rate > 0 and max_heart_rate <= 300 then max_heart_rate end as max_heart_rate)
       from s_act),
h2 as (select * replace (case when {CONFLICT} then null else avg_heart_rate end as avg_heart_rate,
                         case when {CONFLICT} then null when {TOL} then avg_heart_rate else max_heart_rate end as max_heart_rate)
       from h1),
hm as (select source, median(avg_heart_rate) as m_avg, median(max_heart_rate) as m_max from h2
       where source is not null group by source),
s_hr as (select h2.date, h2.activity_type, h2.distance_km, h2.duration_sec, h2.calories,
                coalesce(h2.avg_heart_rate, hm.m_avg) as avg_heart_rate,
                coalesce(h2.max_heart_rate, hm.m_max) as max_heart_rate,
                h2.source, h2.export_date, h2.l_orderkey, h2.l_linenumber, h2.copy_no
         from h2 left join hm on h2.source = hm.source)"""


def calories_step(frame_level0: bool) -> str:
    level0 = ("(select median(cal) as med from c1) m0 on true" if frame_level0 else
              "(select source, med from cm where gid = 3) m0 on c1.source is not distinct from m0.source")
    return f""",
c0 as (select *, case when calories > 0 then calories end as cal, {DIST_BIN} as dist_bin from s_hr),
edges as (select source, quantile_cont(avg_heart_rate, [0, 0.25, 0.5, 0.75, 1.0]) as e,
                 count(distinct avg_heart_rate) as nd from c0 where source is not null group by source),
c1 as (select c0.*, {hr_bin_sql('c0.avg_heart_rate', 'edges.e', 'edges.nd')} as hr_bin
       from c0 left join edges on c0.source = edges.source),
cm as (select grouping(source, dist_bin, hr_bin) as gid, source, dist_bin, hr_bin, median(cal) as med
       from c1 group by grouping sets ((source, dist_bin, hr_bin), (source, dist_bin), (source))),
c2 as (select c1.*, m3.med as m3, m2.med as m2, m1.med as m1, m0.med as m0 from c1
  left join (select * from cm where gid = 0) m3 on c1.source is not distinct from m3.source
       and c1.dist_bin is not distinct from m3.dist_bin and c1.hr_bin is not distinct from m3.hr_bin
  left join (select * from cm where gid = 1) m2 on c1.source is not distinct from m2.source
       and c1.dist_bin is not distinct from m2.dist_bin
  left join (select * from cm where gid = 3) m1 on c1.source is not distinct from m1.source
  left join {level0}),
c3 as (select *, coalesce(cal, m3, m2, m1, m0) as cal_filled, cal is null as calories_imputed,
              case when cal is not null then null when m3 is not null then 'level3' when m2 is not null then 'level2'
                   when m1 is not null then 'level1' else 'level0' end as imputation_level from c2),
c4 as (select *, case when cal_filled is not null then greatest(50, least(3000, cal_filled)) end as cal_abs from c3),
c5 as (select *, case when cal_abs / nullif(distance_km, 0) is not null
                      then greatest(25, least(120, cal_abs / nullif(distance_km, 0))) end as per_km from c4),
s_cal as (select date, activity_type, distance_km, duration_sec, round_even(per_km * distance_km, 0) as calories,
                 avg_heart_rate, max_heart_rate, source, export_date, {IDS}, calories_imputed, imputation_level,
                 cal_filled, cal_abs, cal, dist_bin, hr_bin
          from c5)"""


PIPELINE = STEPS_1_4 + HR_STEP + calories_step(False) + f""",
s_final as (select {ALL}, calories_imputed, imputation_level from s_cal where {V_HR}),
featured as (select *, duration_sec / cast(60 as double) as duration_min,
                    (duration_sec / cast(60 as double)) / nullif(distance_km, 0) as pace_min_per_km from s_final)"""


def q(body: str, extra: str = "") -> str:
    return f"with {RUN_CTES}{extra}\n{body}"


def _quality_metrics(frame: str, cols: list[str]) -> str:
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"select source, {i} as ord, 'completeness' as category, '{c}' as metric, "
                     f"1.0 - (count(*) - count({c})) / cast(count(*) as double) as value from {frame} group by source")
    n = len(cols)
    for j, (m, cond) in enumerate([("distance", V_DIST), ("duration", V_DUR), ("pace", V_PACE), ("hr", V_HR)]):
        parts.append(f"select source, {n + j} as ord, 'validity', '{m}', count_if({cond}) / cast(count(*) as double) "
                     f"from {frame} group by source")
    parts.append(f"select source, {n + 4} as ord, 'consistency', 'hr_max_vs_avg', "
                 f"1.0 - count_if({CONFLICT}) / cast(count(*) as double) from {frame} group by source")
    parts.append(f"select source, {n + 5} as ord, 'uniqueness', 'workouts', "
                 f"1.0 - (count(*) - count(distinct ({KEY}))) / cast(count(*) as double) from {frame} group by source")
    return "\nunion all\n".join(parts)


CORE_COLS = CORE.split(", ")
STATUS = "case when value >= 0.95 then '✅' when value >= 0.85 then '⚠️' else '❌' end"
REPORT = f""",
agg as (select source, sum(n_copies) as initial, count(*) as dedup,
          count_if(not (distance_km is not null and duration_sec is not null)) as d3,
          count_if(distance_km is not null and duration_sec is not null
                   and not ({V_DIST} and {V_DUR} and {V_PACE})) as d4
        from s_dd group by source),
d7 as (select source, count_if(not {V_HR}) as d7 from s_cal group by source),
steps as (select a.source, a.initial, a.dedup, a.d3, a.d4, coalesce(d7.d7, 0) as d7
          from agg a left join d7 on a.source = d7.source),
rep as (
  select source, 1 as step_no, 'Date Imputation' as step, initial as rows_before, initial as rows_after from steps
  union all select source, 2, 'Remove Duplicates', initial, dedup from steps
  union all select source, 3, 'Validate Essentials', dedup, dedup - d3 from steps
  union all select source, 4, 'Plausibility Checks', dedup - d3, dedup - d3 - d4 from steps
  union all select source, 5, 'Heart Rate Cleaning', dedup - d3 - d4, dedup - d3 - d4 from steps
  union all select source, 6, 'Calories Imputation', dedup - d3 - d4, dedup - d3 - d4 from steps
  union all select source, 7, 'Final HR Sweep', dedup - d3 - d4, dedup - d3 - d4 - d7 from steps
  union all select source, 8, 'Finalize Types', dedup - d3 - d4 - d7, dedup - d3 - d4 - d7 from steps),
report as (select source, step_no, step, cast(rows_before as bigint) as rows_before, cast(rows_after as bigint) as rows_after,
                  cast(rows_before - rows_after as bigint) as removed,
                  coalesce((rows_before - rows_after) / nullif(cast(rows_before as double), 0), 0.0) as removal_rate
           from rep),
summary as (select source, max(rows_before) filter (where step_no = 1) as initial_rows,
                   max(rows_after) filter (where step_no = 8) as final_rows from report group by source)"""

PCT = "(case when {x} < 0 then '-' else '' end || cast(abs(cast(round_even({x} * 1000.0, 0) as bigint)) // 10 as varchar) || '.' || cast(abs(cast(round_even({x} * 1000.0, 0) as bigint)) % 10 as varchar) || '%')"


def pct(x: str) -> str:
    return PCT.format(x=x)


def oracle_queries() -> dict[str, str]:
    Q: dict[str, str] = {}
    Q["quality_by_source"] = q(
        "select source, category, metric, round(value, 9) as value from qm",
        f""",
ess as (select * from runs where distance_km is not null and duration_sec is not null),
pl as (select * from ess where {V_DIST} and {V_DUR} and {V_PACE}),
ft as (select {CORE}, duration_sec / cast(60 as double) as duration_min,
              (duration_sec / cast(60 as double)) / nullif(distance_km, 0) as pace_min_per_km from pl),
qm as ({_quality_metrics('ft', CORE_COLS + ['duration_min', 'pace_min_per_km'])})""")
    Q["range_filter"] = q(f"select {IDS}, source, {V_DIST} as valid_distance, {V_DUR} as valid_duration, "
                          f"{V_PACE} as valid_pace, {V_HR} as valid_hr from runs")
    Q["essentials_filter"] = q(f"select {IDS}, distance_km, duration_sec from runs "
                               "where distance_km is not null and duration_sec is not null")
    Q["plausibility_counts"] = q(
        f"select source, count(*) as rows_in, count_if(not {V_DIST}) as fail_distance, count_if(not {V_DUR}) as fail_duration, "
        f"count_if(not {V_PACE}) as fail_pace, count_if({V_DIST} and {V_DUR} and {V_PACE}) as rows_kept "
        "from runs where distance_km is not null and duration_sec is not null group by source")
    Q["keyword_filter"] = q(
        "select source, activity_type, count(*) as rows_in, count_if(contains(lower(activity_type), 'run')) as rows_run, "
        "count_if(contains(lower(activity_type), 'running')) as rows_running from rv group by source, activity_type")
    Q["features"] = q(f"select {IDS}, duration_sec / cast(60 as double) as duration_min, "
                      f"(duration_sec / cast(60 as double)) / nullif(distance_km, 0) as pace_min_per_km from runs")
    Q["date_impute"] = q(f"select {IDS}, coalesce(case when l_linenumber = 6 then null else date end, "
                         "export_date + interval 12 hour) as date from runs")
    Q["dedupe_first"] = q(f"select {ALL}, n_copies from s_dd", STEPS_1_4)
    Q["hr_null_errors"] = q(f"select {IDS}, case when avg_heart_rate > 0 and avg_heart_rate <= 300 then avg_heart_rate end as avg_heart_rate, "
                            "case when max_heart_rate > 0 and max_heart_rate <= 300 then max_heart_rate end as max_heart_rate from runs")
    Q["hr_consistency_masks"] = q(f"select source, count_if({INV}) as inverted, count_if({TOL}) as tolerance, "
                                  f"count_if({CONFLICT}) as conflict from runs group by source")
    Q["hr_repair"] = q(
        f"select {IDS}, case when {CONFLICT} then null else avg_heart_rate end as avg_heart_rate, "
        f"case when {CONFLICT} then null when {TOL} then avg_heart_rate else max_heart_rate end as max_heart_rate from h1",
        """,
h1 as (select * replace (case when avg_heart_rate > 0 and avg_heart_rate <= 300 then avg_heart_rate end as avg_heart_rate,
                         case when max_heart_rate > 0 and max_heart_rate <= 300 then max_heart_rate end as max_heart_rate)
       from runs)""")
    Q["hr_median_fill"] = q(f"select {IDS}, avg_heart_rate, max_heart_rate from s_hr", STEPS_1_4 + HR_STEP)
    Q["distance_bins"] = q(f"select {IDS}, distance_km, {DIST_BIN} as dist_bin from runs")
    Q["hr_quantile_bins"] = q(f"select {IDS}, avg_heart_rate, hr_bin from c1", STEPS_1_4 + HR_STEP + calories_step(True))
    Q["hr_bins_small_groups"] = q(
        f"select r.l_orderkey, r.l_linenumber, r.copy_no, r.avg_heart_rate, {hr_bin_sql('r.avg_heart_rate', 'g.e', 'g.nd')} as hr_bin "
        "from runs r left join g on r.l_orderkey = g.l_orderkey",
        """,
g as (select l_orderkey, quantile_cont(avg_heart_rate, [0, 0.25, 0.5, 0.75, 1.0]) as e, count(distinct avg_heart_rate) as nd
      from runs where l_orderkey is not null and avg_heart_rate is not null group by l_orderkey)""")
    Q["median_levels"] = q(
        "select gid, source, dist_bin, hr_bin, median from ml",
        STEPS_1_4 + HR_STEP + calories_step(True) + """,
ml as (select grouping(source, dist_bin, hr_bin) as gid, source, dist_bin, hr_bin, median(cal) as median
       from c1 where cal is not null group by grouping sets ((source, dist_bin, hr_bin), (source, dist_bin), (source), ()))""")
    Q["imputation_summary"] = q("select source, imputation_level, count(*) as rows from s_cal where calories_imputed "
                                "group by source, imputation_level", STEPS_1_4 + HR_STEP + calories_step(True))
    Q["calories_impute"] = q(f"select {IDS}, cal_filled as calories, calories_imputed, imputation_level from s_cal",
                             STEPS_1_4 + HR_STEP + calories_step(True))
    Q["winsorise"] = q(f"select {IDS}, calories from s_cal", STEPS_1_4 + HR_STEP + calories_step(True))
    Q["count_changed"] = q(
        "select source, count_if(not coalesce(cal_filled = cal_abs, false)) as changed_absolute, "
        "count_if(not coalesce(cal_abs = calories, false)) as changed_ratio from s_cal group by source",
        STEPS_1_4 + HR_STEP + calories_step(True))
    Q["hr_sweep"] = q(f"select {IDS}, avg_heart_rate from s_cal where {V_HR}", STEPS_1_4 + HR_STEP + calories_step(True))
    Q["full_pipeline"] = q("select * from featured", PIPELINE)
    Q["pipeline_run"] = q("select * from featured", PIPELINE.replace(calories_step(False), calories_step(True)))
    Q["median_global"] = q("select quantile_cont(cast(duration_sec as double), 0.5) as median, count(duration_sec) as n from runs")
    Q["table_equality"] = q("select (select count(*) from (select * from featured except all select * from featured)) as missing, "
                            "(select count(*) from (select * from featured except all select * from featured)) as extra", PIPELINE)
    Q["step_report"] = q("select * from report", PIPELINE + REPORT)
    undated = """,
runs_undated as (select * replace (case when l_linenumber = 6 then null else date end as date) from runs)"""
    audited = undated + PIPELINE.replace("from runs)", "from runs_undated)")
    figures = f"""
select source, 1 as step_no, 'dates_imputed' as figure, count_if(date is null and export_date is not null) as value from runs_undated group by source
""" + "".join(f"union all select source, {no}, '{name}', count_if({mask}) from {frame} group by source\n" for no, name, frame, mask in [
        (4, "fail_distance", "ess", f"not {V_DIST}"), (4, "fail_duration", "ess", f"not {V_DUR}"), (4, "fail_pace", "ess", f"not {V_PACE}"),
        (5, "hr_inverted", "h1", INV), (5, "hr_tolerated", "h1", TOL), (5, "hr_conflict", "h1", CONFLICT),
        (5, "avg_hr_null_before", "h2", "avg_heart_rate is null"), (5, "avg_hr_null_after", "s_hr", "avg_heart_rate is null"),
        (5, "max_hr_null_before", "h2", "max_heart_rate is null"), (5, "max_hr_null_after", "s_hr", "max_heart_rate is null"),
        (6, "calories_bad", "s_hr", "calories is null or calories <= 0"), (6, "calories_null_after", "s_cal", "cal_filled is null"),
        (6, "winsorised_absolute", "s_cal", "not coalesce(cal_filled = cal_abs, false)"),
        (6, "winsorised_ratio", "s_cal", "not coalesce(cal_abs = calories, false)")])
    ess = """,
ess as (select * from s_dd where distance_km is not null and duration_sec is not null)"""
    Q["audit_figures"] = q(figures, audited + ess)
    Q["audit_observed"] = q(figures + "union all select source, step_no, 'rows_after', rows_after from report", audited + ess + REPORT)
    Q["user_steps"] = q(
        "select step, rows_before, rows_after, rows_before - rows_after as removed, "
        "coalesce((rows_before - rows_after) / nullif(cast(rows_before as double), 0), 0.0) as removal_rate from counted",
        f""",
ten as (select * from runs where distance_km >= 10),
low as (select ten.* from ten join (select source, max(distance_km) as longest from ten group by source) m using (source) where distance_km < longest),
n as (select (select count(*) from runs) as n0, (select count(*) from ten) as n1, (select count(*) from low) as n2,
             (select count(*) from (select distinct {KEY} from low)) as n3),
counted as (
  select 'Ten kilometres' as step, n0 as rows_before, n1 as rows_after from n
  union all select 'Below the longest', n1, n2 from n
  union all select 'Distinct keys', n2, n3 from n)""")
    Q["run_summary"] = q("select source, initial_rows, final_rows, initial_rows - final_rows as total_removed, "
                         "coalesce(final_rows / nullif(cast(initial_rows as double), 0), 0.0) as retention_rate from summary",
                         PIPELINE + REPORT)
    qm_raw = f""",
qm as ({_quality_metrics('runs', CORE_COLS)})"""
    for cat in ["completeness", "validity", "consistency", "uniqueness"]:
        Q[cat] = q(f"select source, metric, round(value, 9) as value from qm where category = '{cat}'", qm_raw)
    qm_clean = PIPELINE + f""",
cleaned as (select {CORE}, calories_imputed, imputation_level from s_final),
qm as ({_quality_metrics('cleaned', CORE_COLS)})"""
    Q["quality_report"] = q(f"select source, ord, category, metric, round(value, 9) as value, {STATUS} as status from qm", qm_clean)
    Q["comparison_table"] = q(
        """select ord, Metrik,
  max(cell) filter (where source = 'alpha') as alpha,
  max(cell) filter (where source = 'beta') as beta,
  max(cell) filter (where source = 'gamma') as gamma
from cells group by ord, Metrik""",
        qm_clean + REPORT + f""",
means as (select source, avg(value) filter (where category = 'completeness') as compl,
                 avg(value) filter (where category = 'validity') as valid from qm group by source),
j as (select s.source, s.initial_rows, s.final_rows, s.initial_rows - s.final_rows as total_removed,
             coalesce(s.final_rows / nullif(cast(s.initial_rows as double), 0), 0.0) as retention_rate, m.compl, m.valid
      from summary s join means m on s.source = m.source),
cells as (
  select source, 0 as ord, 'Initial Rows' as Metrik, cast(initial_rows as varchar) as cell from j
  union all select source, 1, 'Final Rows', cast(final_rows as varchar) from j
  union all select source, 2, 'Removed Rows', cast(total_removed as varchar) from j
  union all select source, 3, 'Retention Rate (%)', {pct('retention_rate')} from j
  union all select source, 4, 'Completeness (avg)', {pct('compl')} from j
  union all select source, 5, 'Validity (avg)', {pct('valid')} from j)""")
    Q["value_counts"] = q('select activity_type, count(*) as "count" from rv where activity_type is not null group by activity_type')
    Q["unique_values"] = q("select distinct activity_type from rv")
    num = ["distance_km", "duration_sec", "calories", "avg_heart_rate", "max_heart_rate"]
    Q["describe"] = q("\nunion all\n".join(
        f"select '{c}' as column, count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, "
        f"round(min({c}), 6) as min, round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50, "
        f"round(quantile_cont({c}, 0.75), 6) as p75, round(max({c}), 6) as max from runs" for c in num))
    Q["chronological_top"] = q(
        "select * from featured order by date nulls last, case source when 'alpha' then 0 when 'beta' then 1 else 2 end, "
        "l_orderkey, l_linenumber, copy_no limit 50", PIPELINE)
    Q["union_sources"] = q(
        f"select {IDS}, source, null::double as calories from runs where source = 'alpha' "
        f"union all select {IDS}, source, calories from runs where source <> 'alpha'")
    return Q


def _split(t: str, i: int) -> str:
    return f"try_cast(string_split({t}, ':')[{i}] as double)"


def duration_sql(t: str) -> str:
    return (f"case len(string_split({t}, ':')) when 3 then {_split(t, 1)} * 3600 + {_split(t, 2)} * 60 + {_split(t, 3)} "
            f"when 2 then {_split(t, 1)} * 60 + {_split(t, 2)} when 1 then try_cast({t} as double) end")


def hms_sql(s: str) -> str:
    return (f"cast({s} // 3600 as varchar) || ':' || lpad(cast(({s} % 3600) // 60 as varchar), 2, '0') || ':' "
            f"|| lpad(cast({s} % 60 as varchar), 2, '0')")


OFFSET_RE = r"'\s*(Z|[+-]\d{2}:?\d{2})$'"


def strip_sql(t: str) -> str:
    return f"try_cast(regexp_replace(trim({t}), {OFFSET_RE}, '') as timestamp)"


def itext(x: str) -> str:
    return f"cast(cast(floor({x}) as bigint) as varchar)"


def _power_exponent(name: str, value: str, rounds: int = 4, reach: int = 5) -> str:
    """The most likely Yeo-Johnson exponent of an expression over ``runs`` by the same refined grid."""
    parts, step, centre = [f"x0 as (select {value} as x from runs where {value} is not null)"], 1.0, "select cast(0 as double) as best"
    for r in range(rounds):
        parts.append(f"g{r} as (select best + k * cast({step!r} as double) as e, k from ({centre}) c, range({-reach}, {reach + 1}) as t(k))")
        parts.append(f"""l{r} as (
  select e, k, -0.5 * count(*) * ln(var_pop(case when x >= 0 then case when e = 0 then ln(1 + x) else (pow(x + 1, e) - 1) / e end
      else case when e = 2 then -ln(1 - x) else -(pow(1 - x, 2 - e) - 1) / (2 - e) end end))
    + (e - 1) * sum(sign(x) * ln(1 + abs(x))) as likely from x0, g{r} group by e, k)""")
        centre = f"select e as best from l{r} order by likely desc, k limit 1"
        step /= reach
    return f"(with {', '.join(parts)} select '{name}' as \"column\", round(best, 6) as exponent from ({centre}) c)"


def oracle_queries_2() -> dict[str, str]:
    Q: dict[str, str] = {}
    Q["duration_parse"] = f"""with li as (select l_orderkey, l_linenumber,
    cast(l_quantity as bigint) * 60 + (l_orderkey * 7 + l_partkey) % 900 as s from lineitem),
t as (select l_orderkey, l_linenumber, case l_linenumber
    when 1 then {hms_sql('s')} || case when l_orderkey % 2 = 0 then '.7' else '' end
    when 2 then cast(s // 60 as varchar) || ':' || lpad(cast(s % 60 as varchar), 2, '0')
    when 3 then cast(s as varchar) || '.25'
    when 4 then 'abc' when 5 then '1:2:3:4' when 6 then '' else null end as duration from li)
select l_orderkey, l_linenumber, duration, {duration_sql('duration')} as duration_sec from t"""
    Q["eu_date_parse"] = """with li as (select l_orderkey, l_linenumber,
    l_shipdate + to_minutes(cast(l_orderkey % 1440 as integer)) as ts from lineitem),
t as (select l_orderkey, l_linenumber, case l_linenumber
    when 1 then strftime(ts, '%d.%m.%Y %H:%M') when 2 then strftime(ts, '%d.%m.%Y %H:%M')
    when 3 then strftime(ts, '%d.%m.%Y %H:%M')
    when 4 then cast(day(ts) as varchar) || '.' || cast(month(ts) as varchar) || '.' || cast(year(ts) as varchar)
                || ' ' || cast(hour(ts) as varchar) || ':' || lpad(cast(minute(ts) as varchar), 2, '0')
    when 5 then '31.02.' || cast(year(ts) as varchar) || ' 10:00'
    when 6 then strftime(ts, '%Y-%m-%d %H:%M') else 'garbage' end as date_text from li)
select l_orderkey, l_linenumber, date_text, try_strptime(date_text, '%d.%m.%Y %H:%M') as date from t"""
    Q["offset_strip"] = f"""with li as (select l_orderkey, l_linenumber,
    l_shipdate + to_seconds(cast(l_orderkey % 86400 as bigint)) as ts from lineitem),
t as (select l_orderkey, l_linenumber, case l_linenumber
    when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S') || ' +0200' when 2 then strftime(ts, '%Y-%m-%d %H:%M:%S') || ' -0500'
    when 3 then strftime(ts, '%Y-%m-%d %H:%M:%S') || '+05:30' when 4 then strftime(ts, '%Y-%m-%d %H:%M:%S') || 'Z'
    when 5 then strftime(ts, '%Y-%m-%d %H:%M:%S') when 6 then 'not a date' else null end as date_text from li)
select l_orderkey, l_linenumber, date_text, {strip_sql('date_text')} as date from t"""
    Q["numeric_coerce"] = """with t as (select l_orderkey, l_linenumber, case l_linenumber
    when 1 then cast(l_partkey as varchar) when 2 then cast(l_partkey as varchar) || '.5'
    when 3 then '1,' || lpad(cast(l_suppkey % 1000 as varchar), 3, '0') when 4 then '--' when 5 then ''
    when 6 then 'nan' else null end as value_text from lineitem)
select l_orderkey, l_linenumber, value_text,
  case when isnan(try_cast(value_text as double)) then null else try_cast(value_text as double) end as value from t"""
    Q["schema_reduce"] = q("select date, activity_type, distance_km, duration_sec as duration, cast(null as double) as calories, "
                           "avg_heart_rate, max_heart_rate, source, export_date from rv")
    Q["unit_heuristic_max"] = q(
        f"select x.l_orderkey, x.l_linenumber, x.copy_no, case when coalesce(m.sc, false) then x.distance_km / cast(1000 as double) "
        "else x.distance_km end as distance_km from x left join m on x.source is not distinct from m.source",
        f""",
x as (select {IDS}, source, case when source = 'gamma' then distance_km * 1000 else distance_km end as distance_km from runs),
m as (select source, max(distance_km) > 200 as sc from x group by source)""")
    Q["unit_heuristic_median"] = q(
        "select y.l_orderkey, y.l_linenumber, y.copy_no, y.duration_sec, case when coalesce(mx.sc, false) "
        "then y.distance_km / cast(1000 as double) else y.distance_km end as distance_km "
        "from y left join mx on y.source is not distinct from mx.source",
        f""",
x as (select {IDS}, source, case when source = 'gamma' then distance_km * 1000 else distance_km end as distance_km,
             case when source = 'beta' then duration_sec / 60 else duration_sec end as duration_sec from runs),
md as (select source, median(duration_sec) between 10 and 200 as sc from x group by source),
y as (select x.l_orderkey, x.l_linenumber, x.copy_no, x.source, x.distance_km,
             case when coalesce(md.sc, false) then x.duration_sec * 60 else x.duration_sec end as duration_sec
      from x left join md on x.source is not distinct from md.source),
mx as (select source, max(distance_km) > 200 as sc from y group by source)""")
    garmin = f""",
gr as (select activity_type,
         strftime(date + to_minutes(cast(l_orderkey % 1440 as integer)), '%d.%m.%Y %H:%M') as date_t,
         case when source = 'gamma' then {itext('distance_km * 1000')} else {itext('distance_km')} end as dist_t,
         case when calories is null then '--' else {itext('calories')} end as cal_t,
         case when duration_sec is null then null else {hms_sql('cast(floor(duration_sec) as bigint)')} end as dur_t,
         {itext('avg_heart_rate')} as avg_t, {itext('max_heart_rate')} as max_t,
         source, strftime(export_date, '%Y-%m-%d') as exp_t, {IDS} from rv),
gt as (select try_strptime(date_t, '%d.%m.%Y %H:%M') as date, activity_type, try_cast(dist_t as double) as distance_km,
              {duration_sql('dur_t')} as duration_sec, try_cast(cal_t as double) as calories,
              try_cast(avg_t as double) as avg_heart_rate, try_cast(max_t as double) as max_heart_rate, source,
              try_cast(exp_t as timestamp) as export_date, {IDS}
       from gr where contains(lower(activity_type), 'run')),
mx as (select source, max(distance_km) > 200 as sc from gt group by source)"""
    Q["garmin_typing"] = q(
        "select gt.date, gt.activity_type, case when coalesce(mx.sc, false) then gt.distance_km / cast(1000 as double) "
        "else gt.distance_km end as distance_km, gt.duration_sec, gt.calories, gt.avg_heart_rate, gt.max_heart_rate, "
        "gt.source, gt.export_date, gt.l_orderkey, gt.l_linenumber, gt.copy_no from gt left join mx on gt.source is not distinct from mx.source",
        garmin)
    apple = f""",
ar as (select strftime(date + to_seconds(cast(l_orderkey % 86400 as bigint)), '%Y-%m-%d %H:%M:%S')
              || case when l_linenumber % 2 = 0 then ' +0200' else ' +0100' end as date_t,
         replace(activity_type, ' ', '') as activity_type,
         coalesce(case when source = 'gamma' then {itext('distance_km * 1000')} else {itext('distance_km')} end, '') as dist_t,
         coalesce(case when source = 'beta' then cast(cast(floor(duration_sec) as bigint) // 60 as varchar) || '.5'
                       else {itext('duration_sec')} end, '') as dur_t,
         coalesce({itext('calories')}, '') as cal_t, coalesce({itext('avg_heart_rate')}, '') as avg_t,
         coalesce({itext('max_heart_rate')}, '') as max_t, source, strftime(export_date, '%Y-%m-%d') as exp_t, {IDS} from rv),
at1 as (select {strip_sql('date_t')} as date, activity_type, try_cast(dist_t as double) as distance_km,
              try_cast(dur_t as double) as duration_sec, try_cast(cal_t as double) as calories,
              try_cast(avg_t as double) as avg_heart_rate, try_cast(max_t as double) as max_heart_rate, source,
              try_cast(exp_t as timestamp) as export_date, {IDS}
       from ar where contains(lower(activity_type), 'running')),
md as (select source, median(duration_sec) between 10 and 200 as sc from at1 group by source),
a2 as (select at1.date, at1.activity_type, at1.distance_km,
              case when coalesce(md.sc, false) then at1.duration_sec * 60 else at1.duration_sec end as duration_sec,
              at1.calories, at1.avg_heart_rate, at1.max_heart_rate, at1.source, at1.export_date, at1.l_orderkey, at1.l_linenumber, at1.copy_no
       from at1 left join md on at1.source is not distinct from md.source),
mx as (select source, max(distance_km) > 200 as sc from a2 group by source)"""
    Q["apple_typing"] = q(
        "select a2.date, a2.activity_type, case when coalesce(mx.sc, false) then a2.distance_km / cast(1000 as double) "
        "else a2.distance_km end as distance_km, a2.duration_sec, a2.calories, a2.avg_heart_rate, a2.max_heart_rate, "
        "a2.source, a2.export_date, a2.l_orderkey, a2.l_linenumber, a2.copy_no from a2 left join mx on a2.source is not distinct from mx.source",
        apple)
    Q["garmin_csv_import"] = q(
        "select activity_type, date_t as date, dist_t as distance_km, cal_t as calories, dur_t as duration, "
        "avg_t as avg_heart_rate, max_t as max_heart_rate, 'Lauf ' || source || ' Zürich' as Title, "
        "cast(l_orderkey as varchar) as \"Order\", cast(l_linenumber as varchar) as Line, "
        "'garmin' as source, exp_t as export_date, case when copy_no = 1 then 'false' end as Favorite from gr", garmin)
    Q["csv_quoted_breaks"] = Q["garmin_csv_import"].replace("' Zürich'", "' \"Zürich\";' || chr(10) || 'Runde 2'")
    e8 = f""",
g8 as (select activity_type,
         strftime(date + to_minutes(cast(l_orderkey % 1440 as integer)), '%d.%m.%Y %H:%M') as date_t,
         {itext('distance_km')} as dist_t,
         case when calories is null then '--' else {itext('calories')} end as cal_t,
         case when duration_sec is null then null else {hms_sql('cast(floor(duration_sec) as bigint)')} end as dur_t,
         {itext('avg_heart_rate')} as avg_t, {itext('max_heart_rate')} as max_t,
         strftime(export_date, '%Y-%m-%d') as exp_t, {IDS} from rv where source <> 'gamma'),
g8t as (select try_strptime(date_t, '%d.%m.%Y %H:%M') as date, activity_type, try_cast(dist_t as double) as distance_km,
               {duration_sql('dur_t')} as duration_sec, try_cast(cal_t as double) as calories,
               try_cast(avg_t as double) as avg_heart_rate, try_cast(max_t as double) as max_heart_rate, 'garmin' as source,
               try_cast(exp_t as timestamp) as export_date, {IDS}
        from g8 where contains(lower(activity_type), 'run')),
g8m as (select max(distance_km) > 200 as sc from g8t),
g8u as (select g8t.* replace (case when (select coalesce(sc, false) from g8m) then distance_km / cast(1000 as double)
                                   else distance_km end as distance_km) from g8t),
a8 as (select replace(activity_type, ' ', '') as activity_type,
         strftime(date + to_seconds(cast(l_orderkey % 86400 as bigint)), '%Y-%m-%d %H:%M:%S') || ' +0200' as date_t,
         coalesce(cast(cast(floor(duration_sec) as bigint) // 60 as varchar) || '.5', '') as dur_t,
         coalesce(case when l_linenumber = 2 then cast(cast(floor(distance_km) as bigint) + 1 as varchar)
                       else {itext('distance_km')} end, '') as dist_t,
         coalesce({itext('calories')}, '') as cal_t, coalesce({itext('avg_heart_rate')}, '') as avg_t,
         case when avg_heart_rate is null then '' else coalesce({itext('max_heart_rate')}, '') end as max_t,
         strftime(export_date, '%Y-%m-%d') as exp_t, {IDS} from rv where source = 'gamma'),
a8t as (select {strip_sql('date_t')} as date, activity_type, try_cast(dist_t as double) as distance_km,
               try_cast(dur_t as double) as duration_sec, try_cast(cal_t as double) as calories,
               try_cast(avg_t as double) as avg_heart_rate, try_cast(max_t as double) as max_heart_rate, 'apple' as source,
               try_cast(exp_t as timestamp) as export_date, {IDS}
        from a8 where contains(lower(activity_type), 'running')),
a8s as (select coalesce(median(duration_sec) between 10 and 200, false) as sm, coalesce(max(distance_km) > 200, false) as sd from a8t),
a8u as (select a8t.* replace (
          case when (select sd from a8s) then distance_km / cast(1000 as double) else distance_km end as distance_km,
          case when (select sm from a8s) then duration_sec * 60 else duration_sec end as duration_sec) from a8t),
runs8 as (select {ALL} from g8u union all select {ALL} from a8u)"""
    Q["run_pipeline_exports"] = q(
        f"select {CORE}, calories_imputed, imputation_level, duration_min, pace_min_per_km from featured",
        e8 + PIPELINE.replace("from runs)", "from runs8)"))
    other = """,
other as (select * from runs where l_orderkey % 101 <> 0 union all select * from runs where l_orderkey % 97 = 0)"""
    Q["table_difference"] = q("select (select count(*) from (select * from runs except all select * from other)) as missing, "
                              "(select count(*) from (select * from other except all select * from runs)) as extra", other)
    Q["output_versions"] = q("select * from runs where distance_km >= 10")
    ratio = "case when {x} is not null then coalesce(({x} - {c}) / nullif({s}, 0), 0.0) end"
    Q["rescale"] = q(
        f"select {IDS}, round({ratio.format(x='distance_km', c='dm', s='ds')}, 6) as distance_km_std, "
        f"round({ratio.format(x='calories', c='cm', s='cs')}, 6) as calories_std, "
        f"round({ratio.format(x='avg_heart_rate', c='lo', s='(hi - lo)')}, 6) as avg_heart_rate_01 "
        "from runs join st using (source), (select min(avg_heart_rate) as lo, max(avg_heart_rate) as hi from runs) w",
        """,
st as (select source, avg(distance_km) as dm, stddev_pop(distance_km) as ds, avg(calories) as cm, stddev_pop(calories) as cs from runs group by source)""")
    Q["power_exponents"] = q(f"{_power_exponent('distance_km', 'distance_km')} union all "
                             f"{_power_exponent('difference', '(avg_heart_rate - max_heart_rate)')}")
    Q["pace_moving_average"] = q(
        "select source, date, cast(floor(sum(s) over w / nullif(cast(sum(n) over w as double), 0) * 1e6 + 0.29) as bigint) as moving_average, "
        "cast(sum(n) over w as bigint) as rows_in_span from m "
        "window w as (partition by source order by date range between interval '28 days' - interval '1 microsecond' preceding and current row)",
        f""",
m as (select source, date, sum({PACE}) as s, count({PACE}) as n from runs group by source, date)""")
    Q["parquet_round_trip"] = q("select * from runs")
    Q["csv_round_trip"] = q("select * from runs")
    xml = f""",
xw as (select 'apple' as source, strftime(export_date, '%Y-%m-%d') as export_date, replace(activity_type, ' ', '') as activity_type,
         strftime(date + to_seconds(cast(l_orderkey % 86400 as bigint)), '%Y-%m-%d %H:%M:%S') || ' +0200' as date,
         coalesce(cast(cast(floor(duration_sec) as bigint) // 60 as varchar) || '.5', '') as duration,
         coalesce(case when l_linenumber = 2 then cast(cast(floor(distance_km) as bigint) + 1 as varchar)
                       else {itext('distance_km')} end, '') as distance,
         coalesce({itext('calories')}, '') as calories,
         coalesce({itext('avg_heart_rate')}, '') as avg_heart_rate,
         case when avg_heart_rate is null then '' else coalesce({itext('max_heart_rate')}, '') end as max_heart_rate,
         cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) || '-' || cast(copy_no as varchar) as workout_id
       from rv)"""
    Q["xml_workouts"] = q("select * from xw", xml)
    Q["xml_single_file"] = Q["xml_workouts"]
    Q["import_statistics"] = q("select count(*) as workouts, count_if(distance <> '') as with_distance, "
                               "count_if(duration <> '') as with_duration from xw", xml)
    mi, kj = "cast('1.609344' as double)", f"cast('{1 / 4.184!r}' as double)"
    Q["declared_units"] = q(
        "select workout_id, distance * case distance_unit when 'km' then 1 when 'm' then cast('0.001' as double) when 'mi' then " + mi + " else "
        "(case when (select max(distance) > 200 from du where distance_unit is null) then cast('0.001' as double) else 1 end) end as distance_km, "
        "duration * case duration_unit when 's' then 1 when 'min' then 60 when 'hr' then 3600 else "
        "(case when (select median(duration) between 10 and 200 from du where duration_unit is null) then 60 else 1 end) end as duration_sec, "
        "calories * case when kj then " + kj + " else 1 end as calories from du", xml + """,
du as (select workout_id, try_cast(distance as double) as distance, try_cast(duration as double) as duration, try_cast(calories as double) as calories,
         case when split_part(workout_id, '-', 2) = '2' then 'm' else
           case cast(split_part(workout_id, '-', 1) as bigint) % 4 when 0 then 'km' when 1 then 'mi' end end as distance_unit,
         case split_part(workout_id, '-', 2) when '1' then 's' when '2' then 'min' when '3' then 'hr' end as duration_unit,
         cast(split_part(workout_id, '-', 1) as bigint) % 3 = 1 as kj from xw)""")
    routes = """,
ev as (select *, case user_id % 3 when 0 then 'alpha' when 1 then 'beta' else 'gamma' end as source, cast(ts as date) as d,
         case user_id % 3 when 0 then 120 when 1 then -210 else 345 end as minutes from events where ts is not null and user_id is not null),
st as (select source, d, min(ts) + to_minutes(cast(any_value(minutes) as integer)) as begin, day(d) % 10 = 0 as late from ev group by source, d),
rp as (select ev.source, cast('2025-08-22' as timestamp) as export_date,
         date_trunc('minute', case when late then begin + interval '7 minutes' else begin end) as named_start, ts as time,
         (user_id % 18001) / cast(100 as double) - 90 as lat, (event_id % 36001) / cast(100 as double) - 180 as lon, value as elevation,
         case when event_id % 5 <> 0 then (event_id % 700) / cast(100 as double) end as speed,
         case when not late then ts + to_minutes(cast(minutes as integer)) end as local_time
       from ev join st on ev.source = st.source and ev.d = st.d)"""
    Q["route_points"] = q("select * from rp", routes)
    Q["route_workouts"] = q(
        f"select {IDS}, wk.source, count(*) as n_points, min(local_time) as first_point, max(local_time) as last_point, "
        "max(elevation) as highest, count(speed) as with_speed from wk join rp on wk.source = rp.source and local_time >= wk.begin and local_time < wk.stop "
        f"group by {IDS}, wk.source", routes + f""",
wk0 as (select {IDS}, source, timestamp '2024-01-01' + to_seconds((l_orderkey * 977 + l_linenumber * 7919 + copy_no * 13) % 2592000) as begin,
          floor(duration_sec / 60) as secs from rv),
wk as (select *, begin + to_seconds(secs) as stop from wk0)""")
    return Q


def _bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in a BIGINT cast (DuckDB returns HUGEINT, Spark BIGINT)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "cast(" + sql[j:k] + " as bigint)")
        i = k


def all_oracle_queries() -> dict[str, str]:
    return {k: _bigint_counts(v) for k, v in {**oracle_queries(), **oracle_queries_2()}.items()}
