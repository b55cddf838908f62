"""SQL that states the result of each registered query over the same tables."""

from __future__ import annotations

_WEATHER = """weather as (
  select cast(l_shipdate as date) as date, avg(l_quantity) as max_temp,
         max(l_extendedprice) as precipitation
  from lineitem group by 1)"""

_INCIDENTS = f"""{_WEATHER},
incidents as (
  select cast(o_orderdate as date) as date, cast(o_orderkey as varchar) as id,
         o_orderpriority as city, cast(floor(o_totalprice / 1000) as int) as reported_incidents,
         max_temp, precipitation,
         cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as int)
           as congestion_level_num
  from orders join weather on cast(o_orderdate as date) = weather.date)"""

_EXTRACT = """
  select cast(o_orderkey as varchar) as id, o_orderpriority as city,
         cast(cast(floor(o_totalprice / 1000) as bigint) as varchar) as reported_incidents,
         o_orderstatus as congestion_level, strftime(o_orderdate, '%Y-%m-%d') as incident_date
  from orders"""


def _with(body: str) -> str:
    return f"with {_INCIDENTS}\n{body}"


def _bin(x: str, lo: str, hi: str, bins: int = 8) -> str:
    terms = " + ".join(
        f"case when {x} > {i} * (({hi} - {lo}) / {bins}.0::double) + {lo} then 1 else 0 end"
        for i in range(1, bins)
    )
    return f"cast(case when {x} is not null then {terms} end as int)"


def _bars(column: str) -> str:
    return _with(
        f""", span as (select min({column}) as lo, max({column}) as hi from incidents),
binned as (
  select {_bin(column, 'lo', 'hi')} as bin, lo, hi, congestion_level_num, reported_incidents
  from incidents cross join span)
select bin,
       round(case when bin = 0 then lo - (hi - lo) * 0.001::double
                  else bin * ((hi - lo) / 8.0::double) + lo end, 6) as lower,
       round((bin + 1) * ((hi - lo) / 8.0::double) + lo, 6) as upper,
       congestion_level_num, round(avg(reported_incidents), 6) as mean_reported_incidents,
       count(*) as n_rows
from binned group by bin, lo, hi, congestion_level_num"""
    )


_VARIABLES = ("reported_incidents", "max_temp", "precipitation", "congestion_level_num")

_LEVEL_STATS = """
select congestion_level_num, count(*) as days_count, round(avg(reported_incidents), 6) as avg_incidents,
       round(avg(max_temp), 6) as avg_temp, round(avg(precipitation), 6) as avg_precip
from incidents group by congestion_level_num order by congestion_level_num"""

_SCORED = """, scored as (
  select reported_incidents as y, 100.0::double + 10.0::double * congestion_level_num as p1,
         240.0::double + 0.5::double * max_temp as p2 from incidents),
report as (
  select 'Random Forest' as model, sqrt(avg((y - p1) * (y - p1))) as rmse, avg(abs(y - p1)) as mae, 1 as rank
  from scored
  union all
  select 'Gradient Boosted Trees', sqrt(avg((y - p2) * (y - p2))), avg(abs(y - p2)), 2 from scored)"""

# The folds of a search: rows, and per fold the totals by level of all other rows.
_FOLDS = """, folds as (
  select cast(id as bigint) % 5 as fold, congestion_level_num as level, cast(reported_incidents as double) as y
  from incidents),
totals as (
  select k.fold, level, count(*) as n, sum(y) as total
  from folds join (select unnest(range(5)) as fold) k on folds.fold <> k.fold group by k.fold, level),
by_levels as (
  select f.fold, sqrt(avg((y - total / n) * (y - total / n))) as rmse
  from folds f join totals t on f.fold = t.fold and f.level = t.level group by f.fold)"""


def _split(name: str, totals: str) -> str:
    """A tree of one split of the levels, that with the least squared error: mean per level."""
    return f"""{name}_sides as (
  select t.fold, cut, t.level <= cut as below, sum(n) as n, sum(total) as total
  from {totals} t, (select unnest([1, 2]) as cut) group by 1, 2, 3),
{name}_cut as (
  select fold, arg_max(cut, gain) as cut
  from (select fold, cut, sum(total * total / n) as gain from {name}_sides group by fold, cut) group by fold),
{name} as (
  select t.fold, t.level, t.n, t.total, s.total / s.n as mean
  from {totals} t join {name}_cut c on c.fold = t.fold
  join {name}_sides s on s.fold = t.fold and s.cut = c.cut and s.below = (t.level <= c.cut))"""


_SCENARIO = """
select strftime(date '2025-03-01' + cast(c_custkey % 60 as int), '%Y-%m-%d') as date,
       c_custkey + 1 as id, c_mktsegment as city
from customer"""

_SCORED_BY_LEVEL = _with(
    """, means as (
  select congestion_level_num as level, avg(reported_incidents) as mean from incidents group by 1)
select strftime(date, '%Y-%m-%d') as date, cast(id as bigint) as id, city, max_temp, precipitation,
       congestion_level_num, cast(round(mean) as int) as predicted_incidents
from incidents join means on congestion_level_num = level"""
)

SQL = {
    "unpack_parallel_arrays": f"with {_WEATHER} select * from weather",
    "etl_trusted": _with("select * from incidents"),
    "raw_level_stats": _with(_LEVEL_STATS),
    "skew_sliced_join": _with("select * from incidents"),
    "stage_row_counts": _with(
        """select 'weather_documents' as stage, count(distinct year(date)) as n_rows from weather
union all select 'weather_days', count(*) from weather
union all select 'incident_rows', count(*) from orders
union all select 'joined_rows', count(*) from incidents"""
    ),
    "csv_roundtrip": _EXTRACT,
    "csv_text_roundtrip": """
select cast(conv_id as varchar) as conv_id, cast(turn as varchar) as turn, role,
       md5('  ' || text || ' ') as text_md5 from conversations""",
    "hot_keys_join": """
with totals as (select l_returnflag, sum(l_quantity) as total from lineitem group by 1),
shares as (
  select l_orderkey, l_linenumber, l_returnflag, round(l_quantity / total, 9) as share
  from lineitem join totals using (l_returnflag))
select side as hot_side, shares.* from shares cross join (values ('facts'), ('other')) sides(side)""",
    "ordinal_encode": """
select event_id, cast(case event_type when 'click' then 1 when 'view' then 2 else 3 end as int) as code
from events""",
    "safe_casts": """
select o_orderkey,
       cast(case o_orderstatus when 'F' then o_orderkey when 'O' then o_custkey end as int) as as_int,
       case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as as_date
from orders""",
    "rename_select": _with(
        """select id, reported_incidents as label, cast(congestion_level_num as varchar) as level_text,
       congestion_level_num, date from incidents"""
    ),
    "global_stats": _with(
        """select cast(min(reported_incidents) as int) as min_incidents,
       cast(max(reported_incidents) as int) as max_incidents,
       round(avg(reported_incidents), 6) as avg_incidents,
       round(stddev_samp(reported_incidents), 6) as std_incidents,
       round(min(max_temp), 6) as min_temp, round(max(max_temp), 6) as max_temp,
       round(avg(max_temp), 6) as avg_temp, min(precipitation) as min_precip,
       max(precipitation) as max_precip, round(avg(precipitation), 6) as avg_precip
from incidents"""
    ),
    "level_stats": _with(_LEVEL_STATS),
    "correlations": _with(
        """select round(corr(reported_incidents, max_temp), 6) as temp_corr,
       round(corr(reported_incidents, precipitation), 6) as precip_corr,
       round(corr(reported_incidents, congestion_level_num), 6) as congestion_corr
from incidents"""
    ),
    "corr_matrix": _with(
        "\nunion all ".join(
            f"select '{a}' as row_var, '{b}' as col_var, round(corr({a}, {b}), 6) as r from incidents"
            for a in _VARIABLES
            for b in _VARIABLES
        )
    ),
    "constant_correlation": """
with v as (select case when toxic = 0 then cast(quality as double) end as quality,
                  cast(doc_id as double) as doc from labels)
select 'quality' as row_var, 'quality' as col_var, round(corr(quality, quality), 6) as r from v
union all select 'quality', 'doc', round(corr(quality, doc), 6) from v
union all select 'doc', 'quality', round(corr(quality, doc), 6) from v
union all select 'doc', 'doc', round(corr(doc, doc), 6) from v
union all select a, b, null from (values ('constant', 'constant'), ('constant', 'doc'),
  ('constant', 'quality'), ('doc', 'constant'), ('quality', 'constant')) t(a, b)""",
    "temp_view_sql": _with(
        """select city, congestion_level_num, count(*) as days_count,
       cast(sum(reported_incidents) as bigint) as total_incidents,
       min(date) as first_day, max(date) as last_day
from incidents group by city, congestion_level_num"""
    ),
    "equal_width_bins": f"""
with span as (select min(value) as lo, max(value) as hi from events)
select event_id, {_bin('value', 'lo', 'hi')} as bin from events cross join span""",
    "binned_mean_temp": _bars("max_temp"),
    "binned_mean_precip": _bars("precipitation"),
    "level_totals": _with(
        """select cast(congestion_level_num as varchar) as congestion_level_str,
       cast(sum(reported_incidents) as bigint) as total_incidents
from incidents group by congestion_level_num"""
    ),
    "chart_bars_one_pass": _with(
        f""", span as (select min(max_temp) as t0, max(max_temp) as t1,
                  min(precipitation) as p0, max(precipitation) as p1 from incidents),
binned as (select {_bin('max_temp', 't0', 't1')} as tb, {_bin('precipitation', 'p0', 'p1')} as pb,
                  congestion_level_num as hue, reported_incidents as y
           from incidents cross join span)
select 'temp_incidents_bar' as chart, cast(tb as varchar) as x, hue, round(avg(y), 6) as y
from binned group by tb, hue
union all
select 'precip_incidents_bar', cast(pb as varchar), hue, round(avg(y), 6) from binned group by pb, hue
union all
select 'congestion_incidents_bar', cast(hue as varchar), null, cast(sum(y) as double)
from binned group by hue"""
    ),
    "statistics_from_cube": _with(
        """select 'level_' || cast(congestion_level_num as varchar) as name,
       round(avg(precipitation), 6) as value, count(*) as days_count
from incidents group by congestion_level_num
union all select 'overall', round(stddev_samp(reported_incidents), 6), null from incidents
union all select 'temp_corr', round(corr(reported_incidents, max_temp), 6), null from incidents"""
    ),
    "artifact_catalog": """
select round(sum(length(cast(o_orderkey as varchar)) + 1 + length(o_orderpriority) + 1) / 1024.0::double, 6)
  as total_kb from orders""",
    "artifact_fields": """
select event_id, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') as artifact_id,
       's3://bucket/refined/' || event_type as location, user_id / 1024.0::double as size_kb
from events""",
    "chart_metadata_rows": """
select kind || '_20250301_123005' as visualization_id,
       's3://bucket/20250301_123005/' || key as s3_location,
       (select count(*) from orders) > 0 as has_size, cast(width as int) as width,
       cast(height as int) as height, temperature, correlation, plot_type, bins
from (values
  ('temp_incidents_bar', 'temp_vs_incidents', 1200, 600, true, false, 'barplot', '8'),
  ('precip_incidents_bar', 'precip_vs_incidents', 1200, 600, false, false, 'barplot', '8'),
  ('correlation_heatmap', 'cor_matrix', 800, 600, true, true, 'heatmap', null),
  ('congestion_incidents_bar', 'con_vs_in', 800, 500, false, false, 'barplot', null))
  t(kind, key, width, height, temperature, correlation, plot_type, bins)""",
    "parquet_struct_map": """
select c_custkey, cast(c_nationkey * 2 as int) as height, c_mktsegment as segment,
       cast(null as varchar) as bins from customer""",
    "append_sink": """
select c_mktsegment as segment, cast(2 * count(*) as bigint) as n_rows,
       cast(2 * sum(c_nationkey) as bigint) as width
from customer group by c_mktsegment""",
    "external_table_subset": "select o_orderstatus, o_custkey, o_orderkey from orders",
    "named_dataset": _with(
        """select 'level_' || cast(congestion_level_num as varchar) as name,
       round(avg(reported_incidents), 6) as value from incidents group by congestion_level_num
union all select 'overall', round(avg(reported_incidents), 6) from incidents
union all select 'precip_corr', round(corr(reported_incidents, precipitation), 6) from incidents"""
    ),
    "json_records": """
select cast(to_json({'o_orderkey': cast(o_orderkey as varchar), 'o_custkey': cast(o_custkey as varchar),
  'o_orderstatus': case when o_orderstatus <> 'P' then o_orderstatus else '' end,
  'o_orderpriority': o_orderpriority,
  'day': strftime(o_orderdate, '%Y-%m-%d')}) as varchar) as record
from orders""",
    "nested_records": """
select cast(to_json({'c_custkey': cast(c_custkey as varchar),
  'dimensions': '{width=' || c_nationkey || ', height=' || (c_nationkey * 2) || '}',
  'parameters': '{segment=' || c_mktsegment || ', name=' || c_name || '}',
  'tags': '[' || c_custkey || ', null]'}) as varchar) as record
from customer""",
    "features_array": _with(
        """select id, round(max_temp, 6) as f0, round(precipitation, 6) as f1,
       cast(congestion_level_num as double) as f2 from incidents"""
    ),
    "round_to_int": """
select o_orderkey, cast(round(o_totalprice) as int) as price,
       cast(round((o_custkey % 1000000) / -2.0::double) as int) as negative_half from orders""",
    "stable_split": """
select case when o_orderkey % 10 < 7 then 'train' else 'test' end as part, count(*) as n_rows,
       cast(sum(o_custkey) as bigint) as key_sum
from orders group by 1""",
    "random_split": """
select count(*) as n_rows, cast(0 as bigint) as in_both, true as about_seventy from orders""",
    "regression_metrics": _with(
        f"{_SCORED} select model, round(rmse, 6) as rmse, round(mae, 6) as mae from report"
    ),
    "best_model": _with(
        f"{_SCORED} select model as best_model from report order by rmse, rank desc limit 1"
    ),
    "eval_report": _with(
        f"""{_SCORED}
select model, round(rmse, 6) as rmse, round(mae, 6) as mae, cast(null as varchar) as best_model
from report
union all
select 'Best Model', null, null, (select model from report order by rmse, rank desc limit 1)"""
    ),
    "report_time": "select 3 as n_rows, 1 as n_times, 0 as n_missing",
    "scenario_spine": _SCENARIO,
    "rf_cv_levels": _with(
        f"""{_FOLDS}
select trees::double as "numTrees", depth::double as "maxDepth", least::double as "minInstancesPerNode",
       round(rmse, 6) as avg_rmse
from (select avg(rmse) as rmse from by_levels), (select unnest([50, 100, 150]) as trees),
     (select unnest([5, 10, 15]) as depth), (select unnest([1, 5, 10]) as least)"""
    ),
    "gbt_cv_levels": _with(
        f"""{_FOLDS}
select rounds::double as "maxIter", depth::double as "maxDepth", step::double as "stepSize",
       round(rmse, 6) as avg_rmse
from (select avg(rmse) as rmse from by_levels), (select unnest([50, 100]) as rounds),
     (select unnest([3, 5, 7]) as depth), (select unnest([0.01, 0.1]) as step)"""
    ),
    "boosting_rounds": _with(
        f"""{_FOLDS},
{_split('one', 'totals')},
rest as (select fold, level, n, 2 * (total - n * mean) as total from one),
{_split('two', 'rest')},
errors as (
  select f.fold, one.mean - y as first, one.mean + 0.1::double * two.mean - y as second
  from folds f join one on one.fold = f.fold and one.level = f.level
  join two on two.fold = f.fold and two.level = f.level),
by_fold as (
  select fold, sqrt(avg(first * first)) as first, sqrt(avg(second * second)) as second from errors group by fold)
select unnest([1.0::double, 2.0]) as "maxIter", 1.0::double as "maxDepth", 0.1::double as "stepSize",
       unnest([round(avg(first), 6), round(avg(second), 6)]) as avg_rmse from by_fold"""
    ),
    "stored_model_scores": _with(
        """, means as (
  select congestion_level_num as level, cast(round(avg(reported_incidents)) as int) as mean from incidents group by 1)
select id, mean as rf_incidents, mean as gbt_incidents from incidents join means on congestion_level_num = level"""
    ),
    "score_rf_levels": _SCORED_BY_LEVEL,
    "score_gbt_levels": _SCORED_BY_LEVEL,
    "holdout_report_levels": _with(
        """, means as (
  select congestion_level_num as level, avg(reported_incidents) as mean from incidents
  where cast(id as bigint) % 10 < 7 group by 1),
errors as (
  select reported_incidents - mean as e1,
         reported_incidents - (select avg(reported_incidents) from incidents
                               where cast(id as bigint) % 10 < 7) as e2
  from incidents join means on congestion_level_num = level where cast(id as bigint) % 10 >= 7),
report as (
  select 'Random Forest' as model, sqrt(avg(e1 * e1)) as rmse, avg(abs(e1)) as mae, 1 as rank from errors
  union all
  select 'Gradient Boosted Trees', sqrt(avg(e2 * e2)), avg(abs(e2)), 2 from errors)
select model, round(rmse, 6) as rmse, round(mae, 6) as mae, cast(null as varchar) as best_model
from report
union all
select 'Best Model', null, null, (select model from report order by rmse, rank desc limit 1)"""
    ),
    "holdout_side_by_side": _with(
        """select count(*) as n_rows, count(*) as scored_by_both,
       cast(sum(reported_incidents) as bigint) as label_sum from incidents"""
    ),
    "daily_run": _with(
        """, found as (
  select 'global-stats' as dataset, 'all' as item, unnest(['min_incidents', 'max_incidents', 'avg_incidents',
    'std_incidents', 'min_temp', 'max_temp', 'avg_temp', 'min_precip', 'max_precip', 'avg_precip']) as measure,
    unnest([min(reported_incidents)::double, max(reported_incidents), avg(reported_incidents),
      stddev_samp(reported_incidents), min(max_temp), max(max_temp), avg(max_temp), min(precipitation),
      max(precipitation), avg(precipitation)]) as value from incidents
  union all
  select 'correlations', 'all', unnest(['temp_corr', 'precip_corr', 'congestion_corr']),
    unnest([corr(reported_incidents, max_temp), corr(reported_incidents, precipitation),
      corr(reported_incidents, congestion_level_num)]) from incidents
  union all
  select 'congestion-stats', cast(congestion_level_num as varchar),
    unnest(['days_count', 'avg_incidents', 'avg_temp', 'avg_precip']),
    unnest([count(*)::double, avg(reported_incidents), avg(max_temp), avg(precipitation)])
  from incidents group by congestion_level_num
  union all
  select 'visualizations', unnest(['temp_incidents_bar', 'precip_incidents_bar', 'correlation_heatmap',
    'congestion_incidents_bar']), 'charts', 1
  union all
  select 'stage-counts', 'weather_documents', 'n_rows', count(distinct year(date)) from weather
  union all select 'stage-counts', 'weather_days', 'n_rows', count(*) from weather
  union all select 'stage-counts', 'incident_rows', 'n_rows', count(*) from orders
  union all select 'stage-counts', 'joined_rows', 'n_rows', count(*) from incidents)
select dataset, item, measure, round(value, 6) as value from found"""
    ),
    "stream_ingest": """
select cast(o_orderdate as date) as date, cast(o_orderkey as varchar) as id, o_orderpriority as city,
       cast(floor(o_totalprice / 1000) as int) as reported_incidents,
       cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as int) as congestion_level_num
from orders""",
    "incremental_trusted": _with("select * from incidents"),
    "set_aside_arrivals": _with(
        """select 'trusted' as stage, count(*) as n_rows from incidents
union all select 'incidents_rows', count(*) from orders
union all select 'incidents_rejected', 0
union all select 'weather_rows', count(*) from weather
union all select 'weather_rejected', count(distinct year(date)) from weather"""
    ),
    "compacted_arrivals": """
select cast(o_orderdate as date) as date, cast(o_orderkey as varchar) as id, o_orderpriority as city,
       cast(floor(o_totalprice / 1000) as int) as reported_incidents,
       cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as int) as congestion_level_num
from orders""",
}
